"""Transaction-fraud analytics on Spark: batch preparation and training,
multi-hop streaming, scoring and alerting."""
