"""Confusion counts and the classification report, computed by aggregation.

Predictions are never collected: what leaves the cluster is a handful of counts.
"""

from pyspark.sql import Column, DataFrame, functions as F


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per pair of actual and predicted class."""
    return scored.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count("*").alias("count"))


def class_report(
    scored: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1 and support per class, then the rows `accuracy`,
    `macro avg` and `weighted avg`. A ratio with nothing to divide by is 0.

    Rows that have no label cannot be judged, and rows without a prediction were not:
    neither are in any of these figures. If there are some, a row `no label` or
    `no prediction` counts them in `support`.

    The scored rows are read once; everything after the confusion counts works
    on one row per class.
    """
    cells = kept_apart(confusion(scored, label, prediction))
    n, hit = F.col("count"), F.when(F.col("label") == F.col("prediction"), F.col("count"))
    per_class = (
        cells.where(F.col("apart").isNull())
        .select(
            F.explode(
                F.array(
                    F.struct(
                        F.col("label").alias("class"),
                        n.alias("support"),
                        F.lit(0).cast("bigint").alias("predicted"),
                        F.coalesce(hit, F.lit(0)).alias("hits"),
                    ),
                    F.struct(
                        F.col("prediction").alias("class"),
                        F.lit(0).cast("bigint").alias("support"),
                        n.alias("predicted"),
                        F.lit(0).cast("bigint").alias("hits"),
                    ),
                )
            ).alias("c")
        )
        .groupBy("c.class")
        .agg(*[F.sum(f"c.{m}").alias(m) for m in ("support", "predicted", "hits")])
        .withColumn("precision", _ratio(F.col("hits"), F.col("predicted")))
        .withColumn("recall", _ratio(F.col("hits"), F.col("support")))
        .withColumn("f1", _ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")))
    )
    scores = ("precision", "recall", "f1")
    support = F.sum("support").alias("support")
    totals = per_class.groupingSets([["class"], []], "class").agg(
        F.grouping("class").alias("overall"),
        support,
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        *[F.avg(s).alias(f"macro_{s}") for s in scores],
        *[
            _ratio(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(f"weighted_{s}")
            for s in scores
        ],
    )
    rows = F.when(
        F.col("overall") == 0,
        F.array(_row(F.col("class").cast("string"), *[F.col(f"macro_{s}") for s in scores])),
    ).otherwise(
        F.array(
            _row(F.lit("accuracy"), F.lit(None), F.lit(None), F.col("accuracy")),
            _row(F.lit("macro avg"), *[F.col(f"macro_{s}") for s in scores]),
            _row(F.lit("weighted avg"), *[F.col(f"weighted_{s}") for s in scores]),
        )
    )
    apart = cells.where(F.col("apart").isNotNull()).groupBy("apart").agg(F.sum("count").alias("support"))
    none = [F.lit(None)] * 3
    others = apart.select(F.inline(F.array(_row(F.col("apart"), *none))))
    # Without a row to judge there are no totals either.
    return totals.where((F.col("overall") == 0) | F.col("support").isNotNull()).select(F.inline(rows)).unionAll(others)


def kept_apart(cells: DataFrame) -> DataFrame:
    """Confusion counts with the reason, in `apart`, why a cell is not judged."""
    apart = F.when(F.col("label").isNull(), "no label").when(F.col("prediction").isNull(), "no prediction")
    return cells.withColumn("apart", apart)


def _row(name: Column, precision: Column, recall: Column, f1: Column) -> Column:
    return F.struct(
        name.alias("class"),
        precision.cast("double").alias("precision"),
        recall.cast("double").alias("recall"),
        f1.cast("double").alias("f1"),
        F.col("support").alias("support"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)
