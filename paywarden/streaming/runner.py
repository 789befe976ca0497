"""Start one hop: a stream appended to a table, with a checkpoint of its own."""

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

# Take everything there is, in admitted batches, then end.
AVAILABLE_NOW = {"availableNow": True}
# Keep running, each batch as soon as the last one is done.
CONTINUAL = {"processingTime": "0 seconds"}


def start_hop(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    fmt: str = "parquet",
    trigger: dict | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to the table at `path`.

    The file sink records the files of each batch in the table's own log, so a
    batch that is repeated after a failure is seen once by readers. `fmt` may
    name another streaming table format that the cluster provides.

    A task that meets only a few partitions keeps a file open for each, instead
    of sorting its rows by partition first.
    """
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
    )
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    # The query takes a copy of the settings when it starts.
    with _setting(stream.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "32"):
        return writer.start(path)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_hop(stream: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """`start_hop` over the input that is there now, until it is all written."""
    query = start_hop(stream, path, checkpoint, trigger=AVAILABLE_NOW, **options)
    query.awaitTermination()
    return query


def preview(stream: DataFrame, name: str, rows: int = 1000) -> DataFrame:
    """The first rows of a stream that is there now, as they come, from the in-memory table `name`. The
    driver holds them, hence the limit."""
    query = (
        stream.limit(rows)
        .writeStream.format("memory")
        .queryName(name)
        .outputMode("append")
        .trigger(**AVAILABLE_NOW)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.table(name)


def to_console(stream: DataFrame, checkpoint: str | None = None, rows: int = 20) -> StreamingQuery:
    """Print the first rows of each batch. A debugging help; with a checkpoint it goes on where it ended."""
    writer = stream.writeStream.format("console").option("numRows", rows).trigger(**AVAILABLE_NOW)
    return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()
