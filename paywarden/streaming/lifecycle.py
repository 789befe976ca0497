"""Progress, idle shutdown and stop of running queries."""

import time
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress

from paywarden.sources.readers import count_rows


def progress_frame(spark: SparkSession, queries: Iterable[StreamingQuery]) -> DataFrame:
    """The recent batches of some queries; Spark keeps a bounded number of each,
    so their sums are not totals. `hop_counts` has those."""
    rows = [
        (p.name, p.batchId, p.numInputRows, p.batchDuration, p.timestamp)
        for q in queries
        for p in q.recentProgress
    ]
    return spark.createDataFrame(
        rows, "name STRING, batchId LONG, numInputRows LONG, durationMs LONG, startedAt STRING"
    )


def hop_counts(spark: SparkSession, tables: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """(hop, rows) of the tables that some hops have written, however many batches ago."""
    counts = [
        count_rows(spark, path, fmt).select(F.lit(hop).alias("hop"), F.col("n").alias("rows"))
        for hop, path in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def stop_queries(spark: SparkSession, prefix: str = "") -> list[str]:
    """Stop the active queries whose name starts with `prefix` (by default all,
    unnamed ones too) and return their names."""
    stopped = []
    for query in spark.streams.active:
        if (query.name or "").startswith(prefix):
            query.stop()
            stopped.append(query.name)
    return stopped


def stop_when_idle(
    queries: list[StreamingQuery],
    idle_seconds: float,
    check_seconds: float = 10.0,
    clock: Callable[[], float] = time.monotonic,
) -> float:
    """Wait until no query has finished a batch for more than `idle_seconds`, then stop
    them all; returns the idle time. If a query fails, the others are stopped and
    the error is raised.

    Asks the queries themselves. Listing the source folder instead would cost
    more with every file, and would not know whether the files are processed.
    """
    seen: dict[str, int] = {}
    last_batch = clock()
    while any(q.isActive for q in queries):
        try:
            for q in queries:
                q.awaitTermination(check_seconds / len(queries))
        except BaseException:
            for q in queries:
                q.stop()
            raise
        if _any_new_batch(queries, seen):
            last_batch = clock()
        idle = clock() - last_batch
        # A batch that takes longer than the wait is not idleness.
        busy = any(q.isActive and q.status["isDataAvailable"] for q in queries)
        if idle > idle_seconds and not busy:
            # From the source on, so that nothing is read that nobody will take.
            for q in queries:
                q.stop()
            return idle
    return clock() - last_batch


def await_table(query: StreamingQuery, there: Callable[[], bool]) -> None:
    """Wait, as long as the query runs, until its table is `there`, from an earlier
    run or from this one; raises if it ends without."""
    while True:
        # Asked in this order, what is written just before the end counts.
        active = query.isActive
        if there():
            return
        if not active:
            query.awaitTermination()
            raise RuntimeError(f"{query.name}: ended without a table")
        query.awaitTermination(0.2)


def _any_new_batch(queries: list[StreamingQuery], seen: dict[str, int]) -> bool:
    """Whether a batch was finished since the last call."""
    new = False
    for q in queries:
        for p in q.recentProgress:
            if ran_batch(p) and p.batchId > seen.get(q.id, -1):
                seen[q.id] = p.batchId
                new = True
    return new


def ran_batch(progress: StreamingQueryProgress) -> bool:
    """Whether the progress is of a batch, and not of a look at an idle source.
    The number of rows does not tell: a filter that the scan applies by itself
    can leave none of a batch."""
    return "addBatch" in progress.durationMs
