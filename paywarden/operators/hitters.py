"""Which values are frequent in all that was ever seen of a growing table, from a summary of
bounded size (Misra and Gries' counters, which can be merged).

Every task that reads new rows keeps a counter for each of its most frequent values. When
there are too many, the count of the first one too many is taken from all, and what is
then not above 0 is forgotten; so a counter is too low by no more than what was taken in all, the
`error`, and that is at most the rows divided by the number of counters. Counters of several
parts add up, and are cut back in the same way.
"""

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paywarden.sources.readers import table_exists

# What a task says of its rows: a row for each counter, and one without value that has the totals.
PART = "value STRING, n BIGINT, rows BIGINT, error BIGINT"
PARTS = f"{PART}, batch STRING"
# A summary adds how far it goes.
SUMMARY = f"{PART}, upto STRING"
START = ""  # before all batches


def cut_back(counts: Mapping[str, int], most: int) -> tuple[dict[str, int], int]:
    """At most `most` counters, and what was taken from each."""
    if len(counts) <= most:
        return dict(counts), 0
    taken = sorted(counts.values(), reverse=True)[most]
    return {value: n - taken for value, n in counts.items() if n > taken}, taken


@dataclass(frozen=True)
class Frequent:
    """Counters of `rows` rows. The true count of a value is between its counter (0 without one) and that plus `error`."""

    rows: int = 0
    error: int = 0
    counts: dict[str, int] = field(default_factory=dict)
    upto: str = START

    def shares(self, least: float) -> dict[str, float]:
        """The values that may hold the share `least` of the rows or more, at most how much. None that does is missing,
        if there are more counters than 1 / least."""
        wanted = max(2.0, least * self.rows)
        return {v: (n + self.error) / self.rows for v, n in self.counts.items() if n + self.error >= wanted}


def counters(rows: DataFrame, value: Column, most: int) -> DataFrame:
    """What each task says of its rows of a frame or stream, by `PART`. Rows without a value count in the totals only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa  # a task has what is named in here only, and need not have this package

        def fewer(counts):
            taken = sorted(counts.values(), reverse=True)[most]
            return {v: n - taken for v, n in counts.items() if n > taken}, taken

        counts, total, error = {}, 0, 0
        for batch in batches:
            total += batch.num_rows
            found = batch.column(0).value_counts()
            for v, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                if v is not None:
                    counts[v] = counts.get(v, 0) + n
            if len(counts) > 4 * most:
                counts, taken = fewer(counts)
                error += taken
        if len(counts) > most:
            counts, taken = fewer(counts)
            error += taken
        if total:
            m = len(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*counts, None], pa.string()),
                    pa.array([*counts.values(), 0], pa.int64()),
                    pa.array([0] * m + [total], pa.int64()),
                    pa.array([0] * m + [error], pa.int64()),
                ],
                names=["value", "n", "rows", "error"],
            )

    return rows.select(value.cast("string").alias("value")).mapInArrow(run, PART)


def stream_counters(stream: DataFrame, value: Column, most: int) -> DataFrame:
    """The same of a stream, with the time of the batch, by which the table of parts is partitioned."""
    stamp = F.date_format(F.current_timestamp(), "yyyyMMddHHmmssSSS")
    return counters(stream, value, most).withColumn("batch", stamp)


def merged(summary: Frequent, parts: DataFrame, most: int) -> Frequent:
    """A summary with the parts of later batches. At most `most` counters, and one, reach the driver."""
    new = parts.where(F.col("batch") > summary.upto)
    totals = new.agg(F.sum("rows").alias("rows"), F.sum("error").alias("error"), F.max("batch").alias("upto")).first()
    if not totals["rows"]:
        return summary
    known = parts.sparkSession.createDataFrame(list(summary.counts.items()), "value STRING, n BIGINT")
    added = known.unionByName(new.where(F.col("value").isNotNull()).select("value", "n"))
    top = added.groupBy("value").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "value").limit(most + 1).collect()
    counts, taken = cut_back({r["value"]: r["n"] for r in top}, most)
    return Frequent(summary.rows + totals["rows"], summary.error + totals["error"] + taken, counts, totals["upto"])


def read_summary(spark: SparkSession, path: str) -> Frequent:
    """The newest summary of a folder; one of nothing if there is none."""
    if not table_exists(spark, path, SUMMARY, filled=True):
        return Frequent()
    kept = spark.read.schema(SUMMARY).parquet(path)
    newest = kept.agg(F.max("upto").alias("upto")).first()["upto"]
    rows = kept.where(F.col("upto") == newest).collect()  # as many as there are counters
    return Frequent(
        sum(r["rows"] for r in rows),
        sum(r["error"] for r in rows),
        {r["value"]: r["n"] for r in rows if r["value"] is not None},
        newest,
    )


def refreshed(spark: SparkSession, parts_path: str, summary_path: str, most: int) -> Frequent:
    """The kept summary brought up to date with the parts written since, and kept anew if there were any.

    Only later parts are read, and never the rows themselves. `upto` is by the clock of the driver: should
    it be set back between runs, parts stay out, which costs speed and nothing else.
    """
    before = read_summary(spark, summary_path)
    if not table_exists(spark, parts_path, PARTS, filled=True):
        return before
    now = merged(before, spark.read.schema(PARTS).parquet(parts_path), most)
    if now.upto != before.upto:
        rows = [(v, n, 0, 0) for v, n in now.counts.items()] + [(None, 0, now.rows, now.error)]
        spark.createDataFrame(rows, PART).coalesce(1).write.mode("overwrite").parquet(f"{summary_path}/upto={now.upto}")
    return now
