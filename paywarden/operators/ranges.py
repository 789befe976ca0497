"""Sums along an order of all rows, without a task that sees them all."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from paywarden.sources.writers import staged


def running_sums(df: DataFrame, order: list[Column], sums: Mapping[str, Column | str]) -> DataFrame:
    """The rows of `df` with a column for each of `sums`: what the summands, integers, of all
    rows before it come to, in `order`.

    Rows are dealt out by ranges of the order, summed range by range, and numbered
    within a range; what lies before a range is added to its rows. Only a row for each
    range, as many as the shuffle is wide, reaches the driver. Rows that are equal in
    `order` fall in one range, so count them before; the order decides between no others.
    """
    spark = df.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The ranges are drawn from a sample, so they are written down before they are relied on.
    dealt = df.repartitionByRange(width, *order)
    dealt = staged(dealt.withColumns({"_range": F.spark_partition_id(), **{f"_{n}": _summand(v) for n, v in sums.items()}}))
    totals = dealt.groupBy("_range").agg(*[F.sum(f"_{n}").alias(n) for n in sums]).collect()
    before, offsets = dict.fromkeys(sums, 0), []
    for row in sorted(totals, key=lambda r: r["_range"]):
        offsets.append((row["_range"], *before.values()))
        before = {n: before[n] + row[n] for n in sums}
    schema = "_range INT, " + ", ".join(f"`_before_{n}` BIGINT" for n in sums)
    offset = spark.createDataFrame(offsets, schema)
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    added = {n: F.coalesce(F.sum(f"_{n}").over(within), F.lit(0)) + F.col(f"_before_{n}") for n in sums}
    helpers = ["_range", *[f"_{n}" for n in sums], *[f"_before_{n}" for n in sums]]
    return dealt.join(F.broadcast(offset), "_range").withColumns(added).drop(*helpers)


def _summand(value: Column | str) -> Column:
    return F.coalesce((F.col(value) if isinstance(value, str) else value).cast("bigint"), F.lit(0))
