"""Categorical columns with very many values: exact ranks, and slots by hash."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from paywarden.operators.ranges import running_sums
from paywarden.operators.sizing import BROADCAST_BYTES, measured_bytes

HOT_RANKS = 1_024  # the most frequent values, which are joined by broadcast at any size


def category_ranks(df: DataFrame, column: str) -> DataFrame:
    """(value, count, rank) for each value of a column but null: rank 0 is the most
    frequent, equal counts go by name. No list of values reaches the driver or one task.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("count"))
    return running_sums(counted, [F.desc("count"), F.col("value")], {"rank": F.lit(1)})


def with_ranks(df: DataFrame, column: str, ranks: DataFrame, name: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`df` with the rank of its category as a double; null for a null or an unknown value.

    Ranks that measure at most `broadcast_bytes` are broadcast. Otherwise the values that
    many rows share, which have the lowest ranks, are broadcast all the same, and the
    others, each with few rows, are joined by shuffle; null is not shuffled by value.
    """
    of = ranks.select(F.col("value").alias("_value"), F.col("rank").cast("double").alias(name))
    if measured_bytes(of) <= broadcast_bytes:
        return df.join(F.broadcast(of), df[column] == of["_value"], "left").drop("_value")
    hot, rare = of.where(F.col(name) < HOT_RANKS), of.where(F.col(name) >= HOT_RANKS)
    first = df.join(F.broadcast(hot.withColumnRenamed(name, "_hot")), df[column] == F.col("_value"), "left").drop("_value")
    # What has its rank already, or has none, is dealt by a hash of the row instead of its value.
    spread = F.concat(F.lit("\x00"), F.xxhash64(*df.columns).cast("string"))
    done = F.col("_hot").isNotNull() | F.col(column).isNull()
    keyed = first.withColumn("_key", F.when(done, spread).otherwise(F.col(column)))
    joined = keyed.join(rare.withColumnRenamed("_value", "_key"), "_key", "left")
    return joined.withColumn(name, F.coalesce(name, "_hot")).drop("_key", "_hot")


def slot(column: str, slots: int) -> Column:
    """The slot, 0 to slots - 1, of a value: a hash of column name and value. Null has none."""
    digest = F.md5(F.concat(F.lit(f"{column}="), F.col(column)).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint"), F.lit(slots))


def hashed_counts(df: DataFrame, columns: Sequence[str], slots: int, prefix: str = "slot_") -> DataFrame:
    """`df` with the slot of each column. A model needs no list of values for them, and a new value has a slot as well."""
    return df.withColumns({f"{prefix}{c}": slot(c, slots) for c in columns})


def collisions(df: DataFrame, columns: Sequence[str], slots: int) -> DataFrame:
    """(slot, values, rows, most_frequent) for each slot that several values share.

    A value is counted within its column; `most_frequent` counts the rows of the value that has most of
    the slot, so rows - most_frequent is what the model cannot tell apart from it.
    """
    counted = [
        df.where(F.col(c).isNotNull()).groupBy(slot(c, slots).alias("slot"), F.col(c).alias("value")).agg(F.count("*").alias("rows"))
        for c in columns
    ]
    shared = reduce(DataFrame.unionByName, counted).groupBy("slot").agg(
        F.count("*").alias("values"), F.sum("rows").alias("rows"), F.max("rows").alias("most_frequent")
    )
    return shared.where(F.col("values") > 1)
