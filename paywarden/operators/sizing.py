"""Sizes, measured before they are relied on, and frames that are read twice."""

import math
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType

BROADCAST_BYTES = 64 << 20


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame from one aggregate over it: the bytes of its strings,
    8 per other value, 16 per row."""
    per_row = F.lit(16)
    for f in df.schema.fields:
        wide = isinstance(f.dataType, (StringType, BinaryType))
        per_row = per_row + (F.coalesce(F.octet_length(f.name), F.lit(0)) if wide else F.lit(8))
    return df.agg(F.sum(per_row.cast("bigint")).alias("bytes")).first()["bytes"] or 0


def hot_keys(df: DataFrame, key: str, share: float) -> dict[str, float]:
    """Keys that hold at least `share` of the rows of a batch frame, with the
    part they hold. At most 1/share keys can qualify, which bounds the result; an
    even part of the shuffle width is the share from which spreading a key helps.
    """
    rows = df.count()
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).count()
    hot = counts.filter(F.col("count") >= max(2.0, share * rows))
    return {r[key]: r["count"] / rows for r in hot.collect()}


def group_numbers(shares: Mapping[str, float], width: int) -> dict[str, int]:
    """Over how many groups to spread each key, so that a group is no larger than
    an even part of `width`: the next power of two, and at least 2."""
    return {k: max(2, 1 << math.ceil(math.log2(max(1.0, s * width)))) for k, s in shares.items()}


def pass_partitions(size: int, cores: int, least: int = 8 << 20, most: int = BROADCAST_BYTES) -> int:
    """Partitions of a frame of `size` bytes that is read in many passes: one per
    `least` bytes up to one per core, beyond that one per `most` bytes. Each pass
    starts a task, and sends the driver a result, for each of them."""
    return max(1, min(cores, -(-size // least)), -(-size // most))


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """`df`, persisted meanwhile (spilling to disk) unless it is already."""
    level = df.storageLevel
    if level.useMemory or level.useDisk:
        yield df
        return
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
