"""Stratified samples and train/test splits.

The random forms follow the seed *and* the layout of the partitions. The forms
by key follow the key alone: the same rows come out on any cluster, after any
repartitioning, and a split needs no sort.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paywarden.functions.records import hash_bound, hash_prefix


def stratified_sample(
    df: DataFrame, by: str, fractions: Mapping[int, float], seed: int
) -> DataFrame:
    """Bernoulli sample with a fraction per class; classes not named are left out."""
    return df.sampleBy(by, fractions=dict(fractions), seed=seed)


def stratified_sample_by_key(
    df: DataFrame, by: str, fractions: Mapping[int, float], key: str, seed: int = 0
) -> DataFrame:
    """The same kind of sample, decided by a hash of the key."""
    keep = F.lit(False)
    for value, share in fractions.items():
        keep = keep | ((F.col(by) == value) & _below(key, seed, share))
    return df.filter(keep)


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Disjoint parts that together hold every row."""
    return df.randomSplit([float(w) for w in weights], seed=seed)


def split_by_key(
    df: DataFrame, weights: Sequence[float], key: str, seed: int = 0
) -> list[DataFrame]:
    """The same kind of split, decided by a hash of the key."""
    total, used, parts = sum(weights), 0.0, []
    for w in weights:
        lower, used = used, used + w
        # The last part ends at the top of the range, whatever the rounding.
        upper = 1.0 if len(parts) == len(weights) - 1 else used / total
        parts.append(df.filter(_below(key, seed, upper) & ~_below(key, seed, lower / total)))
    return parts


def _below(key: str, seed: int, share: float) -> Column:
    bound = hash_bound(share)
    return F.lit(True) if bound is None else hash_prefix(key, seed) < bound
