"""Fill missing values: the mean for numbers, the most frequent value for strings."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from paywarden.operators.prepare import columns_by_kind
from paywarden.operators.profile import is_missing


def column_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Means over the values that are present, all columns in one pass."""
    row = df.agg(*[F.avg(F.when(~is_missing(df, c), F.col(c))).alias(c) for c in columns])
    return {c: m for c, m in row.first().asDict().items() if m is not None}


def column_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent present value of each column; the first in order on a tie.

    One pass for all columns. Values are counted by a grouped count, which
    combines in the tasks and spills, and not in one map per column.
    """
    counts = (
        df.select(*columns)
        .unpivot([], list(columns), "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    best = counts.groupBy("column").agg(F.min(F.struct(-F.col("n"), "value")).alias("best"))
    return {r["column"]: r["value"] for r in best.select("column", "best.value").collect()}


def impute(df: DataFrame, exclude: tuple[str, ...] = ("label",)) -> DataFrame:
    """All columns but the excluded ones without missing values.

    A whole-number column turns into DOUBLE, as its mean need not be whole. A
    column without any value stays as it is.
    """
    strings, numbers = columns_by_kind(df, exclude)
    fill = (column_means(df, numbers) if numbers else {}) | (
        column_modes(df, strings) if strings else {}
    )
    return df.select(
        *[
            F.when(is_missing(df, c), F.lit(fill[c])).otherwise(F.col(c)).alias(c)
            if c in fill
            else F.col(c)
            for c in df.columns
        ]
    )
