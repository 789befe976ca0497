"""Counts that describe a frame. All combine inside each task before the
shuffle, so a dominant class or hour costs nothing extra."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def class_balance(df: DataFrame, by: str = "isFraud") -> DataFrame:
    """Rows per class."""
    return df.groupBy(by).agg(F.count("*").alias("count"))


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN where the type knows NaN."""
    missing = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, (DoubleType, FloatType)):
        missing = missing | F.isnan(column)
    return missing


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of missing values of each column, in one pass."""
    return df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in columns or df.columns])


def hour_profile(df: DataFrame, label: str = "label") -> DataFrame:
    """Transactions, frauds and fraud rate per hour of the day."""
    return (
        df.groupBy("hour")
        .agg(F.count("*").alias("count"), F.sum(label).alias("frauds"))
        .withColumn("fraud_rate", F.col("frauds") / F.col("count"))
    )
