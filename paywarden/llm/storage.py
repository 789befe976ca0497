"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

from paywarden.layout import shared_root


def written(df: DataFrame) -> DataFrame:
    """The rows from a new Parquet table in the shared folder.

    This cuts the lineage, and what was computed outlives the executors that
    computed it.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/stage-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)  # most columns are hashes; what else there is packs well
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """`name`, or one like it that no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def schema_of(fields: list[StructField], added: str) -> StructType:
    """The fields and those of a DDL string."""
    return StructType([*fields, *StructType.fromDDL(added).fields])
