"""Batch and streaming sinks."""

import uuid

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from paywarden.functions.records import encode_record
from paywarden.layout import shared_root


def export_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, written by the tasks that hold the rows."""
    df.select(encode_record().alias("data")).write.mode(mode).text(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def materialise(df: DataFrame) -> tuple[DataFrame, int]:
    """Persist a frame that several jobs read, spilling to disk, and count it.
    The caller unpersists it."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    return kept, kept.count()


def staged(df: DataFrame) -> DataFrame:
    """The rows from a new table in the shared folder: computed once, however often
    they are read, and kept when executors are lost."""
    path = f"{shared_root(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
