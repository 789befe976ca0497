"""Batch and streaming scans."""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from paywarden.schemas import MEMBERS, RAW, RECORD


# Older than any file. Spark's own default leaves out files that are a week older
# than the newest it has seen, so a backfill would be lost without a word.
ANY_AGE = "36500d"


@dataclass(frozen=True)
class Admission:
    """How much new input one micro-batch may take; unset means all of it.

    One file per batch is good for watching a demo. A backlog of many files
    wants batches that fill the cluster, see `cluster_sized`.
    """

    max_files: int | None = None
    max_bytes: int | None = None

    def options(self) -> dict[str, str]:
        if self.max_files is not None and self.max_bytes is not None:
            raise ValueError("the file source takes one limit: max_files or max_bytes")
        if self.max_files is not None:
            return {"maxFilesPerTrigger": str(self.max_files)}
        if self.max_bytes is not None:
            return {"maxBytesPerTrigger": str(self.max_bytes)}
        return {}

    @staticmethod
    def cluster_sized(
        spark: SparkSession, bytes_per_core: int = 512 << 20, least: int = 128 << 30
    ) -> "Admission":
        """Batches of a few input splits per core: enough to keep every core
        busy, small enough that a lost batch is cheap to repeat. The floor is for
        clusters that start with few cores and grow with the work."""
        return Admission(max_bytes=max(least, spark.sparkContext.defaultParallelism * bytes_per_core))


def read_transactions_csv(
    spark: SparkSession, path: str, schema: StructType | None = RECORD
) -> DataFrame:
    """Transactions from CSV with a header row.

    With a schema the header is checked against it, so reordered columns fail
    instead of landing in the wrong place. `schema=None` infers the types at
    the price of one more pass over the data.
    """
    reader = spark.read.format("csv").option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).load(path)
    return reader.schema(schema).option("enforceSchema", False).load(path)


def read_members_csv(spark: SparkSession, path: str) -> DataFrame:
    """The member list: who to notify for which account."""
    return read_transactions_csv(spark, path, MEMBERS)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table by path, as of now. For a table written by a streaming query
    only committed files are seen."""
    return spark.read.format(fmt).load(path)


def path_relation(path: str, fmt: str = "parquet") -> str:
    """Name of a table path for use in SQL text, e.g. ``FROM {path_relation(p)}``."""
    if "`" in path:
        raise ValueError(f"back quote in table path: {path}")
    return f"{fmt}.`{path}`"


def count_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Row count of a live table; on Parquet it is answered from file footers."""
    return spark.sql(f"SELECT count(*) AS n FROM {path_relation(path, fmt)}")


def stream_text(
    spark: SparkSession,
    path: str,
    admission: Admission = Admission(),
    max_file_age: str = ANY_AGE,
    clean: Mapping[str, str] | None = None,
) -> DataFrame:
    """New text files as a stream, one row `data` per line.

    Files are read whatever their age. The driver remembers every file it has
    seen for `max_file_age`; a landing folder that grows for ever can be kept
    short by `clean`, such as ``{"cleanSource": "archive", "sourceArchiveDir": path}``.
    """
    return (
        spark.readStream.format("text")
        .schema(RAW)
        .option("maxFileAge", max_file_age)
        .options(**admission.options(), **(clean or {}))
        .load(path)
    )


def stream_table(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    admission: Admission = Admission(),
    max_file_age: str = ANY_AGE,
) -> DataFrame:
    """Rows appended to a table, as a stream, whatever the age of its files."""
    return (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFileAge", max_file_age)
        .options(**admission.options())
        .load(path)
    )


def table_exists(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", filled: bool = False
) -> bool:
    """Whether there is a table at a path, on demand only one with rows."""
    try:
        table = spark.read.format(fmt).schema(schema).load(path)
        return not filled or table.limit(1).count() > 0
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def freshness(spark: SparkSession, path: str) -> DataFrame:
    """One row about the files of a directory: how many, their bytes, and when
    the newest was modified (null for an empty directory).

    Only file status is read: the content column is pruned away.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    )
    return files.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        F.max("modificationTime").alias("newest"),
    )
