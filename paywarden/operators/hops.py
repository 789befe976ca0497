"""The stateless steps between the raw text and the refined table.

Each takes a batch or a streaming frame; a stream gives the same rows.
"""

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from paywarden.functions.features import hour_of_day, party_pair
from paywarden.functions.records import decode_record
from paywarden.schemas import RECORD, REFINED_SOURCE, TRANSACTIONS


def to_bronze(raw: DataFrame, dataset: str = TRANSACTIONS) -> DataFrame:
    """Stamp and tag raw lines, so one table can hold several datasets.

    In a stream the stamp is the time of the micro-batch, and a replayed batch
    gets the same stamp again.
    """
    return raw.select(
        F.current_timestamp().alias("receipt_time"), F.lit(dataset).alias("dataset"), "*"
    )


def multiplex(raws: Mapping[str, DataFrame]) -> DataFrame:
    """Raw lines of several datasets as one bronze frame, keyed by their tags.

    One stream must write them all: a file-sink table has a single writer.
    """
    return reduce(DataFrame.unionByName, [to_bronze(raw, tag) for tag, raw in raws.items()])


def parse_records(
    bronze: DataFrame, schema: StructType = RECORD, dataset: str = TRANSACTIONS
) -> DataFrame:
    """The records of one dataset, as columns. Every line stays one row."""
    return (
        bronze.filter(F.col("dataset") == dataset)
        .select(decode_record("data", schema).alias("record"))
        .select("record.*")
    )


def unparsed_lines(
    bronze: DataFrame, schema: StructType = RECORD, dataset: str = TRANSACTIONS
) -> DataFrame:
    """The raw lines of a dataset that are blank or no record at all, with their stamp."""
    record = F.col("_record")
    empty = reduce(and_, [record[c].isNull() for c in schema.names])
    return (
        bronze.filter(F.col("dataset") == dataset)
        .withColumn("_record", decode_record("data", schema))
        .filter(empty)
        .drop("_record")
    )


def unparsed(parsed: DataFrame) -> DataFrame:
    """Rows whose line was blank or no record at all (every field is null)."""
    return parsed.filter(reduce(and_, [F.col(c).isNull() for c in parsed.columns]))


def refine(parsed: DataFrame, carry: Sequence[str | Column] = ()) -> DataFrame:
    """The columns the model needs plus the account to notify.

    `carry` names further columns to keep in front, such as a row key.
    """
    return parsed.select(
        *carry,
        *REFINED_SOURCE,
        party_pair().alias("transaction"),
        hour_of_day().alias("hour"),
    )
