"""From source records to the training frame."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from paywarden.functions.features import hour_of_day, party_pair

LABEL = "label"
# Inputs of the label, and names that would identify a party.
NOT_FEATURES = ["isFraud", "isFlaggedFraud", "nameOrig", "nameDest"]


def label_frame(transactions: DataFrame) -> DataFrame:
    """`label` first, then the party pair and all other columns but the names.

    Records without `isFraud` go first: afterwards a null would pass as class 0.
    """
    return (
        transactions.filter(F.col("isFraud").isNotNull())
        .withColumn("transaction", party_pair())
        .select(F.when(F.col("isFraud") == 1, 1).otherwise(0).alias(LABEL), "*")
        .drop(*NOT_FEATURES)
    )


def training_frame(transactions: DataFrame) -> DataFrame:
    """The label frame with the hour of the day."""
    return label_frame(transactions).withColumn("hour", hour_of_day())


def columns_by_kind(df: DataFrame, exclude: tuple[str, ...] = (LABEL,)) -> tuple[list[str], list[str]]:
    """Names of the categorical (string) and of the numeric columns."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    return (
        [f.name for f in fields if isinstance(f.dataType, StringType)],
        [f.name for f in fields if isinstance(f.dataType, NumericType)],
    )
