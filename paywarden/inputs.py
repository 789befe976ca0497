"""The given tables as transactions and members.

The pipeline works on payment records; the given tables hold an event log and
customers. Every event becomes one transaction, every customer in credit is a
member. `TRANSACTIONS_SQL` and `MEMBERS_SQL` say the same for the SQL checks.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from paywarden.layout import Layout, new_layout
from paywarden.schemas import RECORD, with_key
from paywarden.sources.writers import export_json_lines

KEY = "event_id"
KEYED_RECORD = with_key(RECORD, KEY)
EPOCH = "2024-01-01"
HOOKS = "https://example.invalid/hook/"

TRANSACTIONS_SQL = f"""transactions AS (
  SELECT event_id,
         CAST(date_diff('day', DATE '{EPOCH}', CAST(ts AS DATE)) * 24 + hour(ts) AS INTEGER) AS step,
         upper(event_type) AS type, value AS amount,
         concat('C', CAST(user_id AS VARCHAR)) AS nameOrig,
         value * 2 AS oldbalanceOrg, value * 2 - value AS newbalanceOrig,
         concat(CASE WHEN event_id % 3 = 0 THEN 'M' ELSE 'C' END, CAST(event_id % 97 AS VARCHAR)) AS nameDest,
         CAST(0 AS DOUBLE) AS oldbalanceDest, value AS newbalanceDest,
         CAST(CASE WHEN event_type = 'error' AND value > 100 THEN 1 ELSE 0 END AS INTEGER) AS isFraud,
         CAST(CASE WHEN value > 300 THEN 1 ELSE 0 END AS INTEGER) AS isFlaggedFraud
  FROM events)"""

MEMBERS_SQL = f"""members AS (
  SELECT concat('C', CAST(c_custkey AS VARCHAR)) AS nameOrig, c_name AS userid,
         concat('{HOOKS}', CAST(c_custkey AS VARCHAR)) AS webhook_url
  FROM customer WHERE c_acctbal > 0)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per event, keyed by `event_id`."""
    value, kind, event = F.col("value"), F.col("event_type"), F.col("event_id")
    days = F.datediff(F.to_date("ts"), F.lit(EPOCH).cast("date"))
    return table(spark, sf_dir, "events").select(
        event,
        (days * 24 + F.hour("ts")).cast("int").alias("step"),
        F.upper(kind).alias("type"),
        value.alias("amount"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("nameOrig"),
        (value * 2).alias("oldbalanceOrg"),
        (value * 2 - value).alias("newbalanceOrig"),
        F.concat(
            F.when(event % 3 == 0, "M").otherwise("C"), (event % 97).cast("string")
        ).alias("nameDest"),
        F.lit(0.0).alias("oldbalanceDest"),
        value.alias("newbalanceDest"),
        F.when((kind == "error") & (value > 100), 1).otherwise(0).alias("isFraud"),
        F.when(value > 300, 1).otherwise(0).alias("isFlaggedFraud"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in credit; some transactions have a member and some have none."""
    account = F.col("c_custkey").cast("string")
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_acctbal") > 0)
        .select(
            F.concat(F.lit("C"), account).alias("nameOrig"),
            F.col("c_name").alias("userid"),
            F.concat(F.lit(HOOKS), account).alias("webhook_url"),
        )
    )


def land_transactions(spark: SparkSession, sf_dir: str) -> Layout:
    """The transactions as JSON lines in the source folder of a new layout."""
    layout = new_layout(spark)
    export_json_lines(transactions(spark, sf_dir), layout.source)
    return layout


def land_half(spark: SparkSession, sf_dir: str, layout: Layout, half: int, days_old: int = 0) -> None:
    """Every second transaction, in more files of the source folder of a layout.
    The files can be made to look some days old, as after a copy that keeps times."""
    rows = transactions(spark, sf_dir).filter(F.pmod(KEY, F.lit(2)) == half)
    folder = spark._jvm.org.apache.hadoop.fs.Path(layout.source)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    known = {str(f.getPath()) for f in store.listStatus(folder)} if store.exists(folder) else set()
    export_json_lines(rows, layout.source, mode="append")
    for f in store.listStatus(folder):
        if days_old and str(f.getPath()) not in known:
            store.setTimes(f.getPath(), f.getModificationTime() - days_old * 86_400_000, -1)
