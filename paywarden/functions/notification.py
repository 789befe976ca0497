"""Notification status and alert text.

The status is a pure expression. Nothing is sent from inside a task: a retried
task would send twice. Alerts are rows of an outbox table instead, and whatever
delivers them reads that table.
"""

from pyspark.sql import Column, SparkSession, functions as F

# The two statuses, the alert text and its time format.
SENT = "Notification sent"
VALID = "Valid transaction"
MESSAGE = "%s, a fraud transaction is posted in your account at %s"
UNKNOWN_USER = "None"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def is_fraud(prediction: str | Column = "prediction") -> Column:
    """A missing prediction is null here, which neither filters nor alerts."""
    return _col(prediction) == 1


def status(prediction: str | Column = "prediction") -> Column:
    return F.when(is_fraud(prediction), SENT).otherwise(VALID)


def message(at: Column, user: str | Column = "userid") -> Column:
    return F.format_string(
        MESSAGE, F.coalesce(_col(user), F.lit(UNKNOWN_USER)), F.date_format(at, TIME_FORMAT)
    )


def payload(text: str | Column) -> Column:
    """Body for a chat webhook: `{"text": ...}`."""
    return F.to_json(F.struct(_col(text).alias("text")))


def deliverable(webhook: str | Column = "webhook_url") -> Column:
    """An alert can be delivered only if the member has a webhook."""
    return F.coalesce(F.length(_col(webhook)) > 0, F.lit(False))


def register_status(spark: SparkSession, name: str = "notify_status") -> None:
    """SQL function `name(prediction, userid, webhook_url)` giving the status.

    A SQL function is inlined into the plan, so no Python worker is involved.
    """
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}"
        "(prediction DOUBLE, userid STRING DEFAULT NULL, webhook_url STRING DEFAULT NULL) "
        f"RETURNS STRING RETURN CASE WHEN prediction = 1 THEN '{SENT}' ELSE '{VALID}' END"
    )


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
