"""Daily active users, fed by a stream of events.

A day is closed, and its row appended, once events of a day that is `lateness` days later
have come: only users of open days are kept in the state. What comes for a closed day is
not counted any more; `late_events` says how much that is, by day.
"""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from paywarden.streaming.runner import run_hop


def daily_active_stream(events: DataFrame, at: str = "ts", user: str = "user_id", lateness: int = 1) -> DataFrame:
    """(day, active_users, events) of a stream, a row for each day that is closed.

    Users are counted in two steps, per day and user and then per day, so neither a busy
    day nor a busy user meets in one task as raw rows. Events without time belong to no day.
    """
    # Days instead of times carry the watermark: they are the groups, in the time zone of the session.
    days = events.where(F.col(at).isNotNull()).select(
        F.date_trunc("day", F.col(at).cast("timestamp")).alias("day"), F.col(user).alias("user")
    )
    counted = days.withWatermark("day", f"{lateness} days").groupBy("day", "user").agg(F.count("*").alias("n"))
    closed = counted.groupBy("day").agg(F.count("user").alias("active_users"), F.sum("n").alias("events"))
    return closed.withColumn("day", F.to_date("day"))


def run_daily_active(events: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """Append the days that the present input closes to the table at `path`."""
    return run_hop(daily_active_stream(events, **options), path, checkpoint)


def late_events(landed: DataFrame, daily: DataFrame, at: str = "ts") -> DataFrame:
    """(day, landed, counted, late) for each closed day: its events in the landed rows, and those in the daily table.

    Exact whatever number of runs and batches it took, as it compares what is there.
    """
    per_day = landed.where(F.col(at).isNotNull()).groupBy(F.to_date(at).alias("day")).agg(F.count("*").alias("landed"))
    return per_day.join(daily.select("day", F.col("events").alias("counted")), "day").withColumn("late", F.col("landed") - F.col("counted"))
