import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from paywarden.functions import notification as note
from paywarden.plans.pipeline import notify, outbox

SCORED = "id INT, prediction DOUBLE, userid STRING, webhook_url STRING"


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(
        [(1, 1.0, 'Ann "A" Ö', "https://example.invalid/1"), (2, 0.0, "Bob", "w"), (3, None, "Cy", "w"),
         (4, 1.0, None, None), (5, 1.0, "Di", "")],
        SCORED,
    )


def test_status_of_each_prediction(scored):
    got = {r["id"]: r["notify_user"] for r in notify(scored).collect()}
    assert got == {1: "Notification sent", 2: "Valid transaction", 3: "Valid transaction",
                   4: "Notification sent", 5: "Notification sent"}


def test_sql_function_equals_the_expression(spark, scored):
    note.register_status(spark, "my_status")
    both = notify(scored).withColumn("sql", F.expr("my_status(prediction, userid, webhook_url)"))
    assert both.filter("sql <> notify_user").count() == 0
    assert "Python" not in both._jdf.queryExecution().toString()
    assert spark.sql("SELECT my_status(1D)").first()[0] == "Notification sent"


def test_vectorised_twin_agrees(scored):
    @F.pandas_udf("string")
    def twin(p: pd.Series) -> pd.Series:
        return p.eq(1).map({True: note.SENT, False: note.VALID})

    both = notify(scored).withColumn("twin", twin("prediction"))
    assert both.filter("twin <> notify_user").count() == 0


def test_outbox_rows(scored):
    at = F.lit("2024-05-06 07:08:09.01").cast("timestamp_ntz")
    got = {r["id"]: r for r in outbox(scored, ["id"], at).collect()}
    assert set(got) == {1, 4, 5}
    assert got[1]["message"] == (
        'Ann "A" Ö, a fraud transaction is posted in your account at 2024-05-06 07:08:09.010000'
    )
    assert json.loads(got[1]["payload"]) == {"text": got[1]["message"]}
    assert got[4]["message"].startswith("None, a fraud transaction")
    assert {k: r["deliverable"] for k, r in got.items()} == {1: True, 4: False, 5: False}


def test_default_time_is_now(scored):
    message = outbox(scored, ["id"]).filter("id = 1").first()["message"]
    stamp = pd.Timestamp(message.rsplit(" at ", 1)[1])
    assert abs((pd.Timestamp.now("UTC").tz_localize(None) - stamp).total_seconds()) < 300


def test_alerts_are_picked_out_by_the_scan(spark, scored, layout):
    scored.write.parquet(layout.notified)
    text = outbox(spark.read.parquet(layout.notified), ["id"])._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(prediction), EqualTo(prediction,1.0)]" in text
