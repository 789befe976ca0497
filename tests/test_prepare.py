import math
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paywarden import inputs
from paywarden.functions.features import hour_of_day, party_pair
from paywarden.operators import gold
from paywarden.operators.evaluate import class_report, confusion
from paywarden.operators.hops import refine
from paywarden.operators.impute import column_means, column_modes, impute
from paywarden.operators.prepare import columns_by_kind, label_frame, training_frame
from paywarden.operators.profile import missing_profile
from paywarden.schemas import FEATURES, RECORD, REFINED_SOURCE
from tests.conftest import rows

NAN = float("nan")


def record(**values):
    base = dict(step=1, type="PAYMENT", amount=1.0, nameOrig="C1", oldbalanceOrg=0.0,
                newbalanceOrig=0.0, nameDest="M1", oldbalanceDest=0.0, newbalanceDest=0.0,
                isFraud=0, isFlaggedFraud=0)
    return tuple((base | values)[f.name] for f in RECORD.fields)


@pytest.mark.parametrize(
    "orig, dest, pair",
    [("C1", "M2", "CM"), ("M1", "M2", "MM"), ("", "C2", "C"), (None, "C2", None), ("C1", None, None)],
)
def test_party_pair(spark, orig, dest, pair):
    df = spark.createDataFrame([record(nameOrig=orig, nameDest=dest)], RECORD)
    assert df.select(party_pair()).first()[0] == pair


@pytest.mark.parametrize("step, hour", [(0, 0), (25, 1), (719, 23), (-3, -3), (None, None)])
def test_hour_of_day(spark, step, hour):
    df = spark.createDataFrame([record(step=step)], RECORD)
    assert df.select(hour_of_day()).first()[0] == hour
    assert df.select(hour_of_day().alias("h")).schema["h"].dataType.typeName() == "integer"


def test_records_without_label_are_dropped_first(spark):
    df = spark.createDataFrame([record(isFraud=v, step=i) for i, v in enumerate([None, 0, 1])], RECORD)
    got = {r["step"]: r["label"] for r in label_frame(df).collect()}
    assert got == {1: 0, 2: 1}


def test_frames_have_the_declared_columns(spark):
    df = spark.createDataFrame([record()], RECORD)
    names = {"isFraud", "isFlaggedFraud", "nameOrig", "nameDest"}
    kept = [c for c in df.columns if c not in names]
    assert label_frame(df).columns == ["label", *kept, "transaction"]
    assert training_frame(df).columns == ["label", *FEATURES]
    assert refine(df).columns == [*REFINED_SOURCE, "transaction", "hour"]


def test_training_and_serving_compute_the_same_features(spark, sf):
    given = inputs.transactions(spark, sf)
    assert rows(training_frame(given), *FEATURES) == rows(refine(given), *FEATURES)


def test_columns_by_kind(spark):
    strings, numbers = columns_by_kind(training_frame(spark.createDataFrame([record()], RECORD)))
    assert strings == ["type", "transaction"]
    assert numbers == [c for c in FEATURES if c not in strings]


def test_missing_counts_null_everywhere_and_nan_in_doubles(spark):
    df = spark.createDataFrame(
        [(None, "a", 1.0), (1, None, NAN), (2, "NaN", None)], "i INT, s STRING, d DOUBLE"
    )
    assert tuple(missing_profile(df).first()) == (1, 1, 2)
    assert tuple(missing_profile(df.limit(0)).first()) == (0, 0, 0)


def test_imputation_fills_every_column(spark):
    df = spark.createDataFrame(
        [(1, 1, "b", 2.0), (0, None, None, NAN), (1, 2, "a", 4.0), (0, 3, "a", None), (0, 6, "b", 3.0)],
        "label INT, i INT, s STRING, d DOUBLE",
    )
    assert column_means(df, ["i", "d"]) == {"i": 3.0, "d": 3.0}
    assert column_modes(df, ["s"]) == {"s": "a"}  # a tie goes to the first name
    assert rows(impute(df)) == rows(
        spark.createDataFrame(
            [(1, 1.0, "b", 2.0), (0, 3.0, "a", 3.0), (1, 2.0, "a", 4.0), (0, 3.0, "a", 3.0), (0, 6.0, "b", 3.0)],
            "label INT, i DOUBLE, s STRING, d DOUBLE",
        )
    )


def test_a_column_without_values_stays_empty(spark):
    df = spark.createDataFrame([(1, None, None)], "label INT, s STRING, d DOUBLE")
    assert rows(impute(df)) == [(1, None, None)]


def test_report_against_hand_count(spark):
    pairs = [(0, 0.0)] * 5 + [(0, 1.0)] * 2 + [(1, 1.0)] * 3 + [(1, 0.0)] * 1
    df = spark.createDataFrame(pairs, "label INT, prediction DOUBLE")
    assert rows(confusion(df)) == [(0, 0, 5), (0, 1, 2), (1, 0, 1), (1, 1, 3)]
    got = {r["class"]: r for r in class_report(df).collect()}
    assert got["0"]["precision"] == 5 / 6 and got["0"]["recall"] == 5 / 7
    assert got["1"]["precision"] == 3 / 5 and got["1"]["recall"] == 3 / 4
    assert math.isclose(got["1"]["f1"], 2 * 0.6 * 0.75 / 1.35)
    assert (got["0"]["support"], got["1"]["support"], got["accuracy"]["support"]) == (7, 4, 11)
    assert got["accuracy"]["f1"] == 8 / 11
    assert math.isclose(got["macro avg"]["recall"], (5 / 7 + 3 / 4) / 2)
    assert math.isclose(got["weighted avg"]["recall"], 8 / 11)


def test_report_with_a_class_that_is_never_predicted(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.0)], "label INT, prediction DOUBLE")
    got = {r["class"]: r for r in class_report(df).collect()}
    assert (got["1"]["precision"], got["1"]["recall"], got["1"]["f1"]) == (0.0, 0.0, 0.0)


def test_pruned_scan_and_pushed_filter(spark, sf):
    from tests.conftest import plan

    text = plan(inputs.table(spark, sf, "events").filter(F.col("value") > 300).select("event_id"))
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,300.0)]" in text
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_revenue_with_one_dominant_customer(spark, limit):
    """Against a plain loop: a third of the orders belong to one customer, some to none."""
    orders = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("cust"),
        (F.col("id") * 0.01 + 0.1).alias("price"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, id)").alias("at"),
    )
    customers = spark.range(30).select(
        F.col("id").alias("cust_id"), F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("dept")
    )
    got = gold.quarter_revenue(
        orders, customers, at="at", amount="price", order_customer="cust", customer="cust_id",
        department="dept", broadcast_bytes=limit,
    )
    dept = {r["cust_id"]: r["dept"] for r in customers.collect()}
    want = defaultdict(lambda: [Decimal("0.00"), 0])
    for cust, price, at in orders.collect():
        if cust in dept:
            cell = want[at.year, (at.month + 2) // 3, dept[cust]]
            cell[0] += Decimal(str(round(price, 2))).quantize(Decimal("0.01"))
            cell[1] += 1
    assert rows(got, "year", "quarter", "department", "revenue", "orders") == sorted(
        ((*k, *v) for k, v in want.items()), key=repr
    )
