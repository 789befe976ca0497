import pytest
from pyspark.sql import functions as F

from paywarden import inputs
from paywarden.operators.sample import (
    random_split, split_by_key, stratified_sample, stratified_sample_by_key,
)
from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def given(spark, sf):
    return inputs.transactions(spark, sf)


def ids(df):
    return sorted(r["event_id"] for r in df.select("event_id").collect())


@pytest.mark.parametrize("by_key", [False, True])
def test_sample_keeps_whole_strata_and_adds_nothing(given, by_key):
    shares = {1: 1.0, 0: 0.3}
    if by_key:
        got = stratified_sample_by_key(given, "isFraud", shares, "event_id")
    else:
        got = stratified_sample(given, "isFraud", shares, seed=3)
    assert set(rows(got)) <= set(rows(given))
    fraud = F.col("isFraud") == 1
    assert ids(got.filter(fraud)) == ids(given.filter(fraud))
    assert abs(got.filter(~fraud).count() / given.filter(~fraud).count() - 0.3) < 0.06


@pytest.mark.parametrize("by_key", [False, True])
def test_unnamed_stratum_is_left_out(given, by_key):
    if by_key:
        got = stratified_sample_by_key(given, "isFraud", {1: 1.0}, "event_id")
    else:
        got = stratified_sample(given, "isFraud", {1: 1.0}, seed=3)
    assert got.filter("isFraud = 0").count() == 0


def test_sample_by_key_ignores_the_layout(given):
    shares = {1: 0.5, 0: 0.1}
    spread = given.repartition(7, "amount")
    assert ids(stratified_sample_by_key(given, "isFraud", shares, "event_id")) == ids(
        stratified_sample_by_key(spread, "isFraud", shares, "event_id")
    )


@pytest.mark.parametrize(
    "split", [lambda df, w: random_split(df, w, 42), lambda df, w: split_by_key(df, w, "event_id", 42)]
)
@pytest.mark.parametrize("weights", [(0.8, 0.2), (1, 1, 1), (0.7, 0.2, 0.1)])
def test_parts_are_disjoint_and_complete(given, split, weights):
    parts = [ids(p) for p in split(given, weights)]
    assert sorted(sum(parts, [])) == ids(given)
    total = given.count()
    for part, weight in zip(parts, weights):
        assert abs(len(part) / total - weight / sum(weights)) < 0.06


def test_split_by_key_is_a_filter_only(given):
    text = plan(split_by_key(given, (0.8, 0.2), "event_id")[0])
    assert "Exchange" not in text and "Sort" not in text
