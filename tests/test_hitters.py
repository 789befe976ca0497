"""Summaries of frequent values, and a pipeline that keeps one between its runs."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paywarden import inputs
from paywarden.inputs import KEY, KEYED_RECORD
from paywarden.operators.hitters import Frequent, counters, cut_back, merged, read_summary, refreshed
from paywarden.plans.pipeline import Pipeline
from paywarden.sources.readers import read_table
from paywarden.sources.writers import export_json_lines
from tests.conftest import rows


def parts(spark, batches, most):
    """What the tasks say of some batches of values, batch by batch."""
    said = []
    for k, values in enumerate(batches):
        df = spark.createDataFrame([(v,) for v in values], "v STRING").repartition(3)
        said.append(counters(df, F.col("v"), most).withColumn("batch", F.lit(f"{k:03}")))
    out = said[0]
    for more in said[1:]:
        out = out.unionByName(more)
    return out


def skewed(seed, n, hot):
    rng = random.Random(seed)
    return [hot if rng.random() < 0.34 else rng.choice([None, "x", *(f"k{rng.randrange(3 * n)}" for _ in range(8))]) for _ in range(n)]


def test_cut_back_takes_the_same_from_all():
    assert cut_back({"a": 5, "b": 3, "c": 2}, 3) == ({"a": 5, "b": 3, "c": 2}, 0)
    assert cut_back({"a": 5, "b": 3, "c": 2}, 2) == ({"a": 3, "b": 1}, 2)
    assert cut_back({"a": 2, "b": 2, "c": 2}, 2) == ({}, 2)
    assert cut_back({}, 2) == ({}, 0)


@pytest.mark.parametrize("most", [4, 20, 10_000])
def test_counters_are_within_their_error(spark, most):
    batches = [skewed(1, 600, "h1"), skewed(2, 900, "h2"), [], skewed(3, 500, "h1"), [None] * 40]
    truth = Counter(v for b in batches for v in b if v is not None)
    total = sum(map(len, batches))
    found = merged(Frequent(), parts(spark, batches, most), most)
    assert found.rows == total and len(found.counts) <= most
    assert found.error <= 3 * total / most + 1 if most < 10_000 else found.error == 0
    for value in truth | found.counts:
        assert found.counts.get(value, 0) <= truth[value] <= found.counts.get(value, 0) + found.error
    # no value with a share above 1 / most of the rows and the error is missing
    assert {v for v, n in truth.items() if n > found.error} <= set(found.counts)
    if most == 10_000:
        assert found.shares(0.1) == {v: n / total for v, n in truth.items() if n >= 0.1 * total}


def test_later_parts_are_added_and_earlier_ones_are_not_read_again(spark):
    batches = [skewed(k, 300, f"h{k}") for k in range(4)]
    all_parts = parts(spark, batches, 50)
    step = Frequent()
    for k in range(4):
        step = merged(step, all_parts.where(F.col("batch") <= f"{k:03}"), 50)
        assert step.upto == f"{k:03}" and step.rows == 300 * (k + 1)
    assert merged(step, all_parts, 50) == step
    # what was counted before may be gone by then
    again = merged(merged(Frequent(), all_parts.where("batch < '002'"), 50), all_parts.where("batch >= '002'"), 50)
    assert again.rows == step.rows and set(step.shares(0.05)) == set(again.shares(0.05))


def test_summaries_are_kept(spark, layout):
    folder, kept = f"{layout.root}/parts", f"{layout.root}/summary"
    assert refreshed(spark, folder, kept, 9) == Frequent()
    parts(spark, [["a", "a", None], ["b"]], 9).write.partitionBy("batch").parquet(folder)
    first = refreshed(spark, folder, kept, 9)
    assert first == Frequent(4, 0, {"a": 2, "b": 1}, "001") == read_summary(spark, kept)
    parts(spark, [[], [], ["b", "b"]], 9).write.partitionBy("batch").mode("append").parquet(folder)
    assert refreshed(spark, folder, kept, 9) == Frequent(6, 0, {"a": 2, "b": 3}, "002") == read_summary(spark, kept)


def test_nothing_seen_has_no_shares():
    assert Frequent().shares(0.1) == {}
    assert Frequent(rows=4, counts={"a": 1}).shares(0.0) == {}  # one row is not worth spreading


def test_a_restart_counts_new_rows_only(spark, sf, layout):
    given, members = inputs.transactions(spark, sf), inputs.members(spark, sf)
    turned = given.withColumn("nameOrig", F.expr("IF(event_id % 2 = 1 AND event_id % 3 < 2, 'C1', nameOrig)"))
    read = []
    for half in (0, 1, None):
        if half is not None:
            export_json_lines(turned.where(F.pmod(KEY, F.lit(2)) == half), layout.source, mode="append")
        job = Pipeline(spark, layout, record=KEYED_RECORD, key=[KEY], members=members, name="counted", broadcast_bytes=0)
        queries = {q.name: q for q in job.run()}
        read.append(sum(p.numInputRows for p in queries["counted_account_counts"].recentProgress))
        hot = job.frequent_accounts().shares(0.3)
        assert ("C1" in hot) == (half != 0)
    n = given.count()
    assert read == [n // 2, n - n // 2, 0]
    enriched = read_table(spark, layout.enriched)
    wanted = turned.join(members, "nameOrig", "left")
    assert rows(enriched, KEY, "nameOrig", "userid") == rows(wanted, KEY, "nameOrig", "userid")


def test_a_small_member_list_needs_no_counts(spark, sf, layout):
    export_json_lines(inputs.transactions(spark, sf), layout.source)
    job = Pipeline(spark, layout, record=KEYED_RECORD, key=[KEY], members=inputs.members(spark, sf), name="small")
    assert [q.name for q in job.run()] == ["small_bronze", "small_lines_unparsed", "small_transactions_parsed", "small_transactions_enriched"]
    assert job.frequent_accounts() == Frequent()
