"""Sums along an order, curves, and categories with many values."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paywarden.operators import categories, curves
from paywarden.operators.ranges import running_sums
from tests.conftest import plan


@pytest.mark.parametrize("n", [0, 1, 7, 2000])
def test_sums_of_all_rows_before(spark, n):
    rng = random.Random(n)
    rows = [(k, rng.choice([None, 1, 2, 50]), f"g{rng.randrange(9)}") for k in range(n)]
    df = spark.createDataFrame(rows, "k INT, v INT, _g STRING").repartition(5)
    out = running_sums(df, [F.desc("k")], {"above": "v", "place": F.lit(1)})
    assert out.columns == ["k", "v", "_g", "above", "place"]
    want, total = [], 0
    for place, (k, v, g) in enumerate(sorted(rows, reverse=True)):
        want.append((k, v, g, total, place))
        total += v or 0
    assert sorted(map(tuple, out.collect()), reverse=True) == want


def test_no_task_sees_all_rows(spark):
    rows = spark.range(50_000).withColumn("score", F.col("id") * 1.0).withColumn("label", (F.col("id") % 3 == 0).cast("int"))
    curve = curves.score_curve(rows)
    assert "SinglePartition" not in plan(curve)
    assert "SinglePartition" not in plan(categories.category_ranks(rows.withColumn("name", F.col("id").cast("string")), "name"))
    placed = running_sums(rows, [F.asc("id")], {"n": F.lit(1)}).withColumn("part", F.spark_partition_id())
    sizes = [r["count"] for r in placed.groupBy("part").count().collect()]
    assert max(sizes) < 50_000 / 2


def plain_areas(rows):
    known = [(s, y) for s, y in rows if s is not None and y is not None]
    p, n = sum(y == 1 for _, y in known), sum(y != 1 for _, y in known)
    if not p or not n:
        return None, None
    # As Spark orders doubles: NaN is above all.
    scores = sorted({(s != s, 0.0 if s != s else s) for s, _ in known}, reverse=True)
    hits = falls = roc = pr = 0
    before = None
    for key in scores:
        here = [y for s, y in known if (s != s, 0.0 if s != s else s) == key]
        hits_0, falls_0 = hits, falls
        hits, falls = hits + here.count(1), falls + len(here) - here.count(1)
        after = hits / (hits + falls)
        roc += (falls - falls_0) / n * (hits + hits_0) / 2 / p
        pr += (hits - hits_0) / p * (after + (after if before is None else before)) / 2
        before = after
    return roc, pr


@pytest.mark.parametrize("kind", ["mixed", "ties", "one class", "empty"])
def test_areas_equal_plain_ones(spark, kind):
    rng = random.Random(kind)
    if kind == "mixed":
        rows = [(rng.choice([None, math.nan, math.inf, -math.inf, rng.random(), 0.5]), rng.choice([0, 1, 1, None])) for _ in range(400)]
    elif kind == "ties":
        rows = [(float(rng.randrange(3)), int(rng.random() < 0.3)) for _ in range(500)]
    else:
        rows = [(rng.random(), 1) for _ in range(20)] if kind == "one class" else []
    df = spark.createDataFrame(rows, "score DOUBLE, label INT").repartition(4)
    got = curves.score_areas(curves.score_curve(df)).first()
    for a, b in zip(got, plain_areas(rows)):
        assert a == b if b is None else abs(a - b) < 1e-12


def accounts(n):
    rng = random.Random(n)
    hot = [(k, "hot") for k in range(n // 3)]
    return hot + [(n + k, rng.choice([None, "", *(f"a{rng.randrange(4 * n)}" for _ in range(6))])) for k in range(n)]


@pytest.mark.parametrize("limit", [1 << 20, 0])
@pytest.mark.parametrize("few", [1_024, 3])
def test_ranks_by_count_and_name(spark, monkeypatch, limit, few):
    monkeypatch.setattr(categories, "HOT_RANKS", few)
    rows = accounts(300)
    df = spark.createDataFrame(rows, "id INT, account STRING").repartition(6)
    counts = Counter(a for _, a in rows if a is not None)
    order = sorted(counts, key=lambda a: (-counts[a], a))
    ranks = categories.category_ranks(df, "account")
    assert sorted(map(tuple, ranks.collect())) == sorted((a, counts[a], k) for k, a in enumerate(order))
    more = df.unionByName(spark.createDataFrame([(-1, "unknown")], df.schema))
    out = categories.with_ranks(more, "account", ranks, "index", broadcast_bytes=limit)
    place = {a: float(k) for k, a in enumerate(order)}
    assert Counter(map(tuple, out.collect())) == Counter((i, a, place.get(a)) for i, a in [*rows, (-1, "unknown")])


def test_rows_of_a_hot_value_or_without_one_are_spread(spark):
    df = spark.range(20_000).withColumn("account", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("a"), "id")))
    ranks = categories.category_ranks(df, "account")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        out = categories.with_ranks(df, "account", ranks, "index", broadcast_bytes=0).withColumn("part", F.spark_partition_id())
        sizes = [r["count"] for r in out.groupBy("part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_collisions_tell_what_shares_a_slot(spark):
    rows = accounts(200)
    df = spark.createDataFrame([(i, a, None if i % 2 else f"b{i % 7}") for i, a in rows], "id INT, account STRING, kind STRING")
    slots = categories.hashed_counts(df, ["account", "kind"], 16).collect()
    assert all((r["account"] is None) == (r["slot_account"] is None) for r in slots)
    assert all(0 <= r["slot_account"] < 16 for r in slots if r["account"] is not None)
    held = {}
    for r in slots:
        for c in ("account", "kind"):
            if r[c] is not None:
                held.setdefault(r[f"slot_{c}"], Counter())[c, r[c]] += 1
    want = sorted((s, len(c), sum(c.values()), max(c.values())) for s, c in held.items() if len(c) > 1)
    assert sorted(map(tuple, categories.collisions(df, ["account", "kind"], 16).collect())) == want
    assert categories.collisions(df.limit(0), ["account"], 16).count() == 0
