"""Hard negatives against all products, and the threshold against its definition."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from check_oracle import duck, spark_rows, sql_rows
from paywarden.llm import negatives, oracle, queries

SCHEMA = "vec_id long, label int, embedding array<double>, score string, uid string, place string"


def held(x):
    return max(-(1 << 63), min((1 << 63) - 1, x))


def plainly(rows, divisor=100, k=5):
    """Result rows from every product, for (vec_id, label, vector) tuples."""
    used = [
        (i, y, [held(math.floor(256 * x)) if abs(256 * x) < math.inf else held(int(math.copysign(1 << 70, x))) for x in v])
        for i, y, v in rows
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    limit = negatives.LARGEST
    out = Counter()
    for a, (anchor, label, v) in enumerate(used):
        if anchor % divisor:
            continue
        scored = [
            (max(-limit, min(limit, sum(p * q for p, q in zip(v, w)))), i, y) for b, (i, y, w) in enumerate(used) if b != a
        ]
        best = sorted((-s, i) for s, i, y in scored if y == label)[:k]
        for minus, positive in best:
            p = -minus
            hard = sorted((-s, i) for s, i, y in scored if y != label and 80 * p <= 100 * s <= 100 * p)[:k]
            out.update((anchor, positive, rank, i, p, -s) for rank, (s, i) in enumerate(hard, 1))
    return out


def mined(spark, rows, **kwargs):
    queries.ship(spark)
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    out = negatives.mined(df, lambda vec_id: vec_id % kwargs.pop("divisor", 100) == 0, **kwargs)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(map(tuple, out.collect()))


def vectors(n, dims, seed, clusters=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dims))
    return [(k, int(rng.integers(3)), (centres[k % clusters] + 0.3 * rng.standard_normal(dims)).tolist()) for k in range(n)]


def test_equals_all_products(spark, monkeypatch):
    rows = vectors(900, 12, 1)
    wanted = plainly(rows)
    assert len(wanted) > 100
    assert mined(spark, rows) == wanted
    monkeypatch.setattr(negatives, "CHUNK_BYTES", 8 * 12 * 5)  # five anchors at a time
    assert mined(spark, rows) == wanted


def test_ties_repeats_short_and_bad_vectors(spark):
    rng = random.Random(2)
    rows = [(k, k % 3, [float(rng.randrange(-2, 3)) / 4 for _ in range(3)]) for k in range(250)]  # many equal scores
    rows += [(k + 1000, k % 2, [0.5, 0.25, 0.25]) for k in range(300)]  # copies of one vector
    rows += [(100, 1, [0.5, 0.25, 0.25])] * 2 + [(100, 2, [0.25, 0.25])] + [(7, 2, [0.5, 0.25, 0.25])] * 3  # repeated ids
    rows += [(200, 0, []), (300, 0, [0.0, 0.0, 0.0]), (400, 5, [1.0, 1.0, 1.0]), (500, 1, [-1.0]), (0, 0, [0.5])]
    rows += [(600, None, [1.0]), (None, 1, [1.0]), (700, 1, None), (800, 1, [1.0, None]), (900, 1, [math.nan]), (1000, 1, [math.inf, 1.0])]
    assert mined(spark, rows) == plainly(rows)


def test_integers_beyond_what_floats_hold(spark):
    rng = random.Random(4)
    rows = [(k, k % 2, [rng.uniform(-1, 1) * 10.0 ** rng.randrange(0, 12) for _ in range(4)]) for k in range(120)]
    assert mined(spark, rows) == plainly(rows)
    rows += [(100, 1, [1e300, 1.0]), (121, 0, [1e300]), (122, 1, [1e300, 0.0, -1e300]), (123, 0, [1.5e308])]
    assert mined(spark, rows) == plainly(rows)


def test_empty_tables_and_lonely_anchors(spark):
    assert mined(spark, []) == Counter()
    assert mined(spark, [(100, None, [1.0])]) == Counter()
    assert mined(spark, [(1, 1, [1.0])]) == Counter()  # no anchor
    assert mined(spark, [(100, 1, [1.0]), (101, 2, [1.0])]) == Counter()  # no positive
    assert mined(spark, [(100, 1, [1.0]), (101, 1, [1.0])]) == Counter()  # no negative
    assert mined(spark, [(100, 1, [1.0]), (101, 1, [1.0]), (102, 2, [0.9])]) == Counter([(100, 101, 1, 102, 65536, 256 * 230)])


def test_unseen_rows_never_score_above_the_threshold():
    rng = np.random.default_rng(3)
    rows = rng.integers(-50, 50, (300, 6)).astype(float)
    lists = negatives.Lists(rows)
    anchors = rng.integers(-50, 50, (20, 6)).astype(float)
    anchors[0] = 0
    for anchor, thresholds in zip(anchors, lists.thresholds(anchors)):
        assert (rows @ anchor).max() <= thresholds[0]
        seen = np.zeros(len(rows), dtype=bool)
        read = 0
        for depth, threshold in zip(lists.depths[1:], thresholds[1:]):
            seen[lists.entries(anchor, read, depth)] = True
            read = depth
            assert not (~seen).any() or (rows @ anchor)[~seen].max() <= threshold
        assert seen.all()


def test_reading_ends_early_where_scores_differ():
    rng = np.random.default_rng(5)
    rows = np.zeros((8000, 4))
    rows[:, 0] = rng.permutation(8000)
    lists, anchor = negatives.Lists(rows), np.array([3.0, 0, 0, 0])
    window = negatives.Best(5, high=3 * 7000)
    scored = negatives.scan(lists, anchor, lists.thresholds(anchor[None])[0], np.ones(8000, dtype=bool), np.arange(8000), [window])
    assert scored < 2500 and window.scores.tolist() == [21000, 20997, 20994, 20991, 20988]


def test_query_equals_sql(spark, sf):
    out = queries.QUERIES["op13_negatives"](spark, sf)
    assert out.count() > 0
    assert spark_rows(out) == sql_rows(duck(sf), oracle.NEGATIVES)
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    )
    assert Counter(map(tuple, out.collect())) == plainly([(r["vec_id"], r["label"], r["embedding"]) for r in rows.collect()])


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.1"])
def test_query_equals_sql_on_more_rows(spark, sf_dir):
    assert spark_rows(queries.QUERIES["op13_negatives"](spark, sf_dir)) == sql_rows(duck(sf_dir), oracle.NEGATIVES)
