"""Summary tables that are kept up to date: part by part, and by a stream."""

import datetime
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from paywarden.operators import gold
from paywarden.operators.partials import Partials
from paywarden.sources.readers import read_table, stream_table
from paywarden.streaming.daily import late_events, run_daily_active
from tests.conftest import rows

SALES = "shop STRING, at DATE, amount DOUBLE"


def part(spark, seed, n=60):
    rng = random.Random(seed)
    made = [
        (rng.choice(["a", "b", None]), rng.choice([None, datetime.date(2024, 1, rng.randrange(1, 29))]), rng.choice([None, rng.randrange(10_000) / 100]))
        for _ in range(n)
    ]
    return spark.createDataFrame(made, SALES)


def kept(spark, path, calls=None):
    made = gold.weekly_sales_parts(spark, path, "at", "shop", "amount", store_type="string")
    if calls is None:
        return made
    counted = lambda df: calls.append(df) or made.partial(df)
    return Partials(spark, path, counted, made.keys, made.sums, made.schema)


def test_parts_add_up_to_the_whole(spark, layout):
    calls, whole = [], part(spark, 0, 0)
    sales = kept(spark, layout.root, calls)
    assert rows(sales.read()) == []
    for k in range(5):
        new = part(spark, k)
        assert sales.add(f"p{k}", new) and not sales.add(f"p{k}", new)
        whole = whole.unionByName(new)
        assert rows(sales.read()) == rows(gold.weekly_sales(whole, "at", "shop", "amount"))
        if k in (1, 2, 4):
            assert sales.compact() == k + 1
            assert sales.read().columns == ["week", "store", "sales", "lines"]
            assert not sales.add("p0", new)  # covered by now
    assert len(calls) == 5  # each part was aggregated once
    assert rows(kept(spark, layout.root).read()) == rows(sales.read())  # found again by a later run


def test_an_unfinished_write_does_not_count(spark, layout):
    sales = kept(spark, layout.root)
    sales.add("p0", part(spark, 0))
    before = rows(sales.read())
    # Files without the mark of a finished job: a part, and a compaction whose list is missing.
    sales.partial(part(spark, 1)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", False).parquet(f"{layout.root}/parts/p1")
    sales.read().write.parquet(f"{layout.root}/bases/1/sums")
    assert sales.parts() == ["p0"] and sales.covered() == set() and rows(sales.read()) == before
    assert sales.add("p1", part(spark, 1))
    assert sales.compact() == 2 and sales.covered() == {"p0", "p1"}
    both = part(spark, 0).unionByName(part(spark, 1))
    assert rows(sales.read()) == rows(gold.weekly_sales(both, "at", "shop", "amount"))


def test_an_empty_part_and_groups_of_null(spark, layout):
    sales = kept(spark, layout.root)
    assert sales.add("none", part(spark, 0, 0))
    assert sales.add("null", spark.createDataFrame([(None, None, None), (None, None, 2.5)], SALES))
    sales.compact()
    assert [tuple(r) for r in sales.read().collect()] == [(None, None, pytest.approx(2.5), 2)]


def event(day, user, hour=1):
    at = None if day is None else datetime.datetime(2024, 1, day, hour)
    return (user, at)


def land(spark, path, events):
    spark.createDataFrame(events, "user_id STRING, ts TIMESTAMP").coalesce(1).write.mode("append").parquet(path)


def test_days_close_in_order_and_late_events_are_left_out(spark, layout):
    source, daily = f"{layout.root}/events", f"{layout.root}/daily"
    landed = [
        [event(1, "a"), event(1, "a", 5), event(1, "b"), event(1, None), event(2, "a"), event(None, "a")],
        [event(1, "c"), event(3, "a"), event(2, "b")],  # day 1 is open until a day after the next is there
        [event(1, "d"), event(4, "z"), event(5, "z"), event(2, "e")],  # 1 is closed, 2 was closed with 3
        [event(9, "q")],
    ]
    closed = []
    for events in landed:
        land(spark, source, events)
        run_daily_active(stream_table(spark, source, "user_id STRING, ts TIMESTAMP"), daily, layout.checkpoint("daily"))
        closed.append([(r["day"].day, r["active_users"], r["events"]) for r in read_table(spark, daily).orderBy("day").collect()])
    assert closed[0] == [(1, 2, 4)] or closed[0] == []
    first = closed[-1]
    assert [d for d, *_ in first] == [1, 2, 3, 4, 5][: len(first)] and len(first) == 5
    late = {r["day"].day: (r["landed"], r["counted"], r["late"]) for r in late_events(read_table(spark, source), read_table(spark, daily)).collect()}
    counted = {d: n for d, _, n in first}
    truth = defaultdict(int)
    for user, at in (e for events in landed for e in events):
        if at is not None and at.day < 9:
            truth[at.day] += 1
    assert late == {d: (truth[d], counted[d], truth[d] - counted[d]) for d in counted}
    assert late[1][2] >= 1 and late[4][2] == 0
    for before, after in zip(closed, closed[1:]):
        assert after[: len(before)] == before  # what is closed stays as it is


def test_lateness_keeps_days_open_longer(spark, layout):
    source, daily = f"{layout.root}/events", f"{layout.root}/daily"
    for events in ([event(1, "a"), event(3, "a")], [event(1, "b")], [event(20, None)]):
        land(spark, source, events)
        stream = stream_table(spark, source, "user_id STRING, ts TIMESTAMP")
        run_daily_active(stream, daily, layout.checkpoint("daily"), lateness=5)
    found = {r["day"].day: (r["active_users"], r["events"]) for r in read_table(spark, daily).collect()}
    assert found == {1: (2, 2), 3: (1, 1)}
