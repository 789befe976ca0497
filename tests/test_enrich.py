import pytest
from pyspark.sql import functions as F

from paywarden.operators.enrich import join_members, salted_left_join
from paywarden.operators.sizing import group_numbers, hot_keys, measured_bytes
from paywarden.schemas import MEMBERS
from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def members(spark):
    return spark.createDataFrame(
        [("C1", "u1", "w1"), ("C2", "u2", "w2"), ("C2", "u2b", "w2b"), (None, "nobody", "w0"),
         ("C9", "u9", "w9")],
        MEMBERS,
    )


@pytest.fixture(scope="module")
def transactions(spark):
    """A third of the rows on one account that is listed once, a third on one that
    is listed twice, and the rest spread, unknown or without account."""
    account = (
        F.when(F.col("id") % 3 == 0, "C1")
        .when(F.col("id") % 3 == 1, "C2")
        .when(F.col("id") % 2 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("X"), (F.col("id") % 50).cast("string")))
    )
    return spark.range(3000).select(F.col("id"), account.alias("nameOrig"))


def brute_force(transactions, members):
    listed = [tuple(m) for m in members.collect()]
    expected = []
    for key, account in transactions.collect():
        hits = [(u, w) for n, u, w in listed if n is not None and n == account]
        expected += [(account, key, u, w) for u, w in hits or [(None, None)]]
    return sorted(expected, key=repr)


def test_every_way_gives_the_brute_force_result(transactions, members):
    want = brute_force(transactions, members)
    small = join_members(transactions, members)
    large = join_members(transactions, members, broadcast_bytes=0)
    assert small.columns == large.columns == ["nameOrig", "id", "userid", "webhook_url"]
    assert rows(small) == want
    assert rows(large) == want
    for hot in ({}, {"C1": 2}, {"C1": 8, "C2": 2, "X3": 4, "never seen": 2}):
        for crowded in ({}, {"C2": 4}, {"C1": 2, "C2": 8, "C9": 2}):
            got = salted_left_join(transactions, members, hot, crowded, width=8)
            assert got.columns == small.columns
            assert rows(got) == want


def test_an_account_that_is_no_longer_listed_is_kept(transactions, members):
    gone = members.filter("nameOrig <> 'C2'")
    got = salted_left_join(transactions, gone, {"C1": 2}, {"C2": 4, "C9": 2}, width=8)
    assert rows(got) == rows(join_members(transactions, gone))


def test_a_key_with_more_than_an_even_part_is_spread():
    assert group_numbers({"C1": 0.0009}, 20_000) == {"C1": 32}


def test_an_account_listed_very_often(spark, transactions):
    """A third of the member list on one account, and copies of one member row."""
    often = spark.range(90).select(
        F.when(F.col("id") % 3 == 0, "C2").otherwise(F.concat(F.lit("Z"), F.col("id").cast("string")))
        .alias("nameOrig"),
        F.concat(F.lit("u"), (F.col("id") % 20).cast("string")).alias("userid"),
        F.lit("w").alias("webhook_url"),
    )
    some = transactions.filter("id < 300")
    assert hot_keys(often, "nameOrig", share=0.3) == {"C2": 1 / 3}
    assert rows(join_members(some, often, broadcast_bytes=0)) == brute_force(some, often)


def test_broadcast_only_below_the_limit(transactions, members):
    size = measured_bytes(members)
    assert "BroadcastHashJoin" in plan(join_members(transactions, members, size))
    assert "ResolvedHint (strategy=broadcast)" not in plan(
        join_members(transactions, members, size - 1)
    )


def test_measured_bytes_follow_the_strings(spark):
    one = spark.createDataFrame([("a", "b", "c")], MEMBERS)
    long = spark.createDataFrame([("a" * 1000, None, "c")], MEMBERS)
    assert measured_bytes(one) == 16 + 3
    assert measured_bytes(long) == 16 + 1001
    assert measured_bytes(one.limit(0)) == 0


def test_hot_keys_hold_their_share(transactions):
    assert hot_keys(transactions, "nameOrig", share=0.3) == {"C1": 1 / 3, "C2": 1 / 3}
    assert len(hot_keys(transactions, "nameOrig", share=0.001)) <= 1000
    assert hot_keys(transactions.limit(0), "nameOrig", share=0.001) == {}


def test_groups_follow_the_share():
    got = group_numbers({"third": 1 / 3, "thousandth": 0.001, "all": 1.0}, width=20_000)
    assert got == {"third": 8192, "thousandth": 32, "all": 32768}
    assert group_numbers({"third": 1 / 3}, width=1) == {"third": 2}


def test_hot_rows_are_spread(spark, transactions, members):
    """No task gets much more than its part, though two accounts hold two thirds."""
    hot = group_numbers(hot_keys(transactions, "nameOrig", 1 / 64), 64)
    joined = salted_left_join(transactions, members, hot, {}, 64)
    assert "xxhash64" in plan(joined)
    deal = (
        F.when(F.col("nameOrig") == "C1", F.pmod(F.xxhash64("id", "nameOrig"), F.lit(hot["C1"])))
        .when(F.col("nameOrig") == "C2", F.pmod(F.xxhash64("id", "nameOrig"), F.lit(hot["C2"])))
        .when(F.col("nameOrig").isNull(), F.pmod(F.xxhash64("id", "nameOrig"), F.lit(64)))
        .otherwise(0)
    )
    largest = transactions.groupBy("nameOrig", deal).count().agg(F.max("count")).first()[0]
    assert largest < 3 * transactions.count() / 64
