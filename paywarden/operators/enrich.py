"""Left join of transactions (batch or stream) with a member list.

Every transaction is kept. One without a member, or without an account name,
gets null member columns; one whose account is listed twice comes out twice.
"""

from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paywarden.operators.sizing import (
    BROADCAST_BYTES, group_numbers, hot_keys, measured_bytes,
)

KEY = "nameOrig"


def join_members(
    transactions: DataFrame,
    members: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    history: DataFrame | None = None,
) -> DataFrame:
    """Transactions with `userid` and `webhook_url`, `nameOrig` first.

    A member list that measures at most `broadcast_bytes` is broadcast and the
    transactions do not move. A larger one is joined by shuffling both sides;
    which accounts are hot is then counted in `history`, a batch frame, by
    default the transactions themselves unless they are a stream.
    """
    if measured_bytes(members) <= broadcast_bytes:
        return transactions.join(F.broadcast(members), KEY, "left")
    if history is None and not transactions.isStreaming:
        history = transactions
    hot = {} if history is None else hot_keys(history, KEY, hot_share(transactions.sparkSession))
    return join_by_shuffle(transactions, members, hot)


def hot_share(spark: SparkSession) -> float:
    """The share of the rows from which on an account is worth spreading: an even part of the shuffle."""
    return 1 / int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_by_shuffle(transactions: DataFrame, members: DataFrame, hot: Mapping[str, float]) -> DataFrame:
    """The join for a member list of any size; `hot` are the shares of accounts with many transactions."""
    spark = transactions.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    crowded = group_numbers(hot_keys(members, KEY, hot_share(spark)), width)
    return salted_left_join(transactions, members, group_numbers(hot, width), crowded, width)


def salted_left_join(
    transactions: DataFrame,
    members: DataFrame,
    hot: Mapping[str, int],
    crowded: Mapping[str, int],
    width: int,
) -> DataFrame:
    """The same join by shuffle, with large groups spread over several tasks.

    `hot` accounts have many transactions: these are dealt to the given number of
    groups, and the members of the account are copied to each group.
    `crowded` accounts are listed many times: their member rows are dealt out, and
    the transactions of the account are copied to each group. A group may lack a
    partner, so unmatched copies are left out; a marker for each account that is
    listed tells whether the copy in the first group stands for one that is not.
    Transactions without account match nothing and are dealt to `width` groups.

    Rows are dealt by a hash of all their values, so that a retried task deals
    them the same way. Which accounts are named affects the speed only.
    """
    left = transactions.withColumn(
        "_deal",
        F.when(F.col(KEY).isNull(), _group(transactions.columns, width)).otherwise(
            _dealt(hot, transactions.columns)
        ),
    ).withColumn("_seat", _copies(crowded))
    listed = members.filter(F.col(KEY).isNotNull())
    right = listed.withColumn("_seat", _dealt(crowded, members.columns)).withColumn("_row", F.lit(True))
    if crowded:
        marks = listed.filter(_among(crowded)).select(KEY).distinct()
        marks = marks.withColumn("_seat", F.lit(0)).withColumn("_row", F.lit(False))
        right = right.unionByName(marks, allowMissingColumns=True)
    right = right.withColumn("_deal", _copies(hot))
    matched, alone = F.col("_row"), F.col("_row").isNull() & (~_among(crowded) | (F.col("_seat") == 0))
    return (
        left.join(right, [KEY, "_deal", "_seat"], "left")
        .filter(F.coalesce(matched, alone))
        .drop("_deal", "_seat", "_row")
    )


def _among(keys: Collection[str]) -> Column:
    """Whether the account is one of `keys`; false for none."""
    return F.coalesce(F.col(KEY).isin(list(keys)), F.lit(False)) if keys else F.lit(False)


def _group(columns: Sequence[str], groups: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(groups)).cast("int")


def _dealt(spread: Mapping[str, int], columns: Sequence[str]) -> Column:
    """A group number by hash; 0 for accounts that are not spread."""
    return _by_groups(spread, lambda n: _group(columns, n), F.lit(0))


def _copies(spread: Mapping[str, int]) -> Column:
    """The row once per group; once, with 0, for accounts that are not spread."""
    numbers = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    return F.explode(_by_groups(spread, numbers, F.array(F.lit(0))))


def _by_groups(
    spread: Mapping[str, int], value: Callable[[int], Column], default: Column
) -> Column:
    """`value` of the number of groups of the account. There are few different
    numbers, so this is a short chain of set lookups."""
    case = default
    for n in sorted(set(spread.values())):
        case = F.when(_among([k for k, m in spread.items() if m == n]), value(n)).otherwise(case)
    return case
