"""Shards by a hierarchical weighted hash tree (law `key`).

A row descends region, rack and shard. On each level every child of the node
draws -ln(u) / weight, with u hashed from the row's key and the child's name, and
the smallest draw wins; so a child is chosen in proportion to its weight. When
weights change, only rows whose winner changes on the changed path move, and they
move towards the heavier subtree.

A layout is planned for a number of shards, of which some may not be in use yet. Their
leaves keep their place and weight in the tree, so opening one changes no draw; rows
whose draws end there are drawn once more, among all leaves in use. A shard that is
opened takes the rows of its leaf back and wins some of these second draws. A shard
beyond the plan becomes a region of its own, with its own rack: its path has no other
leaf, so the rows that it wins go to it alone. Either way no other row moves.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paywarden.llm.storage import written

BLOCK_ROWS = 50_000  # rows numbered by one task at a time, about


class Leaf(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0
    open: bool = True  # False: planned, not in use yet


def layout(shards: int, planned: int = 24, regions: int = 2, racks: int = 3) -> list[Leaf]:
    """Leaves for `shards` shards: the planned ones in equal regions and racks, in use or not, each further one on its own."""
    per_rack = -(-planned // (regions * racks))
    per_region = per_rack * racks
    inner = [Leaf(k // per_region, k // per_rack, k, open=k < shards) for k in range(planned)]
    return inner + [Leaf(k, k, k) for k in range(planned, shards)]


def _draw(key: Column, level: str, name: int, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(name)), 11)
    return -F.log((bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(weight))


def _winner(key: Column, level: str, weights: dict[int, float]) -> Column:
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    draws = [F.struct(_draw(key, level, name, w).alias("draw"), F.lit(name).alias("name")) for name, w in weights.items()]
    return F.least(*draws)["name"]


def _weights(leaves: Sequence[Leaf], level: str) -> dict[int, float]:
    sums: dict[int, float] = {}
    for leaf in leaves:
        sums[getattr(leaf, level)] = sums.get(getattr(leaf, level), 0.0) + leaf.weight
    return dict(sorted(sums.items()))


def shard_of(key: Column, leaves: Sequence[Leaf]) -> Column:
    """The shard of a key. A leaf of weight 0 or not in use gets nothing. A null key has a shard like any other value."""
    leaves = [leaf for leaf in leaves if leaf.weight > 0]
    used = {leaf.shard: leaf.weight for leaf in leaves if leaf.open}
    if not used:
        raise ValueError("no shard in use has a weight")
    drawn = _descend(key, leaves)
    return drawn if len(used) == len(leaves) else F.coalesce(drawn, _winner(key, "stand-in", used))


def _descend(key: Column, leaves: Sequence[Leaf], levels: Sequence[str] = ("region", "rack", "shard")) -> Column:
    """The shard of the leaf that a key comes to; null if that is not in use."""
    level, rest = levels[0], levels[1:]
    weights = _weights(leaves, level)
    won = _winner(key, level, weights)
    if not rest:
        return won if all(leaf.open for leaf in leaves) else F.when(won.isin(*(leaf.shard for leaf in leaves if leaf.open)), won)
    below = {name: _descend(key, [x for x in leaves if getattr(x, level) == name], rest) for name in weights}
    names = list(below)
    out = below[names[-1]]
    for name in names[-2::-1]:
        out = F.when(won == name, below[name]).otherwise(out)
    return out


def sharded(docs: DataFrame, leaves: Sequence[Leaf], grown: Sequence[Leaf] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row.

    `size` is the UTF-8 length of the text (null: none) plus 8, `slot` numbers the
    rows of a shard from 0 without gaps. Rows are numbered in blocks of a shard, so
    no task sorts a whole shard. Null ids share one shard; repeated rows take a slot
    each; an empty table gives no rows. Other columns are left out, whatever their names.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.col("doc_id")
    rows = written(
        docs.select(
            key,
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.lit("key").alias("law"),
            shard_of(key, leaves).cast("int").alias("shard"),
            (shard_of(key, grown) if grown else F.lit(None)).cast("int").alias("grown_shard"),
        )
    )
    blocks = max(8, rows.count() // (BLOCK_ROWS * sum(leaf.open for leaf in leaves)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(blocks)))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "block").count().select(
        "shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")
    )
    inner = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("inner", F.row_number().over(inner) - 1)
        .join(starts, ["shard", "block"])
        .select("doc_id", "size", "text_crc32", "law", "shard", (F.col("start") + F.col("inner")).alias("slot"), "grown_shard")
    )
