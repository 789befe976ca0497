"""A Merkle manifest of a table: one tree of hashes per group of rows, and one over their roots.

Every 8 consecutive nodes of a level become one node of the next. A tree is cut into
aligned blocks of 4 steps, up to 4,096 nodes each with all that is made from them.
Within a block the nodes lie in the van Emde Boas order: the tree is split at half of
its height, the upper part is stored first, then the lower subtrees one after another,
each in the same order again. Where a node lies follows from its depth and number by
arithmetic alone (`address`), so a block is built and read without pointers, and a walk
to the root stays within few runs of memory whatever the size of a cache line or page.

Blocks are built in parallel; their roots are the lowest nodes of the next tier of
blocks, until one block is left. A proof is read downwards the same way: a block gets
the siblings above it with its own row and adds its own for each of its nodes. No task
holds more than a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paywarden.llm.storage import written

FAN = 8
STEPS = 4  # of a block, from its lowest nodes to its root
WIDE = FAN**STEPS  # lowest nodes of a block
DIGEST = 32  # bytes
HEX = 2 * DIGEST
PATH = "array<struct<before: string, after: string>>"

ROW = ("doc_id", "source", "lang", "n_chars", "text")


# --- one block -------------------------------------------------------------------


def size(levels: int) -> int:
    """Places of a block with so many levels of nodes."""
    return (FAN**levels - 1) // (FAN - 1)


@lru_cache(maxsize=4 * size(STEPS + 1))
def address(levels: int, depth: int, number: int) -> int:
    """Place of a node in the van Emde Boas order: the `number`-th of those that are `depth` below the root."""
    if levels == 1:
        return 0
    upper = levels // 2
    if depth < upper:
        return address(upper, depth, number)
    below = FAN ** (depth - upper)
    subtree = size(upper) + number // below * size(levels - upper)
    return subtree + address(levels - upper, depth - upper, number % below)


def joined(digests: list[bytes]) -> bytes:
    """The node made from a run of nodes."""
    return hashlib.sha256("".join([d.hex() for d in digests]).encode()).digest()


def _fill(block: bytearray, at: int, levels: int, lowest: list[bytes]) -> bytes:
    """Store the tree over the lowest nodes from place `at` on; its root.

    The lower subtrees come first, as the upper part is made from their roots.
    """
    if levels == 1:
        block[at * DIGEST : (at + 1) * DIGEST] = lowest[0]
        return lowest[0]
    upper, lower = levels // 2, levels - levels // 2
    wide, first = FAN ** (lower - 1), at + size(upper)
    roots = [
        _fill(block, first + k // wide * size(lower), lower, lowest[k : k + wide]) for k in range(0, len(lowest), wide)
    ]
    return _fill(block, at, upper, [joined(roots[k : k + FAN]) for k in range(0, len(roots), FAN)])


def built(lowest: list[bytes], steps: int) -> bytes:
    """The block over some nodes. Its root is at place 0; places of nodes that are not there hold zeros."""
    block = bytearray(size(steps + 1) * DIGEST)
    _fill(block, 0, steps + 1, lowest)
    return bytes(block)


def siblings(block: str, steps: int, lowest: int, number: int) -> list[tuple[str, str]]:
    """What stands before and after a lowest node and its ancestors in their runs, step by step up to the root.

    `block` is in hexadecimal and was built over `lowest` nodes.
    """
    path, there = [], lowest
    for depth in range(steps, 0, -1):
        first = number // FAN * FAN
        run = [
            block[at : at + HEX]
            for k in range(first, min(first + FAN, there))
            for at in (address(steps + 1, depth, k) * HEX,)
        ]
        path.append(("".join(run[: number - first]), "".join(run[number - first + 1 :])))
        number, there = number // FAN, -(-there // FAN)
    return path


def folded(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for before, after in path:
        leaf = hashlib.sha256(f"{before}{leaf}{after}".encode()).hexdigest()
    return leaf


def _steps(total: int) -> int:
    """Steps of the block above `total` nodes of its tree: as many as are needed, up to those of a block."""
    steps = 0
    while steps < STEPS and FAN**steps < total:
        steps += 1
    return steps


def _present(total: int, block: int) -> int:
    """How many of the `total` nodes lie in a block."""
    return min(WIDE, total - block * WIDE)


# --- trees of any size -------------------------------------------------------------


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows of (tree, *order, copies, ...) with `first`, the number of the first copy in its tree, and `total`, that of all.

    Rows are dealt out by ranges of the order and numbered range by range: a total for
    each tree and range, sums of these before it, and a sum within it. No tree, and no
    row with many copies, has to fit a task.
    """
    dealt = written(rows.repartitionByRange("tree", *order).withColumn("range", F.spark_partition_id()))
    held = dealt.groupBy("tree", "range").agg(F.sum("copies").alias("held"))
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select(
        "tree",
        "range",
        F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"),
        F.sum("held").over(of_tree).alias("total"),
    )
    within = Window.partitionBy("tree", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("first", F.coalesce(F.sum("copies").over(within), F.lit(0)))
    return (
        local.join(offsets, ["tree", "range"])
        .withColumn("first", F.col("first") + F.col("offset"))
        .drop("range", "offset")
    )


def in_blocks(rows: DataFrame) -> DataFrame:
    """Placed rows, one for each block that they have copies in, with the numbers `low` to `high` (not included) there."""
    last = F.col("first") + F.col("copies")
    block = F.explode(F.sequence((F.col("first") / WIDE).cast("long"), ((last - 1) / WIDE).cast("long")))
    return rows.withColumn("block", block).withColumns(
        {
            "low": F.greatest(F.col("first"), F.col("block") * WIDE) - F.col("block") * WIDE,
            "high": F.least(last, (F.col("block") + 1) * WIDE) - F.col("block") * WIDE,
        }
    )


def _built(key: tuple, rows: pa.Table) -> pa.Table:
    total, block = rows["total"][0].as_py(), key[1].as_py()
    lowest = [b""] * _present(total, block)
    for leaf, low, high in zip(*(rows[c].to_pylist() for c in ("digest", "low", "high"))):
        lowest[low:high] = [bytes.fromhex(leaf)] * (high - low)
    nodes = built(lowest, _steps(total))
    return pa.table({"tree": [key[0].as_py()], "block": [block], "total": [total], "nodes": pa.array([nodes], pa.binary())})


def tiers(rows: DataFrame) -> list[DataFrame]:
    """(tree, block, total, nodes) for the blocks over placed rows, for those over their roots, and so on.

    A tree whose tier has one block ends there.
    """
    largest = rows.agg(F.max("total")).first()[0] or 0
    found = []
    while True:
        near = in_blocks(rows).select("tree", "block", "total", "digest", "low", "high")
        blocks = near.groupBy("tree", "block").applyInArrow(_built, "tree string, block long, total long, nodes binary")
        found.append(written(blocks))
        if largest <= WIDE:
            return found
        largest = -(-largest // WIDE)
        rows = found[-1].where(F.col("total") > WIDE).select(
            "tree",
            F.col("block").alias("first"),
            F.lit(1).cast("long").alias("copies"),
            F.ceil(F.col("total") / WIDE).alias("total"),
            root_of("nodes").alias("digest"),
        )


def root_of(nodes: str) -> Column:
    return F.lower(F.hex(F.substring(nodes, 1, DIGEST)))


def roots(found: list[DataFrame]) -> DataFrame:
    """(tree, digest) for each tree."""
    ended = [t.where(F.col("total") <= WIDE).select("tree", root_of("nodes").alias("digest")) for t in found]
    out = ended[0]
    for more in ended[1:]:
        out = out.unionByName(more)
    return out


def _below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            steps, there, text = _steps(row["total"]), _present(row["total"], row["block"]), row["nodes"].hex()
            paths = [
                [{"before": a, "after": b} for a, b in siblings(text, steps, there, k)] + row["path"] for k in range(there)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["tree"]] * there, pa.string()),
                    pa.array(range(row["block"] * WIDE, row["block"] * WIDE + there), pa.int64()),
                    pa.array(paths, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))),
                    pa.array([row["subroot"]] * there, pa.string()),
                    pa.array([row["root"]] * there, pa.string()),
                ],
                names=["tree", "block", "path", "subroot", "root"],
            )


def below(blocks: DataFrame) -> DataFrame:
    """(tree, number, path, subroot, root) for each lowest node of blocks that know the path above them."""
    return blocks.mapInArrow(_below, f"tree string, block long, path {PATH}, subroot string, root string")


def with_paths(found: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest blocks, each with the siblings above it, its subroot and the root.

    `above` has those (tree, path, subroot, root) for the root of each tree.
    """
    paths = None
    for k in reversed(range(len(found))):
        blocks = found[k].where(F.col("total") <= WIDE).join(above, "tree")
        if paths is not None:
            blocks = blocks.unionByName(found[k].where(F.col("total") > WIDE).join(paths, ["tree", "block"]))
        if k:
            paths = below(blocks)
    return blocks


# --- the manifest of a table -------------------------------------------------------


def leaf(text: Column | None = None) -> Column:
    """Hash of a row of documents, or of the row with another text.

    A value is `-` if null, else its number of bytes, `:` and itself.
    """
    values = [F.col(f"`{c}`").cast("string") for c in ROW[:-1]] + [F.col("text").cast("string") if text is None else text]
    said = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*said), 256)


@dataclass(frozen=True)
class Manifest:
    """Placed leaves, the blocks of their trees, and the root of all."""

    leaves: DataFrame
    blocks: list[DataFrame]
    above: DataFrame  # tree, path, subroot, root
    root: str


def manifest(docs: DataFrame, claimed: Column | None = None) -> Manifest | None:
    """The manifest of documents, a tree for each lang; None for an empty table.

    Leaves ascend by doc_id, null first, rows with one id by their hash. Repeated rows are
    counted before they meet and stand side by side. Only the columns of `ROW` are read,
    so others may have any name; each of them may be null. `claimed` is a leaf (or null:
    the same) that is proved later instead of the true one.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))  # null is first
    rows = docs.select(tree.alias("tree"), "doc_id", leaf().alias("digest"), (F.lit(None) if claimed is None else claimed).cast("string").alias("claimed"))
    counted = rows.groupBy("tree", "doc_id", "digest", "claimed").agg(F.count("*").alias("copies"))
    leaves = written(placed(counted, ["doc_id", "digest", "claimed"]))
    blocks = tiers(leaves)
    subroots = roots(blocks).select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "digest", F.lit(1).cast("long").alias("copies"))
    subroots = written(placed(subroots, ["lang"]))
    if subroots.isEmpty():
        return None
    top = tiers(subroots)
    root = roots(top).first()["digest"]
    start = docs.sparkSession.createDataFrame([("", [], root, root)], f"tree string, path {PATH}, subroot string, root string")
    paths = below(with_paths(top, start)).select(F.col("block").alias("first"), "path", "root")
    above = subroots.join(paths, "first").select(F.col("lang").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    return Manifest(leaves, blocks, written(above), root)


def proved(of: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for each row of the documents.

    The proof of a leaf is the text of all its siblings, from the lowest to the root.
    """
    id_field = of.leaves.schema["doc_id"]

    def run(key: tuple, leaves: pa.Table, blocks: pa.Table) -> pa.Table:
        row = blocks.to_pylist()[0]
        steps, there, text = _steps(row["total"]), _present(row["total"], row["block"]), row["nodes"].hex()
        path_above = [(step["before"], step["after"]) for step in row["path"]]
        above = "".join(a + b for a, b in path_above)
        at, digests, proofs, ends = [], [], [], []
        for k, (true, claimed, low, high) in enumerate(zip(*(leaves[c].to_pylist() for c in ("digest", "claimed", "low", "high")))):
            for number in range(low, high):
                path = siblings(text, steps, there, number)
                at.append(k)
                digests.append(true)
                proofs.append(hashlib.sha256(("".join(a + b for a, b in path) + above).encode()).hexdigest())
                ends.append(folded(claimed or true, path + path_above))
        ids = leaves["doc_id"].combine_chunks().take(pa.array(at, pa.int64()))
        return pa.table(
            {
                "doc_id": ids,
                "leaf": digests,
                "subroot": [row["subroot"]] * len(at),
                "root": [row["root"]] * len(at),
                "proof_sha256": proofs,
                "folded_root": ends,
                "verified": [end == row["root"] for end in ends],
            }
        )

    kind = id_field.dataType.simpleString()
    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    near = in_blocks(of.leaves).select("tree", "block", "doc_id", "digest", "claimed", "low", "high")
    blocks = with_paths(of.blocks, of.above)
    return near.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(run, schema)


def tampered_text() -> Column:
    """The text with A-Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.col("text").cast("string"), upper, upper.lower())


def report(docs: DataFrame) -> DataFrame:
    """The proof of every document, and whether it holds when every third text was tampered with.

    A document is tampered with where 3 divides crc32 of its id; a null id is not.
    """
    chosen = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    of = manifest(docs, F.when(chosen, leaf(tampered_text())))
    if of is None:
        empty = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        return docs.sparkSession.createDataFrame([], empty)
    return proved(of)
