"""N-gram Jaccard join with adaptive multi-match prefixes.

Shingles are ordered from rare to frequent by the smaller of two bounds on the number
of documents that hold them, from sketches of all documents: how many have a shingle of
the same counter, and how often the rarest of its words occurs. The first tells frequent
phrases of frequent words; the second still tells rare from frequent when there are many more
shingles than counters, as words are far fewer. A document's base prefix holds a shingle of every document that is
similar enough. Where the prefix has frequent shingles, and so many candidates, it is
made longer by l - 1 shingles; then two documents must share as many prefix shingles
as the smaller of their two l, before they are verified on their whole sets.

Documents with equal sets are one node. Nodes that share a prefix shingle meet in
one group: the shingle's leader, the smallest prefix shingle of any node that has it.
So near copies, which share many shingles, meet once or twice and not for each
shingle. Small groups are put together and large ones cut into blocks of bounded
size. First only prefixes meet, to find the nodes that have a candidate at all; then
the texts of those nodes, where each pair of blocks is a task that gives a spanning
forest of the links it finds, never all pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.llm.graph import components
from paywarden.llm.storage import unused, written
from paywarden.llm.words import SOLID, chained, hashed_words, text_slices
from paywarden.operators.sizing import measured_bytes

SKETCH_BITS = 24  # counters of a sketch, a byte each; it decides the order only, never a result
SLICES = 128  # parts that the two sketches are summed in
STEPS = 12  # of a byte for each doubling of a count
MOST_MATCHES = 4  # largest l
VERIFY_COST = 20  # of a candidate, in postings read
BROADCAST_BYTES = 32 << 20  # of node names that are sent to all tasks; beyond it they are joined by shuffle
BLOCK_SHINGLES = 400_000  # of a block of texts
BLOCK_PREFIXES = 400_000  # shingles of a block of prefixes


COUNTER = np.uint64(64 - SKETCH_BITS)


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, width: int, words: np.ndarray | None = None
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The sorted distinct shingles of each text, and for each shingle the least of what `words` has for its words.

    A text of fewer words is one shingle, one without words has none. Without `words`
    there are no bounds.
    """
    hashes, firsts = hashed_words(data, offsets, SOLID)
    whole = len(hashes) >= width
    grams = chained(*(hashes[k : len(hashes) - width + 1 + k] for k in range(width))) if whole else hashes[:0]
    bounds = None if words is None else words[hashes >> COUNTER]
    least = bounds
    if bounds is not None and whole:
        least = np.minimum.reduce([bounds[k : len(hashes) - width + 1 + k] for k in range(width)])
    sets, found = [], []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= width and least is None:
            sets.append(np.unique(grams[a : b - width + 1]))
        elif b - a >= width:
            some, at = np.unique(grams[a : b - width + 1], return_index=True)
            sets.append(some)
            found.append(least[a + at])
        else:
            sets.append(chained(*(hashes[k : k + 1] for k in range(a, b))) if b > a else hashes[:0])
            if bounds is not None:
                found.append(bounds[a:b].min(initial=255, keepdims=True)[: len(sets[-1])])
    return sets, found


class Prefixes:
    """Prefixes by the sketches, for a similarity of `percent`."""

    def __init__(self, steps: np.ndarray, percent: int):
        self.steps, self.percent = steps, percent
        self.counts = 2.0 ** (np.arange(256) / STEPS) - 1
        self.load = self.counts[int(np.median(steps))]  # what a counter has from shingles that just share it

    def least_overlap(self, n: int) -> int:
        return -(-self.percent * n // 100)

    def of(self, shingles: np.ndarray, bounds: np.ndarray | None = None) -> np.ndarray:
        """The prefix, from rare to frequent; how much longer it is than the base prefix tells l.

        `bounds` are those of the words, on the scale of the sketch.
        """
        n = len(shingles)
        if not n:
            return shingles
        counts = self.steps[shingles >> COUNTER]
        # A word that occurs less often than shingles share a counter says more than the counter.
        expected = np.maximum(self.counts[counts] - self.load, 0.0)
        if bounds is not None:
            counts = np.minimum(counts, bounds)
            expected = np.minimum(expected, self.counts[bounds])
        base, most = n - self.least_overlap(n) + 1, min(MOST_MATCHES, self.least_overlap(n))
        longest = base + most - 1
        near = np.argpartition(counts, longest - 1)[:longest] if longest < n else np.arange(n)
        if longest < n:  # ties at the rim are settled by the shingle
            rim = counts[near].max()
            near = np.concatenate([np.flatnonzero(counts < rim), np.flatnonzero(counts == rim)])
        order = near[np.lexsort((shingles[near], counts[near]))][:longest]
        read = np.cumsum(expected[order])[base - 1 :]
        cost = read * (1 + VERIFY_COST / np.arange(1, most + 1))
        matches = int(np.argmin(cost)) + 1
        return shingles[order[: base + matches - 1]]


def packed_counts(counts: np.ndarray) -> bytes:
    """Counts as compressed bytes, and the few that do not fit a byte beside them."""
    large = np.flatnonzero(counts >= 255)
    rest = np.concatenate([[len(large)], large, counts[large].astype(np.int64)]).astype("<i8")
    return rest.tobytes() + zlib.compress(np.minimum(counts, 255).astype(np.uint8).tobytes(), 3)


def unpacked_counts(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    rest = np.frombuffer(data, "<i8", 2 * n, 8)
    counts = np.frombuffer(zlib.decompress(data[8 + 16 * n :]), np.uint8).astype(np.int64)
    counts[rest[:n]] = rest[n:]
    return counts


def add_to(counters: np.ndarray, at: np.ndarray) -> None:
    """Count up the counters at some places; a counter of 16 bits stays at half of its range."""
    most = np.uint16(1 << 15)
    for first in range(0, len(at), int(most) - 1):  # fewer than would make it overflow
        some = at[first : first + int(most) - 1]
        np.add.at(counters, some, np.uint16(1))
        counters[some] = np.minimum(counters[some], most)


def sketches(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """How many documents have shingles of each counter, and how often words of each occur, on a scale of bytes.

    The result has a fixed size.
    """
    size = 1 << SKETCH_BITS
    texts = docs.select(docs["text"].cast("string").alias("_text"))
    salts = int(np.ceil(np.sqrt(texts.rdd.getNumPartitions())))  # so that neither sum has many parts

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, task = np.zeros(2 * size, np.uint16), 0
        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0)):
                task ^= xxhash.xxh32_intdigest(data[:4096])
                sets, _ = shingle_sets(data, offsets, width)
                words, _ = hashed_words(data, offsets, SOLID)
                add_to(total, (np.concatenate(sets) >> COUNTER).astype(np.int64))
                add_to(total, (words >> COUNTER).astype(np.int64) + size)
        if total.any():
            parts = [packed_counts(x) for x in np.split(total, SLICES)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SLICES), pa.int32()), pa.array([task % salts] * SLICES, pa.int32()), pa.array(parts, pa.binary())],
                names=["slice", "salt", "counts"],
            )

    def summed(rows: pd.DataFrame) -> np.ndarray:
        return sum(map(unpacked_counts, rows["counts"]), np.zeros(2 * size // SLICES, np.int64))

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"slice": rows["slice"].iloc[:1], "salt": [0], "counts": [packed_counts(summed(rows))]})

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        steps = np.minimum(255, np.rint(STEPS * np.log2(1.0 + summed(rows)))).astype(np.uint8)
        return pd.DataFrame({"slice": rows["slice"].iloc[:1], "salt": [0], "counts": [steps.tobytes()]})

    schema = "slice int, salt int, counts binary"
    parts = texts.mapInArrow(count, schema)
    sums = parts.groupBy("slice", "salt").applyInPandas(add, schema).groupBy("slice").applyInPandas(finish, schema)
    out = np.zeros((SLICES, 2 * size // SLICES), np.uint8)
    for row in sums.collect():  # SLICES rows, 32 MB together
        out[row["slice"]] = np.frombuffer(row["counts"], np.uint8)
    return out.ravel()[:size], out.ravel()[size:]


def gathered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All positions of the ranges [a, b), one range after the other."""
    counts = b - a
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(a, counts)


class PrefixIndex:
    """Candidates among nodes, from their prefixes and sizes."""

    def __init__(self, prefixes: list[np.ndarray], sizes: np.ndarray, percent: int):
        self.percent, self.sizes, self.n = percent, sizes, len(prefixes)
        lengths = np.array([len(t) for t in prefixes])
        base = sizes - -(-percent * sizes // 100) + 1
        self.matches = np.maximum(lengths - base + 1, 0)
        self.ends = np.concatenate([[0], np.cumsum(lengths)])
        tokens, owner = np.concatenate(prefixes), np.repeat(np.arange(self.n), lengths)
        self.levels = np.maximum(np.arange(len(tokens)) - self.ends[owner] - base[owner] + 2, 1)
        order = np.argsort(tokens, kind="stable")
        self.owner, self.level = owner[order], self.levels[order]
        self.low = np.searchsorted(tokens[order], tokens, "left")
        self.high = np.searchsorted(tokens[order], tokens, "right")

    def candidates(self, x: int) -> np.ndarray:
        """Later nodes that share as many prefix shingles with x as they must, and are near in size."""
        a, b = self.ends[x], self.ends[x + 1]
        if a == b or (self.high[a:b] - self.low[a:b]).max() < 2:
            return np.zeros(0, np.int64)
        low, high = self.low[a:b], self.high[a:b]
        at = gathered(low, high)
        other = self.owner[at]
        level = np.maximum(np.repeat(self.levels[a:b], high - low), self.level[at])
        other = other[(other > x) & (level <= np.minimum(self.matches[x], self.matches[other]))]
        near, shared = np.unique(other, return_counts=True)
        near = near[shared >= np.minimum(self.matches[x], self.matches[near])]
        sizes = self.sizes[near]
        return near[100 * np.minimum(sizes, self.sizes[x]) >= self.percent * np.maximum(sizes, self.sizes[x])]


def forest(sets: list[np.ndarray], chosen: list[np.ndarray], percent: int, sides: np.ndarray | None) -> list[tuple[int, int]]:
    """Links that join the components of the sets, as (smallest of the component, other).

    `chosen` are their prefixes. `sides` (0 or 1) limits the comparison to pairs across; None compares all.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    index = PrefixIndex(chosen, sizes, percent)
    root = np.arange(n)
    # Whole sets as postings, for nodes with many candidates.
    whole = np.concatenate(sets)
    order = np.argsort(whole, kind="stable")
    whole, owner = whole[order], np.repeat(np.arange(n), sizes)[order]
    for x in range(n):
        near = index.candidates(x)
        near = near[root[near] != root[x]]
        if sides is not None:
            near = near[sides[near] != sides[x]]
        if not len(near):
            continue
        if len(near) > 16:
            s = sets[x]
            both = np.bincount(owner[gathered(np.searchsorted(whole, s, "left"), np.searchsorted(whole, s, "right"))], minlength=n)[near]
        else:
            both = np.array([np.isin(sets[y], sets[x], assume_unique=True).sum() for y in near])
        for y in near[100 * both >= percent * (sizes[x] + sizes[near] - both)].tolist():
            if root[y] != root[x]:
                keep, gone = sorted((int(root[x]), int(root[y])))
                root[root == gone] = keep
    return [(int(r), k) for k, r in enumerate(root) if r != k]


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts packed for the way to the task where they meet."""
    for batch in batches:
        raw = batch.column(batch.num_columns - 1).cast(pa.large_binary())
        packed = [zlib.compress(x.as_py() or b"", 3) for x in raw]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(packed, pa.binary())], names=[*batch.schema.names[:-1], "_packed"])


def _row_key(docs: DataFrame):
    """Names a row by its id and text; rows equal in both are one node."""
    return F.xxhash64(docs["doc_id"], F.xxhash64(docs["text"].cast("string")))


def _dealt(groups: DataFrame, weight: Column, most: int) -> DataFrame:
    """(place, i, j, mine, node): where the nodes of a group meet.

    Groups of less than `most` are put together in places of about that weight; larger
    ones are places of their own, cut into blocks, of which each two, i and j, meet.
    """
    weighed = groups.withColumn("weight", weight)
    total = weighed.agg(F.sum("weight")).first()[0] or 0
    sizes = weighed.groupBy("leader").agg(F.ceil(F.sum("weight") / most).cast("int").alias("blocks"))
    small = F.col("blocks") <= 1
    place = F.when(small, F.pmod(F.xxhash64("leader"), F.lit(int(total // most) + 1))).otherwise(F.col("leader"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return (
        weighed.join(sizes, "leader")
        .select(F.struct(small, place.alias("of")).alias("place"), "node", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.greatest("blocks", F.lit(1)) - 1)).alias("other"))
        .select("place", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node")
        .distinct()
    )


def placed(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, node, n_shingles, component_id, stays (the node of the component that a choice of one keeps), for each row.

    Two documents link when 100 * shared >= percent * all shingles of both. A
    component_id is the smallest doc_id that links lead to. Documents without words
    (null and empty texts too) link with nothing and keep their own id. Repeated rows
    come out repeated, in one component; null ids take part and are never the smallest,
    and a component without any id has null. Other columns are ignored. `stays` is the node with the smallest id, null without words.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", _row_key(docs).alias("node"), docs["text"].cast("string").alias("_text"))
    shared = spark.sparkContext.broadcast(sketches(docs, width))  # twice 2 ** SKETCH_BITS counters

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, words = shared.value
        prefixes = Prefixes(steps, percent)
        for batch in batches:
            rows: list[tuple] = []
            for _, data, offsets in text_slices(batch.column(2)):
                for s, bounds in zip(*shingle_sets(data, offsets, width, words)):
                    rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None, prefixes.of(s, bounds).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([n for n, _, _ in rows], pa.int64()),
                    pa.array([k for _, k, _ in rows], pa.binary()),
                    pa.array([t for _, _, t in rows], pa.list_(pa.int64())),
                ],
                names=["doc_id", "node", "n_shingles", "same", "prefix"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = written(texts.mapInArrow(sign, f"doc_id {kind}, node long, n_shingles long, same binary, prefix array<long>"))
    nodes = signed.where("same IS NOT NULL").groupBy("same").agg(
        F.min("node").alias("node"), F.min("doc_id").alias("least"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("first"), F.first("n_shingles").alias("n"), F.first("prefix").alias("prefix"),
    )
    nodes = written(nodes)
    postings = nodes.select("node", "n", F.explode("prefix").alias("token"))
    often = postings.groupBy("token").agg(F.count("*").alias("df")).where("df > 1").select("token")
    met = written(postings.join(often, "token"))
    leaders = met.join(met.groupBy("node").agg(F.min("token").alias("own")), "node").groupBy("token").agg(F.min("own").alias("leader"))
    groups = written(met.join(leaders, "token").select("leader", "node", "n").distinct())

    def candidates(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("node")
        index = PrefixIndex([np.asarray(t, dtype=np.int64) for t in rows["prefix"]], rows["n"].to_numpy(), percent)
        sides = (rows["mine"] == rows["i"]).to_numpy() if rows["i"].iloc[0] != rows["j"].iloc[0] else None
        some = np.zeros(len(rows), dtype=bool)
        for x in range(len(rows)):
            near = index.candidates(x)
            near = near if sides is None else near[sides[near] != sides[x]]
            some[near] = True
            some[x] |= len(near) > 0
        return pd.DataFrame({"node": rows["node"][some]})

    share = (100 - percent) / 100  # of a set that is its prefix, about
    sized = lambda df: F.broadcast(df) if measured_bytes(df) <= BROADCAST_BYTES else df
    places = written(_dealt(groups, F.ceil(F.col("n") * share) + 1, BLOCK_PREFIXES))
    light = nodes.select("node", "n", "prefix").join(sized(places), "node")
    live = written(light.groupBy("place", "i", "j").applyInPandas(candidates, "node long").distinct())
    dealt = written(_dealt(groups.join(live, "node", "left_semi"), F.col("n"), BLOCK_SHINGLES))
    meeting = texts.join(sized(dealt), "node").select("place", "i", "j", "mine", "node", "_text")
    meeting = meeting.mapInArrow(_compressed, meeting.drop("_text").schema.add("_packed", "binary"))

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("node").sort_values("node")
        steps, words = shared.value
        prefixes = Prefixes(steps, percent)
        sets: list[np.ndarray] = []
        chosen: list[np.ndarray] = []
        for text in rows["_packed"]:
            text = zlib.decompress(text)
            (s,), (bounds,) = shingle_sets(np.frombuffer(text, np.uint8), np.array([0, len(text)]), width, words)
            sets.append(s)
            chosen.append(prefixes.of(s, bounds))
        sides = (rows["mine"] == rows["i"]).to_numpy() if rows["i"].iloc[0] != rows["j"].iloc[0] else None
        ids = rows["node"].to_numpy()
        pairs = forest(sets, chosen, percent, sides)
        return pd.DataFrame({"a": [ids[a] for a, _ in pairs], "b": [ids[b] for _, b in pairs]}, dtype="int64")

    links = meeting.groupBy("place", "i", "j").applyInPandas(join, "a long, b long")
    roots = components(links)
    rooted = nodes.select("same", "node", "least", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.min("first")["node"].alias("stays"))
    named = rooted.join(least, "root").select("same", "component_id", "stays")
    own = F.when(F.col("same").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return signed.drop("prefix").join(named, "same", "left").select("doc_id", "node", "n_shingles", own.alias("component_id"), "stays")


def classes(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id for each row, see `placed`."""
    return placed(docs, width, percent).select("doc_id", "n_shingles", "component_id")


def distinct_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all their columns, of which one of each component stays: the one with the smallest id.

    Documents without words all stay. Of rows equal in id and text one stays.
    """
    found = written(placed(docs, width, percent))
    gone = found.where("stays IS NOT NULL AND node <> stays").select("node").distinct()
    again = found.where("node = stays").groupBy("node").count().where("count > 1").select("node")
    key = unused(docs, "node")
    keyed = docs.withColumn(key, _row_key(docs))

    def sized(nodes: DataFrame) -> DataFrame:
        return F.broadcast(nodes) if measured_bytes(nodes) <= BROADCAST_BYTES else nodes

    out = keyed.join(sized(gone.withColumnRenamed("node", key)), key, "left_anti")
    again = again.withColumnRenamed("node", key)
    if again.limit(1).count():
        small = sized(again)
        row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
        one = out.join(small, key, "left_semi").groupBy(key).agg(F.first(row).alias("row"))
        once = one.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
        return out.join(small, key, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns)).union(once)
    return out.drop(key)
