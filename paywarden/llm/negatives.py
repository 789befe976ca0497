"""Hard negatives by the threshold algorithm over sorted lists, one for each dimension.

A block of rows has, for each dimension, the list of its rows sorted by that component.
An anchor reads a list from its large end where its own component is positive, from the
small end where it is negative, and not at all where it is 0. Every row met in a list is
scored as a whole, in integers (random access). Rows that no list has shown yet cannot
score above the threshold, which is the anchor's product with the last entries read. So
reading ends once the threshold is strictly below the k-th score of every window that
the anchor asks for, or below the window itself while it has fewer. Strictly, as a row
with an equal score and a smaller id would still come first. What a block found is kept
for the next one of the same task, whose heads alone may then be below it.

Rows are never shuffled: each task turns its rows into blocks. Anchors are read in chunks
of bounded size, which all tasks get; tasks return the best for each anchor.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paywarden.layout import shared_root
from paywarden.llm.merkle import placed
from paywarden.llm.storage import written

BLOCK_ROWS = 8_192
CHUNK_BYTES = 8 << 20  # of the anchors that all tasks get at a time
FIRST_DEPTH = 8  # entries of each list read before the threshold is compared; doubled each time
LARGEST = (1 << 63) - 1
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


class Best:
    """The k best (score, id) of a window, the larger score and then the smaller id first. A side that is None is open."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.scores = self.ids = np.zeros(0, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        bar = self.bar()
        inside = np.ones(len(scores), dtype=bool) if bar is None else scores >= bar
        if self.high is not None:
            inside &= scores <= self.high
        if inside.any():
            scores, ids = np.concatenate([self.scores, scores[inside]]), np.concatenate([self.ids, ids[inside]])
            order = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[order], ids[order]

    def bar(self) -> int | None:
        """What lies strictly below cannot enter any more."""
        return int(self.scores[-1]) if len(self.scores) == self.k else self.low


class Lists:
    """The rows of a block and their sorted lists."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.sorted = np.take_along_axis(rows, self.order, axis=0)
        depths, n = [1, FIRST_DEPTH], len(rows)
        while depths[-1] < n:
            depths.append(2 * depths[-1])
        self.depths = np.array([min(d, n) for d in depths])

    def thresholds(self, anchors: np.ndarray) -> np.ndarray:
        """For each anchor and depth, the most that a row can score that was not among so many first entries.

        At depth 1 that holds for all rows of the block.
        """
        heads, ends = self.sorted[len(self.rows) - self.depths], self.sorted[self.depths - 1]
        return np.maximum(anchors, 0) @ heads.T + np.minimum(anchors, 0) @ ends.T

    def entries(self, anchor: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Rows at these depths of the lists, each read from the end that the anchor's sign says."""
        n = len(self.rows)
        if not (anchor != 0).any():
            return np.arange(start, stop)  # all rows score 0, in any order
        down, up = self.order[n - stop : n - start, anchor > 0], self.order[start:stop, anchor < 0]
        return np.concatenate([down.ravel(), up.ravel()])


def scan(
    lists: Lists, anchor: np.ndarray, thresholds: np.ndarray, allowed: np.ndarray, ids: np.ndarray, windows: list[Best]
) -> int:
    """Read the lists until no window can change; how many rows were scored."""

    def settled(threshold) -> bool:
        return all((bar := w.bar()) is not None and threshold < bar for w in windows)

    if settled(thresholds[0]):
        return 0
    unseen = np.ones(len(ids), dtype=bool)
    read = 0
    for depth, threshold in zip(lists.depths[1:], thresholds[1:]):
        met = np.zeros(len(ids), dtype=bool)
        met[lists.entries(anchor, read, depth)] = True
        met &= unseen
        unseen &= ~met
        read = depth
        at = np.flatnonzero(met & allowed)
        if len(at):
            scores = whole(lists.rows[at] @ anchor)
            for window in windows:
                window.add(scores, ids[at])
        if settled(threshold):
            break
    return len(ids) - int(unseen.sum())


def whole(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers; larger ones are held at the limits."""
    if scores.dtype == object:
        scores = np.array([min(max(int(s), -LARGEST), LARGEST) for s in scores], dtype=np.int64)
    return scores.astype(np.int64)


def matrix(column: pa.Array, dims: int, kind: type) -> np.ndarray:
    """Rows of equal length from lists of integers; shorter lists end with zeros."""
    out = np.zeros((len(column), dims), dtype=np.int64)
    lengths = np.diff(column.offsets.to_numpy())
    start = np.repeat(np.arange(len(column)) * dims - (np.cumsum(lengths) - lengths), lengths)
    out.ravel()[start + np.arange(lengths.sum())] = column.flatten().to_numpy()
    return out.astype(kind)


def in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a task, so many at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            held.append(batch.slice(at, BLOCK_ROWS))
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                table = pa.Table.from_batches(held)
                yield table.slice(0, BLOCK_ROWS)
                held = table.slice(BLOCK_ROWS).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _best_of_tasks(rows: DataFrame, chunk: dict, dims: int, kind: type, same_label: bool) -> DataFrame:
    """(place, window, vec_id, score): the best that each task has for each window of each anchor of a chunk.

    A chunk has place (number), uid, label and components of anchors, and for each a
    function that makes its windows.
    """
    shared = rows.sparkSession.sparkContext.broadcast(chunk)  # at most CHUNK_BYTES of components

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        anchors = asked["components"].astype(kind)
        windows: list[list[Best]] = [[Best(*w) for w in ws] for ws in asked["windows"]]
        for table in in_blocks(batches):
            uids, ids, labels = (table[c].to_numpy() for c in ("uid", "vec_id", "label"))
            lists = Lists(matrix(table["components"].combine_chunks(), dims, kind))
            thresholds = lists.thresholds(anchors)
            for k, anchor in enumerate(anchors):
                if windows[k]:
                    alike = labels == asked["label"][k]
                    allowed = alike & (uids != asked["uid"][k]) if same_label else ~alike
                    scan(lists, anchor, thresholds[k], allowed, ids, windows[k])
        found = [(asked["place"][k], w, best) for k, ws in enumerate(windows) for w, best in enumerate(ws) if len(best.ids)]
        if found:
            counts = [len(best.ids) for *_, best in found]
            columns = [
                np.repeat([place for place, *_ in found], counts),
                np.repeat([w for _, w, _ in found], counts),
                np.concatenate([best.ids for *_, best in found]),
                np.concatenate([best.scores for *_, best in found]),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["place", "window", "vec_id", "score"])

    return rows.mapInArrow(run, "place long, window long, vec_id long, score long")


def _first(df: DataFrame, k: int, by: list[str]) -> DataFrame:
    """With `rank`, the k best of each group. A group has at most k rows for each task."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) for each component; what is beyond 64 bits is held at the limits."""
    return F.transform(vector, lambda x: F.floor(scale * x))


def mined(
    rows: DataFrame,
    anchors: Callable[[Column], Column],
    positives: int = 5,
    negatives: int = 5,
    percent: tuple[int, int] = (80, 100),
    scale: int = 256,
) -> DataFrame:
    """Hard negatives of (vec_id, label, embedding) rows, with the columns of `RESULT`.

    Anchors are the rows whose vec_id `anchors` chooses. A positive is one of an anchor's
    best other rows of the same label; its negatives are the best rows of other labels
    that score between the two percentages of what it scores. A score is the product of
    the components, scaled and rounded down; larger ones come first, then smaller ids.

    Rows with a null id, label or vector, or with a component that is null or not finite,
    take no part. Shorter vectors end with zeros. A repeated id is as many rows, and
    every row that is an anchor is answered. An anchor without another row of its label,
    and a positive below 0, give no rows; so does an empty table. Other columns are ignored.
    """
    spark = rows.sparkSession
    vector = F.col("embedding").cast("array<double>")
    used = rows.select("vec_id", "label", vector.alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("embedding"))
    )
    used = written(
        used.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("long").alias("label"),
            integers(F.col("embedding"), scale).alias("components"),
        )
    )
    facts = used.agg(
        F.max(F.size("components")).alias("dims"),
        F.max(F.array_max("components")).alias("high"),
        F.min(F.array_min("components")).alias("low"),
    ).first()
    dims, bound = facts["dims"] or 0, max(abs(facts["high"] or 0), abs(facts["low"] or 0))
    kind = np.float64 if dims * bound * bound < 1 << 53 else object  # floats hold such integers exactly
    asked = used.where(anchors(F.col("vec_id"))).select(F.lit("").alias("tree"), "*", F.lit(1).cast("long").alias("copies"))
    asked = written(placed(asked, ["uid"]))
    n = asked.agg(F.max("total")).first()[0] or 0
    size = max(1, CHUNK_BYTES // (8 * max(1, dims)))
    root = f"{shared_root(spark)}/stage-{uuid.uuid4().hex}"
    paths = []
    for start in range(0, n, size):
        near = asked.where((F.col("first") >= start) & (F.col("first") < start + size))
        paths.append(f"{root}/{start}")
        _mined_chunk(used, near, dims, kind, positives, negatives, percent).write.parquet(paths[-1])
    return spark.read.schema(RESULT).parquet(*paths) if paths else spark.createDataFrame([], RESULT)


def _mined_chunk(
    used: DataFrame, near: DataFrame, dims: int, kind: type, positives: int, negatives: int, percent: tuple[int, int]
) -> DataFrame:
    """The result for a chunk of anchors. Only the chunk and its positives, which are bounded, reach the driver."""
    spark: SparkSession = used.sparkSession
    table = near.select("first", "uid", "vec_id", "label", "components").toArrow()
    chunk = {
        "place": table["first"].to_numpy(),
        "uid": table["uid"].to_numpy(),
        "label": table["label"].to_numpy(),
        "components": matrix(table["components"].combine_chunks(), dims, np.int64),
        "windows": [[(positives,)]] * len(table),
    }
    best = _first(_best_of_tasks(used, chunk, dims, kind, True), positives, ["place"])
    chosen = written(best.select("place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    scores: dict[int, set[int]] = {}
    for r in chosen.select("place", "positive_score").distinct().collect():  # at most `positives` for each anchor
        if r["positive_score"] >= 0:  # below 0 the window is empty
            scores.setdefault(r["place"], set()).add(r["positive_score"])
    least, most = percent
    ordered = {place: sorted(found) for place, found in scores.items()}
    chunk["windows"] = [
        [(negatives, -(-least * p // 100), most * p // 100) for p in ordered.get(place, [])] for place in chunk["place"]
    ]
    windows = [(int(place), w, p) for place, found in ordered.items() for w, p in enumerate(found)]
    of_window = spark.createDataFrame(windows, "place long, window long, positive_score long")
    ids = pa.table({"place": table["first"], "anchor_id": table["vec_id"]})
    hard = _first(_best_of_tasks(used, chunk, dims, kind, False), negatives, ["place", "window"])
    return (
        hard.join(of_window, ["place", "window"])
        .join(chosen, ["place", "positive_score"])
        .join(spark.createDataFrame(ids), "place")
        .select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
