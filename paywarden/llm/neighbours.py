"""Approximate nearest neighbours by cosine: inverted lists, scanned with an adaptive number of dimensions.

Vectors are scaled to length 1, so the largest cosine is the smallest distance, and
rotated at random, so any leading dimensions are a fair sample of the distance.
Each query probes its nearest lists, as many as the sample shows to be needed. Within a list the rotated vectors are read in
column blocks; after each block a hypothesis test on the partial distance gives up
the candidates that are very likely farther than the k-th best so far.

Centroids are fitted on a bounded sample, but every row is in the index. Lists are
split into blocks of rows, so that no task holds a whole list.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paywarden.llm.storage import written

SAMPLE_ROWS = 8_192  # vectors that the centroids are fitted on, by hash of their id
LIST_ROWS = 1_000  # rows of a list, about
MAX_LISTS = 1_024
RECALL = 0.97  # that the probed lists must reach for neighbours within the sample
BLOCK_ROWS, BLOCK_QUERIES = 20_000, 2_000  # of a list that meet in one task
COLUMNS = 16  # dimensions read at a time
EPSILON = 2.1  # of the test: larger gives up fewer candidates
CHUNK = 1_024  # candidates between updates of the k-th best distance
SLACK = 1e-9  # rounding of rotated distances; what is this close is compared exactly


def usable(vector: Column) -> Column:
    """Whether a vector is there, all its components are finite numbers, and not all of them are 0."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    """Rows of equal length; shorter vectors end with zeros."""
    out = np.zeros((len(vectors), dims))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; the largest component is taken out first, as its square may not be finite."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def centroids(rows: np.ndarray, lists: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Spherical k-means on the sample; a list without rows keeps its place."""
    random = np.random.default_rng(seed)
    centres = rows[random.permutation(len(rows))[:lists]].copy()
    for _ in range(rounds):
        nearest = (rows @ centres.T).argmax(axis=1)
        for k in np.unique(nearest):
            mean = rows[nearest == k].sum(axis=0)
            if (length := np.sqrt(mean @ mean)) > 0:
                centres[k] = mean / length
    return centres


def probes_needed(rows: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """How many lists a query must probe, so that the share `recall` of the sample's k nearest pairs is met.

    Neighbours in the sample are farther than those among all rows, so this errs upwards.
    """
    asked = rows[:512]
    lists = (rows @ centres.T).argmax(axis=1)
    near = asked @ rows.T
    near[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    best = np.argsort(-near, axis=1)[:, : min(k, max(1, len(rows) - 1))]
    place = np.argsort(np.argsort(-(asked @ centres.T), axis=1), axis=1)
    needed = np.sort(place[np.arange(len(asked))[:, None], lists[best]].ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1


def adaptive_scan(query: np.ndarray, blocks: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """Rows that may be among the k nearest: those not given up whose distance is within rounding of the k-th best.

    `query` and `blocks` are rotated; `blocks` hold the columns of all rows.
    """
    dims = len(query)
    best, found, distances = np.inf, [], []
    top = np.zeros(0)
    rows = np.flatnonzero(allowed)
    for at in range(0, len(rows), CHUNK):
        live = rows[at : at + CHUNK]
        partial, seen = np.zeros(len(live)), 0
        for block in blocks:
            width = block.shape[1]
            gap = block[live] - query[seen : seen + width]
            partial = partial + (gap * gap).sum(axis=1)
            seen += width
            if seen < dims and np.isfinite(best):
                near = partial * dims / seen <= best * (1 + EPSILON / np.sqrt(seen)) ** 2 + SLACK
                live, partial = live[near], partial[near]
                if not len(live):
                    break
        if len(live):
            found.append(live)
            distances.append(partial)
            top = np.sort(np.concatenate([top, partial]))[:k]
            if len(top) == k:
                best = top[-1]
    if not found:
        return np.zeros(0, dtype=np.int64)
    live, distances = np.concatenate(found), np.concatenate(distances)
    return live[distances <= best + SLACK]


def _rotation(dims: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, recall: float = RECALL, list_rows: int = LIST_ROWS
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k nearest vectors found, ties to the smaller vec_id.

    Both frames have vec_id and embedding. Rows with a null id or an unusable
    vector take no part. Each query gets k rows, fewer only if there are fewer other ids:
    it probes more lists if the nearest are short. Rows with the query's id are not its neighbours; an id that
    is repeated is found once, at its best, and asked for once, by its smallest vector.
    Vectors shorter than the longest end with zeros. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    own = lambda df: df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & usable(F.col("embedding"))
    )
    rows, asked = own(vectors), own(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dims")).first()
    schema = "query_id long, vec_id long, score double"
    if not facts["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = facts["dims"]
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).toPandas()  # bounded
    lists = int(min(MAX_LISTS, max(1, facts["n"] // list_rows), len(sample)))
    fitted = unit(matrix(sample["embedding"], dims))
    centres = centroids(fitted, lists)
    probes = probes_needed(fitted, centres, k, recall)
    rotation = _rotation(dims)

    @F.pandas_udf("int")
    def list_of(v: pd.Series) -> pd.Series:
        return pd.Series((unit(matrix(v, dims)) @ centres.T).argmax(axis=1) if len(v) else [], dtype=np.int32)

    placed = written(rows.withColumn("list", list_of("embedding")))
    # Ids in each list, an id in several counted in one of them. A query probes on until its lists hold k ids besides its own.
    homes = placed.groupBy("vec_id").agg(F.min("list").alias("list")).groupBy("list").count()
    held = np.zeros(lists, dtype=np.int64)
    for r in homes.collect():  # a row for each list, MAX_LISTS at most
        held[r["list"]] = r["count"]

    @F.pandas_udf("array<int>")
    def probed(v: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=object)
        order = np.argsort(-(unit(matrix(v, dims)) @ centres.T), axis=1, kind="stable")
        short = (np.cumsum(held[order], axis=1) < k + 1).sum(axis=1)
        return pd.Series([x[:m].tolist() for x, m in zip(order, np.maximum(probes, short + 1))])

    probing = written(asked.select("vec_id", "embedding", F.explode(probed("embedding")).alias("list")))
    per = lambda df, most, name: df.groupBy("list").agg(F.ceil(F.count("*") / most).cast("int").alias(name))
    sizes = F.broadcast(per(placed, BLOCK_ROWS, "row_blocks").join(per(probing, BLOCK_QUERIES, "query_blocks"), "list"))  # MAX_LISTS rows
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    rows = placed.join(sizes, "list").select("list", "vec_id", "embedding", dealt("row_blocks").alias("rb"), spread("query_blocks").alias("qb"))
    asked = probing.join(sizes, "list").select("list", "vec_id", "embedding", dealt("query_blocks").alias("qb"), spread("row_blocks").alias("rb"))

    def scan(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, plain = right["vec_id"].to_numpy(), matrix(right["embedding"], dims)
        turned = unit(plain) @ rotation
        blocks = [np.ascontiguousarray(turned[:, at : at + COLUMNS]) for at in range(0, dims, COLUMNS)]
        scale = np.abs(plain).max(axis=1)
        scaled = plain / scale[:, None]
        lengths = np.sqrt((scaled * scaled).sum(axis=1))
        repeats = len(ids) - len(np.unique(ids))  # a repeated id fills one place only
        asked_ids, asked_rows = left["vec_id"].to_numpy(), matrix(left["embedding"], dims)
        asked_turned = unit(asked_rows) @ rotation
        out = []
        for q, row, turned_row in zip(asked_ids, asked_rows, asked_turned):
            near = adaptive_scan(turned_row, blocks, ids != q, k + repeats)
            row = row / np.abs(row).max()
            score = (scaled[near] * row).sum(axis=1) / (lengths[near] * np.sqrt((row * row).sum()))
            order = np.lexsort((ids[near], -score))
            unique = np.sort(np.unique(ids[near][order], return_index=True)[1])[:k]
            out.append(pd.DataFrame({"query_id": q, "vec_id": ids[near][order][unique], "score": score[order][unique]}))
        return pd.concat(out)

    met = asked.groupBy("list", "rb", "qb").cogroup(rows.groupBy("list", "rb", "qb")).applyInPandas(scan, schema)
    best = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
