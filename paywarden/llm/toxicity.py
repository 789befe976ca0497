"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Each coordinate has a learning rate of its own, and the L1 term keeps weights of
rare or idle features at zero, so the model is a short list of (feature, weight)
that is broadcast to score whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.llm.storage import schema_of, unused
from paywarden.llm.words import ALNUM, chained, hashed_words, text_slices

BITS = 20  # features are hashed to 2 ** BITS numbers
MAX_ROWS = 16_000  # labelled rows that are learned from, by hash of their id: the documented bound of the sample
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 20.0, 0.0  # L1 is strong, as a text has a thousand features and few of them tell
THRESHOLD = 0.5


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of all words, pairs of neighbours, and pairs with one or two words between."""
    hashes, firsts = hashed_words(data, offsets, ALNUM)
    owner = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    texts, found = [owner], [chained(hashes)]
    for gap in (1, 2, 3):
        if len(hashes) > gap:
            same = owner[:-gap] == owner[gap:]
            kind = np.full(int(same.sum()), gap, dtype=np.uint64)
            texts.append(owner[:-gap][same])
            found.append(chained(hashes[:-gap][same], hashes[gap:][same], kind))
    return np.concatenate(texts), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Weights other than zero, and the intercept."""

    feature: np.ndarray
    weight: np.ndarray
    intercept: float
    rows: int = 0  # learned from

    @property
    def learned(self) -> bool:
        """Whether the model says anything: without a labelled row every score is 0.5."""
        return bool(len(self.feature)) or self.intercept != 0


class Ftrl:
    """The learner: z and n for each coordinate, weights derived from them."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        self.z0 = self.n0 = 0.0

    @staticmethod
    def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def _intercept(self) -> float:
        return -self.z0 / ((BETA + self.n0**0.5) / ALPHA)

    def learn(self, at: np.ndarray, label: int, importance: float = 1.0) -> None:
        """One example: the distinct features of a text, and how often it counts."""
        z, n = self.z[at], self.n[at]
        w, w0 = self._weights(z, n), self._intercept()
        g = importance * (1 / (1 + np.exp(-np.clip(w.sum() + w0, -35, 35))) - label)
        self.z[at] = z + g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g
        self.z0 += g - ((self.n0 + g * g) ** 0.5 - self.n0**0.5) / ALPHA * w0
        self.n0 += g * g

    def model(self) -> Model:
        w = self._weights(self.z, self.n)
        at = np.flatnonzero(w)
        return Model(at, w[at], self._intercept())


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5. A null id is not held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = []
        for _, data, offsets in text_slices(batch.column(2)):
            owner, found = features(data, offsets)
            pairs = np.unique(owner << BITS | found)
            cuts = np.searchsorted(pairs, np.arange(len(offsets)) << BITS)
            found = (pairs & ((1 << BITS) - 1)).astype("<u4")
            packed += [found[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["turn", "label", "features"])


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted(
        (turn, found, label)
        for batch in batches
        for turn, label, found in zip(*(batch.column(i).to_pylist() for i in range(3)))
    )
    learner, ones = Ftrl(), sum(label for *_, label in rows)
    rarer = max(1.0, (len(rows) - ones) / max(1, ones))  # toxic rows count as much as the others together
    for _ in range(EPOCHS):
        for _, found, label in rows:
            learner.learn(np.frombuffer(found, dtype="<u4"), label, rarer if label else 1.0)
    m = learner.model()
    yield pa.RecordBatch.from_arrays(
        [pa.array([m.feature.astype("<i8").tobytes()], pa.binary()), pa.array([m.weight.astype("<f8").tobytes()], pa.binary()), pa.array([m.intercept]), pa.array([len(rows)], pa.int64())],
        names=["feature", "weight", "intercept", "rows"],
    )


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    """A model from at most `max_rows` labelled rows that are not held out.

    Rows without id or label teach nothing; a label other than 0 counts as 1; an id
    that occurs more often among documents or labels is learned as often, within the
    bound, which holds for what the labels meet; without any labelled row every score is 0.5.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).where(~held_out(F.col("doc_id")))
    sample = (
        known.select("doc_id", (F.col(label) != 0).cast("int").alias("_label"), F.xxhash64("doc_id").alias("_turn"))
        .orderBy("_turn", "doc_id", "_label")
        .limit(max_rows)
    )
    texts = docs.select("doc_id", docs["text"].cast("string").alias("_text"))
    rows = texts.join(F.broadcast(sample), "doc_id").select("_turn", "_label", "_text")  # at most max_rows small rows
    found = rows.mapInArrow(_feature_batches, "turn long, label int, features binary")
    # An id may occur in many documents: of what was met, each task and then the learner keep max_rows.
    bounded = found.orderBy("turn", "label", F.xxhash64("features")).limit(max_rows)
    learner = "feature binary, weight binary, intercept double, rows long"
    out = bounded.repartition(1).mapInArrow(_learn, learner).first()
    return Model(np.frombuffer(out["feature"], "<i8"), np.frombuffer(out["weight"], "<f8"), out["intercept"], out["rows"])


def scored(docs: DataFrame, model: Model, kept: list[str], name: str = "score") -> DataFrame:
    """The columns `kept` and the score, 0 to 1, of each whole text; null text is empty and scored by the intercept."""
    fields = [docs.schema[c] for c in kept if c != "text"] + [docs.schema["text"]]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 2 ** BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        dense = np.zeros(1 << BITS)
        dense[m.feature] = m.weight
        for batch in batches:
            scores = []
            for _, data, offsets in text_slices(batch.column(batch.num_columns - 1)):
                owner, found = features(data, offsets)
                live = dense[found] != 0
                pairs = np.unique(owner[live] << BITS | found[live])
                sums = np.bincount(pairs >> BITS, weights=dense[pairs & ((1 << BITS) - 1)], minlength=len(offsets) - 1)
                scores.append(1 / (1 + np.exp(-np.clip(sums + m.intercept, -35, 35))))
            columns = batch.columns if "text" in kept else batch.columns[:-1]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=[*returned.names]
            )

    returned = schema_of(fields if "text" in kept else fields[:-1], f"`{name}` double")
    source = docs.select(*(docs[f"`{f.name}`"] for f in fields[:-1]), docs["text"].cast("string").alias("text"))
    return source.mapInArrow(run, returned).select(*(f"`{c}`" for c in kept), f"`{name}`")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not toxic, with all their columns."""
    name = unused(docs, "score")
    return scored(docs, model, docs.columns, name).where(F.col(f"`{name}`") < THRESHOLD).drop(name)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each document. Repeated rows come out repeated, an empty table gives none."""
    return scored(docs, fit(docs, labels), ["doc_id"]).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
