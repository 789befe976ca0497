"""The queries of this subpackage over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paywarden.llm import bpe, chat, decontaminate, jaccard, licenses, merges, merkle, negatives, neighbours, oracle, pii, sharding, suffixes, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

SHARDS = 24
PSEUDONYM_SETTING = "paywarden.pseudonym.key"
PSEUDONYM_KEY = "key of the example; a job sets its own secret"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


_SHIPPED: set[str] = set()
BATCH_ROWS = 1_000  # texts that a Python worker gets at a time; rows are a few kilobytes, some much more


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application. Spark serves the file to all executors.

    Batches are made smaller than Spark's default, which is meant for short rows; a
    setting of the user that is smaller still is left as it is.
    """
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(batch, min(BATCH_ROWS, int(spark.conf.get(batch))))
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="run-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(app)


def query(sql: str | None = None):
    """Register a query under its function name."""

    def register(fn):
        @wraps(fn)
        def shipped(spark, sf_dir):
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = shipped
        if sql is not None:
            ORACLE[fn.__name__] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def pseudonym_key(spark: SparkSession) -> str:
    """The key of the pseudonyms, made of the secret in the session's settings, or of the example's."""
    return pii.round_key(spark.conf.get(PSEUDONYM_SETTING, PSEUDONYM_KEY))


@query()
def op1_toxicity(spark, sf_dir):
    """All documents scored by a model that is learned from labelled rows."""
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(oracle.REPEATS)
def op2_repeats(spark, sf_dir):
    """All documents without the 200-byte strings that start more than once."""
    return suffixes.report(table(spark, sf_dir, "documents"))


@query()
def op3_licenses(spark, sf_dir):
    """License notices in all documents."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query()
def op4_pii(spark, sf_dir):
    """All documents with pseudonyms for personal numbers, dates, addresses and secrets."""
    return pii.pseudonymised(table(spark, sf_dir, "documents"), pseudonym_key(spark), ["doc_id"])


@query()
def op5_sharding(spark, sf_dir):
    """All documents in 24 shards of a weighted hash tree."""
    return sharding.sharded(table(spark, sf_dir, "documents"), sharding.layout(SHARDS), sharding.layout(SHARDS + 1))


@query(r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, regexp_replace(text, '<(\\*/?s>)', '<\\\1', 'g') AS text_out FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(8 + length(role) + length(text_out)) AS BIGINT) AS formatted_chars,
       true AS round_trip
FROM escaped GROUP BY conv_id
""")
def op7_chat(spark, sf_dir):
    """All conversations, and one whose texts hold control strings, formatted and read back."""
    extra = spark.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(turn, role)"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(rows.unionByName(extra))


@query(oracle.CLASSES)
def op6_jaccard(spark, sf_dir):
    """Components of documents whose sets of 3-word shingles are similar to 90 %."""
    return jaccard.classes(table(spark, sf_dir, "documents"), 3, 90)


@query()
def op8_bpe(spark, sf_dir):
    """All documents encoded and decoded."""
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_frame(docs, ranks, public_tokenizers.PATTERN, ["doc_id"], ids=False)


@query()
def op9_neighbours(spark, sf_dir):
    """The 5 nearest vectors of every fiftieth."""
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


@query(oracle.HITS)
def op10_decontamination(spark, sf_dir):
    """Benchmark passages in all documents."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op11_merges(spark, sf_dir):
    """All documents encoded and decoded by the merges of a tokenizer file."""
    import public_tokenizers

    tokenizer = merges.read_tokenizer(public_tokenizers.path(TOKENIZER))
    docs = table(spark, sf_dir, "documents")
    return merges.encode_frame(docs, tokenizer, public_tokenizers.PATTERN, ["doc_id"], ids=False)


@query(oracle.MANIFEST)
def op12_manifest(spark, sf_dir):
    """Proofs of all documents in a hash tree, a third of them tampered with."""
    return merkle.report(table(spark, sf_dir, "documents"))


@query(oracle.NEGATIVES)
def op13_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector, with the label of every seventh moved on."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.mined(moved, lambda vec_id: vec_id % 100 == 0)
