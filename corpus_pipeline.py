"""Documents through the corpus stages: toxicity, near copies, benchmark passages, personal data, tokens.

Each stage takes what its predecessor kept. Only the last returns other columns
than those of documents: the ids, packed, and what was decoded from them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paywarden.llm import bpe, decontaminate, jaccard, pii, toxicity
from paywarden.llm.queries import VOCABULARY, pseudonym_key, ship, table
from paywarden.llm.storage import written

SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def _counted(docs: DataFrame) -> DataFrame:
    """The documents, with n_chars of their present text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model learned from their labelled ones does not reject; all, if there was no label to learn from."""
    ship(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model) if model.learned else docs


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return jaccard.distinct_documents(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the benchmark passages in them."""
    ship(spark)
    return _counted(decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark")))


def hide_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data."""
    return _counted(pii.pseudonymised(docs, pseudonym_key(spark)))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, text, and the tokens of the text."""
    ship(spark)
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.encode_frame(docs, ranks, public_tokenizers.PATTERN, ["doc_id", "text"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("benchmark passages", cut_benchmark),
    ("personal data", hide_personal),
    ("tokens", tokenise),
]

#: SQL cannot learn a model or split texts into tokens; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as a table before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
