"""Rows with nulls, empty, long, repeated and equal texts, and columns with clashing names."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "an", "of"]) if rng.random() < 0.3 else f"w{rng.randrange(5000)}" for _ in range(words))


def texts() -> list[tuple]:
    base = [prose(k, 120) for k in range(6)]
    near = base[0].split()
    near[60] = "changed"
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [
        (10, base[1]),  # a copy
        (10, base[1]),  # a repeated row
        (11, " ".join(near)),  # a near copy
        (12, None),
        (12, None),
        (13, ""),
        (14, " \n\t "),
        (None, base[2]),  # no id
        (15, "one"),
        (16, "ONE two"),
        (17, "one TWO"),
        (18, "x" * 5000),
        (19, prose(50, 4000)),  # long
        (20, base[3][:300] + " quite another end " + prose(51, 80)),
        (21, "é日本語 🙂 ½ ٣ don't we'll  \t\r\n  end   "),
    ]
    return rows


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, "en" if k % 2 else None, None, None if t is None else len(t)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def clashing(df):
    """With more columns, named as the operators might name theirs."""
    names = "node score _text _score parts n_values ids n_tokens spans k1 prefix same token list rank place Text_ features label"
    return df.select("*", *(F.lit(k).alias(n) for k, n in enumerate(names.split())))


def lowered(text: str | None) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def by_id(df, *columns):
    """Sorted rows for each id."""
    out: dict = {}
    for r in df.select("doc_id", *columns).collect():
        out.setdefault(r["doc_id"], []).append(tuple(r[c] for c in columns))
    return {k: sorted(v, key=repr) for k, v in out.items()}
