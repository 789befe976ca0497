"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywarden.llm.storage import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b): root is the smallest node that links lead to.

    Large and small stars in turn: each node's larger neighbours, then its smaller
    ones, are linked to its smallest neighbour. The rounds grow with the logarithm of
    the longest path; each round is a table, so a lost executor costs one round at most.
    Roots themselves are listed too. Loops and nulls are left out.
    """
    edges = written(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(lowest, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.union(lowest.select("u", F.col("m").alias("v"))).distinct())
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum of the edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
