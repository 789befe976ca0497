"""Hash trees and proofs against a plain version; the layout against its definition."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb

from check_oracle import duck, spark_rows, sql_rows
from paywarden.llm import merkle, oracle, queries
from tests.llm.cases import clashing, frame, texts


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def said(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_tree(leaves):
    """The root, and for each leaf its siblings as (before, after) step by step."""
    paths, level, owner = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, at in enumerate(owner):
            first = at // 8 * 8
            run = level[first : first + 8]
            paths[k].append(("".join(run[: at - first]), "".join(run[at - first + 1 :])))
        level = [H(*level[k : k + 8]) for k in range(0, len(level), 8)]
        owner = [at // 8 for at in owner]
    return level[0], paths


def plainly(rows):
    """Result rows for (doc_id, source, lang, n_chars, text) tuples."""
    groups = {}
    for doc_id, source, lang, n_chars, text in rows:
        true = H(*map(said, (doc_id, source, lang, n_chars, text)))
        chosen = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        claimed = H(*map(said, (doc_id, source, lang, n_chars, lowered(text)))) if chosen else true
        groups.setdefault((lang is not None, (lang or "").encode()), []).append(((doc_id is not None, doc_id or 0), true, claimed, doc_id))
    trees = [(plain_tree([r[1] for r in sorted(g, key=lambda r: r[:2])]), sorted(g, key=lambda r: r[:2])) for _, g in sorted(groups.items())]
    root, above = plain_tree([t[0][0] for t in trees])
    out = []
    for ((subroot, paths), group), top in zip(trees, above):
        for (_, true, claimed, doc_id), path in zip(group, paths):
            path, end = path + top, claimed
            for before, after in path:
                end = H(before, end, after)
            out.append((doc_id, true, subroot, root, H(*(a + b for a, b in path)), end, end == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def results(df):
    assert df.columns == COLUMNS
    return Counter(map(tuple, df.collect()))


def test_places_are_split_at_half_height_again_and_again():
    def order(levels, depth, number):
        """Nodes (depth, number) in the order of their places."""
        if levels == 1:
            return [(depth, number)]
        upper = levels // 2
        out = order(upper, depth, number)
        for k in range(8**upper):
            out += order(levels - upper, depth + upper, number * 8**upper + k)
        return out

    for levels in range(1, 6):
        nodes = order(levels, 0, 0)
        assert len(nodes) == len(set(nodes)) == merkle.size(levels)
        assert [merkle.address(levels, d, k) for d, k in nodes] == list(range(len(nodes)))


def test_blocks_of_any_size_hold_roots_and_siblings():
    rng = random.Random(1)
    for n in (1, 2, 7, 8, 9, 63, 64, 65, 511, 513, 4095, 4096):
        leaves = [H(str(k)) for k in range(n)]
        root, paths = plain_tree(leaves)
        steps = merkle._steps(n)
        block = merkle.built([bytes.fromhex(d) for d in leaves], steps).hex()
        assert block[:64] == root
        for k in {0, n - 1, *(rng.randrange(n) for _ in range(5))}:
            assert merkle.siblings(block, steps, n, k) == paths[k]
            assert merkle.folded(leaves[k], paths[k]) == root
            assert n == 1 or merkle.folded(H("x"), paths[k]) != root


def test_many_trees_with_repeated_rows_equal_plain_ones(spark):
    queries.ship(spark)
    rows = [(k, None, "en" if k % 4 else None if k % 8 else f"l{k % 96}", k, f"Text {k}" if k % 5 else None) for k in range(150)]
    rows += [(7, "s", "en", 1, "X")] * 40 + [(7, "s", "en", 1, "Y"), (None, None, None, None, None), (None, None, "en", None, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(4)
    assert results(merkle.report(docs)) == Counter(plainly(rows))


def test_every_place_of_a_tree_is_given_once(spark):
    rows = spark.range(40_000).selectExpr("concat('t', IF(id % 3 = 0, 0, id % 7)) AS tree", "id % 10000 AS doc_id")
    counted = rows.groupBy("tree", "doc_id").count().withColumnRenamed("count", "copies")
    spread = merkle.in_blocks(merkle.placed(counted, ["doc_id"])).selectExpr("tree", "doc_id", "total", "explode(sequence(block * 4096 + low, block * 4096 + high - 1)) AS place")
    found = {}
    for r in spread.collect():
        found.setdefault(r["tree"], []).append((r["place"], r["doc_id"], r["total"]))
    assert sum(map(len, found.values())) == 40_000
    for places in found.values():
        places.sort()
        assert [p for p, *_ in places] == list(range(len(places))) and {t for *_, t in places} == {len(places)}
        assert [i for _, i, _ in places] == sorted(i for _, i, _ in places)


def test_a_tree_of_several_tiers(spark):
    queries.ship(spark)
    n = 8 * 4096 + 3
    docs = spark.range(n).selectExpr("id AS doc_id", "'s' AS source", "IF(id % 3 = 0, 'x', 'en') AS lang", "1L AS n_chars", "concat('T', id) AS text")
    docs = docs.unionByName(docs.where("doc_id = 5").crossJoin(spark.range(9000)).drop("id"))  # one row fills several blocks
    rows = [(k, "s", "en" if k % 3 else "x", 1, f"T{k}") for k in [*range(n), *[5] * 9000]]
    assert results(merkle.report(docs)) == Counter(plainly(rows))


def test_odd_rows_empty_tables_and_clashing_columns(spark):
    queries.ship(spark)
    docs = frame(spark)
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in docs.collect()]
    got = results(merkle.report(clashing(docs).withColumns({"tree": docs.doc_id, "path": docs.text, "copies": docs.doc_id, "first": docs.lang})))
    assert got == Counter(plainly(rows)) and len(rows) == len(texts())
    assert results(merkle.report(frame(spark, []))) == Counter()
    one = results(merkle.report(frame(spark, [(4, "One")])))
    assert one == Counter(plainly([(4, None, None, 3, "One")]))


def test_sql_twin_says_the_same_of_odd_rows(spark, tmp_path):
    queries.ship(spark)
    docs = frame(spark, [(k, None if k % 9 == 0 else f"Some {k} Text" * (k % 3)) for k in range(300)] + texts())
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert spark_rows(merkle.report(docs)) == sql_rows(con, oracle.MANIFEST)


def test_query_equals_plain_trees_and_sql(spark, sf):
    out = queries.QUERIES["op12_manifest"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    wanted = plainly([tuple(r) for r in docs.collect()])
    assert results(out) == Counter(wanted)
    assert 0 < sum(r[-1] for r in wanted) < len(wanted)
    assert spark_rows(out) == sql_rows(duck(sf), oracle.MANIFEST)
