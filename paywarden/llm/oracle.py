"""SQL for the queries that SQL can express, in DuckDB's dialect."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Strings of 200 bytes by a hash of 64 bits; flagged starts that are at most 200 apart make one removed run.
REPEATS = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT r, p, hash(substr(h, 2 * p + 1, 400)) AS w
            FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 199)) AS p FROM docs WHERE len(h) >= 400)),
often AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
starts AS (SELECT r, p FROM windows SEMI JOIN often USING (w)),
steps AS (SELECT r, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= 200 THEN 0 ELSE 1 END AS fresh FROM starts),
runs AS (SELECT r, min(p) AS s, max(p) + 200 AS e
         FROM (SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS run FROM steps) GROUP BY r, run),
edges AS (SELECT r, s, e, lag(e, 1, 0) OVER (PARTITION BY r ORDER BY s) AS before FROM runs),
cut AS (SELECT r, sum(e - s) AS gone, count(*) AS n, max(e) AS last,
               string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) AS head
        FROM edges JOIN docs USING (r) GROUP BY r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN cut USING (r)
"""

CLASSES = rf"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT r, s FROM (
    SELECT r, unnest([array_to_string(w[k : k + 2], ' ') FOR k IN range(1, len(w) - 1)]) AS s FROM docs WHERE len(w) >= 3
    UNION ALL SELECT r, array_to_string(w, ' ') FROM docs WHERE len(w) BETWEEN 1 AND 2)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
pairs AS (SELECT a.r AS a, b.r AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT r, r AS at FROM docs UNION SELECT reach.r, ways.b FROM reach JOIN ways ON ways.a = reach.at)
SELECT docs.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM docs LEFT JOIN sizes USING (r)
JOIN (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN docs d ON d.r = reach.at GROUP BY 1) USING (r)
"""

HITS = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wanted AS (
  SELECT DISTINCT item, size, w[k : k + size - 1] AS g
  FROM (SELECT item, w, least(10, len(w)) AS size, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM items WHERE len(w) > 0)),
grams AS (
  SELECT r, k, size, w[k : k + size - 1] AS g
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS k
        FROM docs, (SELECT DISTINCT size FROM wanted) WHERE len(w) >= size)),
found AS (SELECT r, k, grams.size, item FROM grams JOIN wanted ON grams.g = wanted.g),
hits AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(k, k + size)) AS p FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""


def _said(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return f"sha256({' || '.join(map(_said, values))})"


# crc32 by its definition, a bit at a time; _UP is the nodes made from every 8 of the level below.
_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ord(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
  lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, bit: xor(x >> 1, CASE WHEN x & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)))"""
_UP = "lev + 1, pos // 8, sha256(string_agg(d, '' ORDER BY pos)), (any_value(n) + 7) // 8"
_BESIDE = """coalesce(string_agg(o.d, '' ORDER BY o.pos) FILTER (o.pos < {at} >> (3 * o.lev)), '') AS before,
         coalesce(string_agg(o.d, '' ORDER BY o.pos) FILTER (o.pos > {at} >> (3 * o.lev)), '') AS behind"""

MANIFEST = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf("text")} AS leaf,
         CASE WHEN xor({_CRC}, CAST(4294967295 AS BIGINT)) % 3 = 0
              THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS claimed
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY tree) AS total FROM hashed),
nodes AS (
  SELECT tree, 0 AS lev, place AS pos, leaf AS d, total AS n FROM leaves
  UNION ALL SELECT tree, {_UP} FROM nodes WHERE n > 1 GROUP BY tree, lev, pos // 8),
subroots AS (SELECT tree, d, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS total FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lev, place AS pos, d, total AS n FROM subroots
  UNION ALL SELECT {_UP} FROM tops WHERE n > 1 GROUP BY lev, pos // 8),
beside AS (
  SELECT r, o.lev, {_BESIDE.format(at="l.place")}
  FROM leaves l JOIN nodes o ON o.tree = l.tree AND o.n > 1 AND o.pos // 8 = l.place >> (3 * (o.lev + 1)) GROUP BY r, o.lev
  UNION ALL
  SELECT r, 100 + o.lev, {_BESIDE.format(at="s.place")}
  FROM leaves l JOIN subroots s ON s.tree = l.tree JOIN tops o ON o.n > 1 AND o.pos // 8 = s.place >> (3 * (o.lev + 1)) GROUP BY r, o.lev),
steps AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY lev) AS k FROM beside),
proofs AS (SELECT r, string_agg(before || behind, '' ORDER BY k) AS proof FROM steps GROUP BY r),
walk AS (
  SELECT r, 0 AS k, coalesce(claimed, leaf) AS d FROM leaves
  UNION ALL SELECT walk.r, steps.k, sha256(before || d || behind) FROM walk JOIN steps ON steps.r = walk.r AND steps.k = walk.k + 1),
ends AS (SELECT r, arg_max(d, k) AS folded_root FROM walk GROUP BY r)
SELECT doc_id, leaf, s.d AS subroot, t.d AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root,
       folded_root = t.d AS verified
FROM leaves l JOIN ends USING (r) LEFT JOIN proofs USING (r) JOIN subroots s ON s.tree = l.tree
CROSS JOIN (SELECT d FROM tops WHERE n = 1) t
"""

NEGATIVES = """
WITH used AS (
  SELECT row_number() OVER () AS u, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS c
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.u, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_inner_product(a.c, b.c) AS BIGINT) AS score
  FROM used a JOIN used b ON a.u <> b.u WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT u, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY u ORDER BY score DESC, vec_id) AS k
  FROM scored WHERE alike QUALIFY k <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.u, p.k ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored n ON n.u = p.u AND NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
