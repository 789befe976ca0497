"""Toxicity, pseudonyms, shards, conversations, neighbours, and the pipeline."""

import datetime
import hashlib
import ipaddress
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from paywarden.llm import chat, neighbours, pii, queries, sharding, toxicity
from paywarden.llm.graph import components
from tests.llm.cases import by_id, clashing, frame, prose, texts

CHECK = "/root/testdata/sf0.1"


# --- toxicity ------------------------------------------------------------------


def test_held_out_accuracy(spark):
    out = queries.QUERIES["op1_toxicity"](spark, CHECK)
    labels = spark.read.parquet(f"{CHECK}/labels.parquet")
    rows = out.where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    toxic, clean = ([r for r in rows if r["toxic"] == y] for y in (1, 0))
    assert sum(r["predicted"] for r in toxic) >= 0.8 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_scores_of_odd_texts(spark):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, None), (None, 1), (3, 0), (3, 0)], "doc_id long, toxic int")
    docs = clashing(frame(spark))
    out = toxicity.report(docs, labels)
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(i for i, _ in texts())
    for r in out.collect():
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    kept = toxicity.accepted(docs, toxicity.fit(docs, labels.limit(0)))
    assert kept.columns == docs.columns and kept.count() == 0  # nothing learned: 0.5 is rejected
    assert toxicity.report(frame(spark, []), labels).count() == 0


def test_without_labels_the_pipeline_rejects_nothing(spark, tmp_path):
    docs = clashing(frame(spark))
    spark.createDataFrame([(2, None), (None, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and kept.count() == len(texts())


def test_the_bound_holds_where_one_id_has_many_documents(spark):
    queries.ship(spark)
    docs = frame(spark, [(2, prose(k, 12)) for k in range(300)] + [(k, prose(k, 12)) for k in range(3, 60)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    met = docs.join(labels.where(~toxicity.held_out(F.col("doc_id"))), "doc_id").count()
    assert met > 300
    assert toxicity.fit(docs, labels).rows == met
    assert toxicity.fit(docs, labels, max_rows=40).rows == 40


def test_learner_keeps_idle_weights_at_zero():
    learner = toxicity.Ftrl()
    for k in range(400):
        noise = np.array([100 + k, 5000 + k % 7])
        learner.learn(np.append(noise, 7) if k % 2 else noise, k % 2)
    model = learner.model()
    assert model.weight[model.feature == 7] > 1 and len(model.feature) < 12


# --- pseudonyms ------------------------------------------------------------------

KEY = "k"


def feistel(value, kind):
    """The string permutation, spelt out."""
    half = len(value) // 2
    a, b = value[:half], value[half:]
    for k in range(pii.ROUNDS):
        stream = hashlib.sha256(f"{KEY}|{kind}|{k}|{b}".encode()).hexdigest()
        moved = ""
        for at, c in enumerate(a):
            step = int(stream[at % 32 * 2 : at % 32 * 2 + 2], 16)
            for first, size in ((48, 10), (65, 26), (97, 26)):
                if first <= ord(c) < first + size:
                    c = chr(first + (ord(c) - first + step) % size)
                    break
            moved += c
        a, b = b, moved
    return a + b


def spelt(pattern, signs):
    """The signs in place of the digits and letters of the pattern."""
    left = iter(signs)
    return "".join(next(left) if c.isalnum() else c for c in pattern)


def pair(a, b, sizes, kind):
    """The permutation of pairs, spelt out."""
    for k in range(pii.ROUNDS):
        noise = lambda x: int(hashlib.sha256(f"{KEY}|{kind}|{k}|{x}".encode()).hexdigest()[:15], 16)  # noqa: E731, B023
        a, b = (a, (b + noise(a)) % sizes[1]) if k % 2 else ((a + noise(b)) % sizes[0], b)
    return a, b


def day(value, first=datetime.date(1800, 1, 1), parts=(189, 773), kind="date"):
    a, b = pair(*divmod((value - first).days, parts[1]), parts, kind)
    return first + datetime.timedelta(days=a * parts[1] + b)


def iban(value):
    """The image of an account number, with check digits of its own."""
    moved = spelt(value[4:], feistel(value[4:].replace(" ", ""), "iban"))
    number = lambda text: int("".join(str(int(c, 36)) for c in text.replace(" ", "")))
    assert number(value[4:] + value[:4]) % 97 == 1
    return f"{value[:2]}{98 - number(moved + value[:2] + '00') % 97:02d}{moved}"


def address6(value):
    """The image of an IPv6 address: halves of 64 bits, each mixed with a hash of the other."""
    a, b = divmod(int(ipaddress.IPv6Address(value)), 1 << 64)
    for k in range(pii.ROUNDS):
        signed = b - (1 << 64) if b >> 63 else b
        a, b = b, a ^ int(hashlib.sha256(f"{KEY}|ipv6|{k}|{signed}".encode()).hexdigest()[:16], 16)
    return ":".join(f"{(a << 64 | b) >> at & 0xFFFF:x}" for at in range(112, -1, -16))


def changed(spark, cases):
    rows = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string").coalesce(1)
    return [tuple(r[1:]) for r in sorted(pii.pseudonymised(rows, KEY, ["doc_id"]).collect())]


def test_further_kinds_equal_brute_force(spark):
    d = datetime.date(1985, 3, 4)
    m, s = day(d), day(d, datetime.date(1970, 1, 1), (75, 487), "short_date")
    a, b = pair(122 * 99 + 44, 6788, (898 * 99, 9999), "ssn")
    area = a // 99 + (1 if a // 99 < 665 else 2)
    token = "ghp_" + "aB3" * 12
    want = {
        "on 1985/03/04.": f"on {m:%Y/%m/%d}.",
        "on 3/4/1985.": f"on {m.month}/{m.day}/{m.year}.",
        "on 3/4/85.": f"on {s.month}/{s.day}/{s:%y}.",
        "on 03/04/85.": f"on {s:%m/%d/%y}.",
        "on March 4, 1985.": f"on {m:%B} {m.day}, {m.year}.",
        "on 4 Mar. 1985.": f"on {m.day} {m:%b}. {m.year}.",
        "DE89 3704 0044 0532 0130 00 is": f"{iban('DE89 3704 0044 0532 0130 00')} is",
        "GB82WEST12345698765432": iban("GB82WEST12345698765432"),
        "ssn 123-45-6789,": f"ssn {area:03d}-{a % 99 + 1:02d}-{b + 1:04d},",
        "call 319-555-5132": "call " + spelt("319-555-5132", feistel("3195555132", "phone")),
        "call (319) 555-5132": "call " + spelt("(319) 555-5132", feistel("3195555132", "phone")),
        "at 2001:db8::8a2e:370:7334": f"at {address6('2001:db8::8a2e:370:7334')}",
        "at fe80::1": f"at {address6('fe80::1')}",
        "at 2001:0DB8:0:0:0:FF00:0042:8329!": f"at {address6('2001:db8::ff00:42:8329')}!",
        f"{token} x": f"ghp_{feistel(token[4:], 'secret')} x",
    }
    assert changed(spark, want) == [(text, 1) for text in want.values()]


def test_no_value_without_its_check(spark):
    plain = [
        "DE89 3704 0044 0532 0130 01", "XX89 3704 0044", "000-12-3456", "666-12-3456", "912-34-5678", "123-00-4567", "123-45-0000",
        "1-123-45-6789", "13/41/85", "2/30/1985", "Feb 30, 1985", "dead::beef", "std::vector", "12:30:45", "1985/13/04", "a/b/3/4/85/6", "sk-and-more-words-than-that",
        "123-555-5132",
    ]
    assert changed(spark, plain) == [(text, 0) for text in plain]


def test_spellings_share_a_pseudonym(spark):
    groups = [
        ["4111111111111111", "4111-1111-1111-1111", "4111 1111 1111 1111"],
        ["+13195555132", "+1 319 555 5132", "+1 (319) 555-5132"],
        ["+491701234567", "+49 170 1234 567"],
        ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00"],
        ["2001:db8::1", "2001:0db8:0:0:0:0:0:1", "2001:DB8::0001"],
    ]
    for group in groups:
        got = changed(spark, group)
        bare = [x if "::" in group[0] else re.sub("[^0-9A-Z]", "", x) for x, _ in got]
        assert len(set(bare)) == 1 and all(n == 1 for _, n in got) and bare[0] != re.sub("[^0-9A-Z]", "", group[0])


def test_cards_before_other_values(spark):
    card = "4111 1111 1111 1111"
    others = ["3/4/85", "1985/03/04", "4 March 1985", "123-45-6789", "319-555-5132", "2001:db8::1"]
    assert [n for _, n in changed(spark, [f"{card} {x}" for x in others])] == [2] * len(others)


def test_key_of_the_session(spark):
    first = queries.pseudonym_key(spark)
    spark.conf.set(queries.PSEUDONYM_SETTING, "of this job")
    try:
        assert queries.pseudonym_key(spark) == pii.round_key("of this job") != first
    finally:
        spark.conf.unset(queries.PSEUDONYM_SETTING)


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def one(spark, text):
    return pii.pseudonymised(spark.createDataFrame([(1, text)], "doc_id long, text string"), KEY, ["doc_id"]).first()


def test_strings_equal_brute_force(spark):
    assert one(spark, "by ab.42@mail8.example.com.")["text"] == f"by {feistel('ab.42', 'email')}@mail8.example.com."
    assert one(spark, "+1 (319) 555-5132")["text"] == "+1" + spelt(" (319) 555-5132", feistel("3195555132", "phone"))
    assert one(spark, 'token = "0641917ea4e9feb9"')["text"] == f'token = "{feistel("0641917ea4e9feb9", "secret")}"'


def test_secrets_by_keys_of_any_case_and_to_their_end(spark):
    value = "0641917ea4e9feb9"
    for head in ("TOKEN = \"", "Password: ", "API_KEY=", "SECRET=", "Api_Key = '", "PASSWD:", "mySecret="):
        assert tuple(one(spark, head + value)) == (1, head + feistel(value, "secret"), 1)
    long = "".join("aB3"[k % 3] for k in range(200))
    assert one(spark, f"token={long} end")["text"] == f"token={feistel(long, 'secret')} end"
    assert tuple(one(spark, "SECRET santa: none")) == (1, "SECRET santa: none", 0)


def test_cards_among_other_numbers(spark):
    def card(value):
        moved = spelt(value[:-1], feistel(re.sub("[ -]", "", value[:-1]), "card"))
        return moved + next(c for c in "0123456789" if luhn(re.sub("[ -]", "", moved) + c))

    a, b = "4111111111111111", "4111 1111 1111 1111"
    cases = [
        (f"{a} 123", f"{card(a)} 123", 1),
        (f"{b} 12/25", f"{card(b)} 12/25", 1),
        (f"no 2025 {b}.", f"no 2025 {card(b)}.", 1),
        (f"{b} {a} 77", f"{card(b)} {card(a)} 77", 2),
        (f"{b}-123", f"{card(b)}-123", 1),
        ("4539 5787 6362 1487 12/25", "4539 5787 6362 1487 12/25", 0),
    ]
    rows = [(k, text) for k, (text, _, _) in enumerate(cases)] + [(90, f"{a} 10.0.0.7"), (91, f"{a} 2024-02-29")]
    out = pii.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), KEY, ["doc_id"])
    got = {r["doc_id"]: (r["text"], r["n_values"]) for r in out.collect()}
    for k, (_, text, n) in enumerate(cases):
        assert got[k] == (text, n)
    assert got[90][1] == got[91][1] == 2 and "10.0.0.7" not in got[90][0] and "2024-02-29" not in got[91][0]


def test_formats_and_checks_hold(spark):
    card = one(spark, "4539 5787 6362 1486")["text"]
    assert re.fullmatch(r"\d{4} \d{4} \d{4} \d{4}", card) and luhn(card.replace(" ", "")) and card != "4539 5787 6362 1486"
    for text, shape in (("2024-02-29", r"\d{4}-\d\d-\d\d"), ("29.02.2024", r"\d\d\.\d\d\.\d{4}"), ("02/29/2024", r"\d\d/\d\d/\d{4}")):
        assert re.fullmatch(shape, one(spark, text)["text"]) and one(spark, text)["text"] != text
    for bad in ("300.1.2.3", "2023-02-29", "4539578763621487", "31.02.2020", "1.2.3.4.5", "", "plain", "a12-34"):
        assert tuple(one(spark, bad)) == (1, bad, 0)


def test_permutations_are_one_to_one_and_linked(spark):
    rows = spark.range(1500).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("ip 10.0."), (F.col("id") / 250).cast("int"), F.lit("."), F.col("id") % 250, F.lit(" on "),
                 F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).cast("string")).alias("text"),
    )
    got = [r["text"].split() for r in pii.pseudonymised(rows, KEY).collect()]
    assert len({x[1] for x in got}) == len({x[3] for x in got}) == 1500
    two = one(spark, "10.0.0.7 then 10.0.0.7 2024-02-29")["text"].split()
    assert two[0] == two[2] == one(spark, "at 10.0.0.7")["text"].split()[1]
    assert two[3] == one(spark, "2024-02-29")["text"]
    other = pii.pseudonymised(spark.createDataFrame([(1, "10.0.0.7")], "doc_id long, text string"), "other key").first()["text"]
    assert other != two[0]


def test_odd_documents_keep_their_text(spark):
    docs = clashing(frame(spark, texts() + [(30, "10.1.1.1")]))
    out = pii.pseudonymised(docs, KEY)
    assert out.columns == docs.columns
    want = defaultdict(list)
    for i, t in texts():
        want[i].append((t,))
    got = by_id(out, "text")
    assert got.pop(30) != [("10.1.1.1",)]
    assert got == {k: sorted(v, key=repr) for k, v in want.items()}
    assert pii.pseudonymised(frame(spark, []), KEY).count() == 0


def test_no_python_in_the_plans(spark):
    docs = frame(spark)
    turns = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    for df in (pii.pseudonymised(docs, KEY, ["doc_id"]), chat.digests(turns)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


# --- shards ----------------------------------------------------------------------


def brute_shard(doc_id, leaves):
    def draw(level, name, weight):
        seed = 42
        if doc_id is not None:
            seed = xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), seed)
        seed = xxhash.xxh64_intdigest(level.encode(), seed)
        seed = xxhash.xxh64_intdigest(name.to_bytes(4, "little"), seed)
        return -np.log(((seed >> 11) + 0.5) / 2.0**53) / weight

    for level in ("region", "rack", "shard"):
        weights = Counter()
        for leaf in leaves:
            weights[getattr(leaf, level)] += leaf.weight
        won = min(weights, key=lambda n: (draw(level, n, weights[n]), n))
        leaves = [x for x in leaves if getattr(x, level) == won]
    return leaves[0].shard


def test_one_more_shard_takes_rows_only_into_itself(spark):
    ids = spark.range(6000).coalesce(1)
    shards = lambda n: np.array([r[0] for r in ids.select(sharding.shard_of(F.col("id"), sharding.layout(n))).collect()])
    last, now = -1, None
    for n in [*range(1, 8), *range(11, 15), *range(19, 27), 39]:
        now = now if n == last + 1 else shards(n)
        last = n
        sizes = np.bincount(now, minlength=n)
        assert len(sizes) == n and sizes.min() > 0.6 * 6000 / n and sizes.max() < 1.45 * 6000 / n
        grown = shards(n + 1)
        assert ((grown == now) | (grown == n)).all()
        now = grown
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("id"), sharding.layout(0))


def test_shards_equal_brute_force(spark):
    old, new = sharding.layout(24), sharding.layout(25)
    docs = clashing(frame(spark, texts() + [(k, "t") for k in range(500, 900)]))
    rows = sharding.sharded(docs, old, new).collect()
    assert len(rows) == len(texts()) + 400
    for r in rows:
        assert (r["shard"], r["grown_shard"]) == (brute_shard(r["doc_id"], old), brute_shard(r["doc_id"], new))
        assert r["grown_shard"] in (r["shard"], 24) and r["law"] == "key"
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts() + [(k, "t") for k in range(500, 900)])
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want


def test_weights_set_the_shares_and_confine_moves(spark):
    ids = spark.range(20_000)
    before = [sharding.Leaf(k // 4, k // 2, k, 1.0 + k % 2) for k in range(8)]
    after = [x._replace(weight=4.0) if x.shard == 5 else x for x in before]
    moved = ids.select(sharding.shard_of(F.col("id"), before).alias("a"), sharding.shard_of(F.col("id"), after).alias("b"))
    shares = {r["a"]: r["count"] / 20_000 for r in moved.groupBy("a").count().collect()}
    assert all(abs(shares[x.shard] - x.weight / 12) < 0.012 for x in before)
    # Only towards the heavier region, rack and shard.
    for r in moved.where("a <> b").distinct().collect():
        assert (r["b"] // 4 == 1) and not (r["a"] == 5)
    assert sharding.sharded(frame(spark, []), before).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("id"), [x._replace(weight=0.0) for x in before])


# --- conversations -----------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def test_texts_with_control_strings_come_back(spark):
    odd = ["</s>", "<s>", "a</s><s>b", "<\\/s>", "<\\\\s>", "\\", "<", "s>", "/s>", "<</s>>", "", None, "x\n<s>user\nhi</s>", "ok", "<\\", "é🙂"]
    roles = ["user", "assistant", "", None, "a\nb", "a\\nb", "\\\\n", "<s>", "</s>\n", "<\\s>", "\\"]
    rows = [(k, j, r, t) for k, r in enumerate(roles) for j, t in enumerate(odd)]
    rows += [(None, 0, "assistant", "no id"), (50, None, "assistant", "b"), (50, 1, "assistant", "c"), (50, 1, "assistant", "c"), (50, 1, "assistant", "a")]
    df = spark.createDataFrame(rows, TURNS).withColumn("formatted", F.lit(1)).withColumn("start", F.lit(1)).repartition(4)
    whole = {r["conv_id"]: r for r in chat.formatted(df).withColumn("back", chat.parse(F.col("formatted"))).collect()}
    digests = {r["conv_id"]: r for r in chat.digests(df).collect()}
    key = lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")
    for conv in {r[0] for r in rows}:
        source = [(r or "", t or "") for _, _, r, t in sorted((x for x in rows if x[0] == conv), key=key)]
        got, d = whole[conv], digests[conv]
        assert [tuple(t) for t in got["back"]] == source and got["round_trip"] and d["round_trip"]
        loss = "".join(t for r, t in source if r == "assistant")
        masked = "".join(got["formatted"][m["start"] : m["start"] + m["length"]] for m in got["loss_mask"])
        assert re.sub(r"<\\(\\*/?s>)", r"<\1", masked) == loss or "<" in loss
        assert d["loss_chars"] == len(loss) and d["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert d["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in source).encode()).hexdigest()
        assert d["n_turns"] == len(source) and d["formatted_chars"] == len(got["formatted"])
    assert chat.digests(df.limit(0)).count() == 0


def test_control_strings_are_escaped_as_in_sql(spark, tmp_path):
    from check_oracle import duck, spark_rows, sql_rows

    odd = ["<s>", "a <s>user", "<\\s>", "</s>", "x < y", "s>", "plain"]
    rows = [(k, j, r, t) for k, t in enumerate(odd) for j, r in enumerate(("user", "assistant"))]
    df = spark.createDataFrame(rows, TURNS)
    for r in chat.formatted(df).collect():
        assert r["formatted"].count("<s>") == r["formatted"].count("</s>") == 2 and r["round_trip"]
    for r in chat.formatted(df).withColumn("text", F.expr("substr(formatted, loss_mask[0].start + 1, loss_mask[0].length)")).collect():
        assert re.sub(r"<\\(\\*/?s>)", r"<\1", r["text"]) == odd[r["conv_id"]]
    df.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    assert spark_rows(queries.QUERIES["op7_chat"](spark, str(tmp_path))) == sql_rows(duck(str(tmp_path)), queries.ORACLE["op7_chat"])


# --- neighbours ----------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 1.0], 1), (3, [0.0, 1.0], 1), (4, [-1.0, 0.0], 1), (5, [3.0, 0.0], 1), (5, [3.0, 0.0], 1)]
    rows += [(6, None, 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [1.0, None], 1), (10, [inf, 1.0], 1), (None, [1.0, 0.0], 1), (11, [], 1), (12, [1.0], 1)]
    df = vectors(spark, rows).withColumn("list", F.lit(1)).withColumn("score", F.lit(1)).repartition(3)
    got = neighbours.nearest(df, df.where("vec_id IN (0, 6, 7)"), k=5).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (0, 2, 5), (0, 3, 12), (0, 4, 2), (0, 5, 3)]
    assert got[0]["score"] == 1.0 and abs(got[3]["score"] - 0.5**0.5) < 1e-15
    assert [r["vec_id"] for r in neighbours.nearest(df, df.where("vec_id = 0"), k=50).orderBy("rank").collect()] == [1, 5, 12, 2, 3, 4]
    assert neighbours.nearest(df.limit(0), df).count() == neighbours.nearest(df, df.limit(0)).count() == 0


def test_every_query_gets_k_rows_where_lists_are_short(spark):
    rng = np.random.default_rng(3)
    near = rng.standard_normal((3000, 8)) * 0.05 + np.eye(8)[0]
    far = -np.eye(8)[0] + rng.standard_normal((3, 8)) * 0.01  # a list of their own
    rows = [(k, v.tolist(), 1) for k, v in enumerate(np.concatenate([far, near]))] + [(1, [-1.0] + [0.0] * 7, 1)] * 4  # a repeated id is one
    df = vectors(spark, rows)
    got = neighbours.nearest(df, df.where("vec_id IN (0, 50)"), k=5, list_rows=300).toPandas()
    assert got["query_id"].value_counts().to_dict() == {0: 5, 50: 5}
    assert not got.duplicated(["query_id", "vec_id"]).any() and (got["query_id"] != got["vec_id"]).all()


def test_recall_on_the_whole_table(spark):
    df = spark.read.parquet(f"{CHECK}/embeddings.parquet")
    rows = df.toPandas()
    x = np.stack(rows["embedding"]).astype(float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    ids = rows["vec_id"].to_numpy()
    out = queries.QUERIES["op9_neighbours"](spark, CHECK).toPandas()
    hit = total = 0
    for k in np.flatnonzero(ids % 50 == 0):
        near = x @ x[k]
        near[k] = -9
        mine = out[out["query_id"] == ids[k]]
        assert len(mine) == 5
        hit, total = hit + len(set(ids[np.lexsort((ids, -near))[:5]]) & set(mine["vec_id"])), total + 5
    assert hit >= 0.9 * total


@pytest.mark.parametrize("blocks", [(20_000, 2_000), (60, 3)])
def test_recall_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", blocks[1])
    df = spark.read.parquet(f"{CHECK}/embeddings.parquet").limit(1500)
    rows = df.toPandas()
    x = np.stack(rows["embedding"]).astype(float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    ids = rows["vec_id"].to_numpy()
    asked = df.where("vec_id % 50 = 0")
    out = neighbours.nearest(spark.createDataFrame(rows[["vec_id", "embedding"]]), asked, list_rows=100).toPandas()
    hit = total = 0
    for k in np.flatnonzero(ids % 50 == 0):
        near = x @ x[k]
        near[k] = -9
        best = set(ids[np.lexsort((ids, -near))[:5]].tolist())
        mine = out[out["query_id"] == ids[k]].sort_values("rank")
        assert mine["rank"].tolist() == [1, 2, 3, 4, 5] and mine["score"].is_monotonic_decreasing
        assert np.allclose(mine["score"], [near[ids == v][0] for v in mine["vec_id"]], atol=1e-12)
        hit, total = hit + len(best & set(mine["vec_id"])), total + 5
    assert hit >= 0.9 * total


# --- components ------------------------------------------------------------------------


def test_components_of_paths_and_stars(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 200), (301, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)} | {300: 300, 301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- pipeline ----------------------------------------------------------------------------


def test_stages_take_effect(spark, tmp_path):
    rng = np.random.default_rng(1)
    toxic = [(k, prose(k, 60) + (" idiot scum" if k % 4 == 0 else "")) for k in range(400)]
    passage = prose(9000, 30)
    extra = [(1001, prose(1001, 80) + " " + passage), (1002, "mail 10.2.3.4 " + prose(1002, 40)), (1003, None), (1004, ""), (1005, prose(1, 60)), (1006, prose(2, 60) + " end")]
    sf = str(tmp_path)
    docs = frame(spark, toxic + extra)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)], "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    for stage in stages[:-1]:
        assert stage(spark, clashing(docs), sf).columns == clashing(docs).columns
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    kept = {k for k in range(400) if k % 4} | {1001, 1002, 1003, 1004}
    assert set(out) == kept
    assert passage[:60] not in out[1001]["text"] and out[1001]["text"].startswith(prose(1001, 80))
    assert "10.2.3.4" not in out[1002]["text"] and out[1002]["text"].startswith("mail ")
    assert out[1003]["text"] is None and out[1003]["n_tokens"] == out[1004]["n_tokens"] == 0
    assert all(r["decoded_equal"] and len(r["ids"]) == 4 * r["n_tokens"] for r in out.values())


# --- SQL twins -----------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows_as_sql(spark, sf, name):
    from check_oracle import duck, spark_rows, sql_rows

    assert spark_rows(queries.QUERIES[name](spark, sf)) == sql_rows(duck(sf), queries.ORACLE[name])
