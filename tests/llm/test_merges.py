"""Encoding by a queue of merges, against the public library and a plain version."""

import hashlib
import json
import random
import time

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from paywarden.llm import bpe, merges, queries
from tests.llm.cases import clashing, frame, texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    return merges.Coder(merges.read_tokenizer(PATH), public_tokenizers.PATTERN)


def same(coder, library, text):
    ids = coder.encoded(text).tolist()
    wanted = library.encode(text, add_special_tokens=False).ids
    return ids == wanted and coder.decoded(ids) == library.decode(wanted, skip_special_tokens=False) == text


def every_code_point():
    """All planes that hold characters, and the ends of the others; each between letters, digits and blanks."""
    codes = [c for c in range(0x33000) if not 0xD800 <= c < 0xE000]
    codes += [*range(0xE0000, 0xE0200), 0x33001, 0x4FFFF, 0xDFFFF, 0xF0000, 0xFFFFD, 0x10FFFF]
    for first in range(0, len(codes), 4096):
        yield "\n".join(f"a{c}a's1{c}1 {c}'ll" for c in map(chr, codes[first : first + 4096]))


def test_every_code_point_between_letters_digits_and_blanks(coder, library):
    for text in every_code_point():
        assert same(coder, library, text), hex(ord(text[1]))


def test_every_code_point_by_the_ranks_too():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    for text in every_code_point():
        data = codec.encoded(text)
        ids = [int.from_bytes(data[i : i + 4], "little") for i in range(0, len(data), 4)]
        assert ids == library.encode_ordinary(text), hex(ord(text[1]))


def test_special_strings_are_tokens_wherever_they_stand(coder, library):
    for text in ("<|endoftext|>", "a<|endoftext|>'s b", " <|endoftext|> <|endoftext|><|endoftext|>", "<|endof<|endoftext|>text|>", "<|endoftext|"):
        assert same(coder, library, text)
    assert coder.encoded("a<|endoftext|>").tolist()[-1] == 50256


def test_long_matches_take_no_square_of_their_length(coder, library):
    rng = random.Random(3)
    blob = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") for _ in range(100_000))
    for text in ("a" * 100_000, "-" * 100_000, " " * 100_000, "\n" * 100_001, blob, "ab" * 50_000, "é" * 50_000):
        start = time.perf_counter()
        coder.encoded(text)
        assert time.perf_counter() - start < 3
        assert same(coder, library, text)


def test_random_mixtures_equal_the_library(coder, library):
    rng = random.Random(5)
    parts = ["don't", "'ll", "'", " ", "  ", "\t", "\r\n", "é", "日本", "🙂", "½", "٣", "the", "ing", "12", "...", "\u0085", "　", "İ", "́"]
    for _ in range(400):
        assert same(coder, library, "".join(rng.choice(parts) for _ in range(rng.randrange(40))))


def plainly(pairs, data):
    """Merge the pair of lowest rank, the leftmost first, until none is left."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while True:
        ranked = [(pairs[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in pairs]
        if not ranked:
            return parts
        at = min(ranked)[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


def test_the_queue_equals_plain_merging_on_a_small_vocabulary():
    rng = random.Random(9)
    for _ in range(30):
        tokens = [bytes([b]) for b in range(256)]
        small, pairs = [b"a", b"b", b"c"], []
        while len(pairs) < 25:
            a, b = rng.choice(small), rng.choice(small)
            if a + b not in tokens:
                tokens.append(a + b)
                small.append(a + b)
                pairs.append((a, b))
        merger = merges.Merger(merges.Tokenizer(dict(enumerate(tokens)), pairs, {}))
        ranks = {p: k for k, p in enumerate(pairs)}
        for _ in range(40):
            data = bytes(rng.choice(b"abc") for _ in range(rng.randrange(40)))
            assert [tokens[i] for i in merger.encoded(data)] == plainly(ranks, data)


def test_other_tokenizers_are_refused(tmp_path):
    with pytest.raises(ValueError, match="byte-level"):
        merges.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    said = json.load(open(PATH))
    said["added_tokens"][0]["lstrip"] = True
    (tmp_path / "t.json").write_text(json.dumps(said))
    with pytest.raises(ValueError, match="byte-level"):
        merges.read_tokenizer(str(tmp_path / "t.json"))


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), back == (text or "")


def test_query_equals_the_library(spark, sf, library):
    out = queries.QUERIES["op11_merges"](spark, sf)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "decoded_equal"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    wanted = sorted((r["doc_id"], *digests(library, r["text"])) for r in docs)
    assert sorted(map(tuple, out.collect())) == wanted and all(w[4] for w in wanted)


def test_odd_rows_empty_tables_and_clashing_columns(spark, library):
    queries.ship(spark)
    tokenizer = merges.read_tokenizer(PATH)
    rows = [*texts(), (40, "a<|endoftext|>b"), (40, "a<|endoftext|>b")]
    out = merges.encode_frame(clashing(frame(spark, rows)), tokenizer, public_tokenizers.PATTERN, ["doc_id", "text", "node", "_text"])
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["decoded_equal"]) for r in out.collect()), key=repr)
    assert got == sorted(((i, *digests(library, t)) for i, t in rows), key=repr)
    for r in out.collect():
        assert r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
    assert merges.encode_frame(frame(spark, []), tokenizer, public_tokenizers.PATTERN, ["doc_id"]).count() == 0
    with pytest.raises(ValueError, match="ids"):
        merges.encode_frame(clashing(frame(spark)), tokenizer, public_tokenizers.PATTERN, ["ids"])
