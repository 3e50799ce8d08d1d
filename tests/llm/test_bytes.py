"""Byte-level BPE against the tiktoken library, chunk by chunk and over whole tables."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from opslake.llm import op12_bytes

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return op12_bytes.tokenizer(PATH, PATTERN)


ALPHABET = list("abcdeEÉß  \n\t'’sdltrevm0123٣½.,!?-_#日本語한한글😀🏽‍  \x1c\x85́ͅ") + ["'ll", "'ve", "՘", "౜", "<|endoftext|>"]


def odd(r, n):
    return "".join(r.choice(ALPHABET) for _ in range(n))


def ids(own, text):
    return own.ids(own.encode_pieces(own.pieces(text))).tolist()


def test_every_code_point(library, own):
    for low in range(0, 0x110000, 997):
        text = "a".join(chr(c) for c in range(low, min(low + 997, 0x110000)) if not 0xD800 <= c < 0xE000)
        assert ids(own, text) == library.encode_ordinary(text)


def test_random_texts_and_long_pieces(library, own):
    r = random.Random(7)
    for text in [odd(r, r.randint(0, 60)) for _ in range(3000)] + ["ab" * 30_000, "".join(r.choice("abcdefgh") for _ in range(20_000)), " " * 5000 + "x", "'" * 3000]:
        assert ids(own, text) == library.encode_ordinary(text)
        assert own.decode(np.array(ids(own, text))) == text.encode()


LONG_TEXTS = {
    "prose": lambda r: " ".join("".join(r.choice("abcdefgh'") for _ in range(r.randint(1, 9))) for _ in range(20_000)),
    "odd": lambda r: odd(r, 60_000),
    "one word": lambda r: "".join(r.choice("abcd") for _ in range(60_000)),
    "word between": lambda r: "x y " * 6000 + "z" * 40_000 + " u v" * 6000,
    "blanks": lambda r: "x" * 16_000 + " " * 20_000 + "y" + "\n" * 17_000 + " z",
    "no blanks": lambda r: "".join(r.choice("日本語12,.") for _ in range(50_000)),
    "contractions": lambda r: "'ll've'" * 9000,
    "edge": lambda r: "a" * (op12_bytes.STRIDE - 1) + "'ll" + "b" * 511 + " " + "c" * 20_000,
}


def test_tables(spark, library):
    r = random.Random(9)
    texts = [None, "", " ", *[f(r) for f in LONG_TEXTS.values()], *[f(r) for f in LONG_TEXTS.values()]]
    for n in range(-2, 4):  # lengths about the limits of one and of two chunks
        texts += [odd(r, op12_bytes.STRIDE + op12_bytes.OVERLAP + n), odd(r, 2 * op12_bytes.STRIDE + op12_bytes.OVERLAP + n)]
    texts += [odd(r, r.randint(1, 40)) for _ in range(50)]
    rows = [(k if k % 7 else None, t, k) for k, t in enumerate(texts)] + [(3, texts[3], -1)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").withColumns({c: F.lit("x") for c in ("k", "t", "row", "chunk", "ids", "start", "piece")}).repartition(4)
    want = sorted((repr(k), len(i := library.encode_ordinary(t or "")), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for k, t, _ in rows)
    got = op12_bytes.digests(df, PATH, PATTERN)
    assert sorted((repr(x["doc_id"]), x["n_tokens"], x["ids_sha256"], x["decoded_sha256"]) for x in got.collect()) == want
    back = op12_bytes.decode(op12_bytes.encode(df, PATH, PATTERN), PATH, PATTERN)
    assert sorted((repr(x["doc_id"]), bytes(x["decoded"])) for x in back.collect()) == sorted((repr(k), (t or "").encode()) for k, t, _ in rows)


def test_chunks_that_agree_are_segments_of_their_own(spark, own):
    r = random.Random(2)
    for name, least in (("prose", 5), ("no blanks", 3), ("one word", 1)):
        text = LONG_TEXTS[name](r)
        n = op12_bytes.chunk_count(len(text))
        parts = [text[k * op12_bytes.STRIDE :][: op12_bytes.STRIDE + op12_bytes.OVERLAP] for k in range(n)]
        rows = [(1, k, k * op12_bytes.STRIDE, op12_bytes.boundaries(own, p, k == n - 1), op12_bytes.SURE.search(p, 0, op12_bytes.STRIDE) is not None) for k, p in enumerate(parts)]
        got = op12_bytes.stitched(spark.createDataFrame(rows, "row long, chunk long, start long, ends array<int>, sure boolean")).collect()
        assert len({x["seg"] for x in got}) == (n if name != "one word" else 1) >= least
        true = set(own.ends(text)) | {0}
        assert {x["begin"] for x in got} <= true


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert op12_bytes.digests(df, PATH, PATTERN).collect() == []
    assert op12_bytes.decode(op12_bytes.encode(df, PATH, PATTERN), PATH, PATTERN).collect() == []
