"""BPE encoding and decoding by batched numpy merge rounds.

The symbols of many words lie in one flat array. A round looks up the ranks of all neighbouring pairs by binary search
over the sorted pair keys, and merges in each word all places of its lowest rank, until no pair has a rank. (What a merge
makes only takes part in merges of higher rank, so the places of one rank can go together.) Very long words have rounds of
their own, which look up only the pairs that the last round changed.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import bounded_batches

#: Words whose ids one Python worker keeps; bytes from which on a word is long, and is not kept; characters of the texts that are
#: divided into words at a time, since words as objects take a dozen times the room of their text. A longer text stands alone.
KEPT_WORDS, LONG, AT_A_TIME = 200_000, 400, 1 << 20
NONE = np.int64(1 << 40)


# Ranges that are letters or digits for this regex module and neither for the tokenizer's own, whose Unicode tables are older.
NEWER = """
558-558 58b-58c 88f-88f c5c-c5c cdc-cdc 208f-208f 209d-209f a7ce-a7cf a7d2-a7d2 a7d4-a7d4 a7dd-a7dd a7e2-a7e2 a7f1-a7f1 ab6c-ab6d
107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a-11b0a 11db0-11ddb 11de0-11de9 11df1-11df1 1246f-1246f 12475-1247f 12550-12686
16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168-1b168
1d6a6-1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff
2b73a-2b73f 2b81e-2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f
"""
# Ranges of marks that Python's Unicode tables put in order among other marks (11930: compose with a letter), and the tokenizer's older ones don't.
MARKS = """
7fd-7fd 898-89f 8ca-8d3 9fe-9fe c3c-c3c d3b-d3c eba-eba 1715-1715 1abf-1ace 1df6-1dfa a82c-a82c 10d24-10d27 10eab-10eac 10efd-10eff 10f46-10f50
10f82-10f85 11070-11070 1133b-1133b 1145e-1145e 11839-1183a 11930-11930 1193d-1193e 11943-11943 119e0-119e0 11a34-11a34 11a47-11a47 11a99-11a99 11d42-11d42
11d44-11d45 11d97-11d97 11f41-11f42 16ff0-16ff1 1e08f-1e08f 1e130-1e136 1e2ae-1e2ae 1e2ec-1e2ef 1e4ec-1e4ef
"""
# Capitals (or a range of them) that are newer than Python's Unicode tables, with the first small letter.
CAPITALS = "1c89:1c8a a7cb:264 a7cc:a7cd a7ce:a7cf a7d2:a7d3 a7d4:a7d5 a7da:a7db a7dc:19b 10d50-10d65:10d70 16ea0-16eb8:16ebb"


def small_letters() -> dict[int, int]:
    """The small letter of each of the CAPITALS."""
    out = {}
    for entry in CAPITALS.split():
        capitals, small = entry.split(":")
        first, last = (int(x, 16) for x in (capitals.split("-") * 2)[:2])
        out |= {first + k: int(small, 16) + k for k in range(last - first + 1)}
    return out


class WordBpe:
    """A lower-casing word BPE with word ends, read from a tokenizer file; ids are those of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end: str = model["end_of_word_suffix"]
        self.ids: dict[str, int] = dict(model["vocab"])
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special = special
        self.tokens: dict[int, str] = {v: k for k, v in (self.ids | special).items()}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
        newer, marks = ("".join("-".join(f"\\U{x:0>8}" for x in r.split("-")) for r in ranges.split()) for ranges in (NEWER, MARKS))
        self.newer_marks = regex.compile(f"([{marks}])")
        self.rare_words = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|(?:(?![{newer}])\p{{L}})+|(?![{newer}])\p{{N}}|(?:[{newer}]|[^\p{{White_Space}}\p{{L}}\p{{N}}])+")
        # Bytes that stand for themselves in byte-level vocabularies; the others follow from 256 on in order.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(plain))}
        letters = [rest.get(b, chr(b)) for b in range(256)]
        self.inner = np.array([self.ids.get(x, -1) for x in letters], np.int64)
        self.last = np.array([self.ids.get(x + self.end, -1) for x in letters], np.int64)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        key = np.array([(self.ids[a] << 32) | self.ids[b] for a, b in merges], np.int64)
        made = np.array([self.ids[a + b] for a, b in merges], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made[order]
        self.kept: dict[str, bytes] = {}
        self.newer_small = small_letters()

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair of symbols (NONE: no merge) and the symbol that it makes."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE), self.made[at]

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one long word: symbols are linked by their places, and rounds look up the ranks of changed pairs alone."""
        flat = np.frombuffer(word, np.uint8)
        sym = self.inner[flat]
        sym[-1] = self.last[flat[-1]]
        sym = sym[sym >= 0]
        while len(sym) > 1:  # anew with the symbols that are left, whenever half of them are gone
            n = len(sym)
            after, before, gone = np.arange(1, n + 1), np.arange(-1, n - 1), np.zeros(n, bool)
            rank, made = (np.append(x, NONE) for x in self.ranked(sym[:-1], sym[1:]))
            dead = 0
            while 2 * dead <= n:
                hit = np.flatnonzero(rank == rank.min())
                if rank[hit[0]] == NONE:
                    return sym[~gone]
                hit = apart(hit, after[hit[:-1]] == hit[1:])
                lost = after[hit]
                sym[hit], after[hit], gone[lost], rank[lost] = made[hit], after[lost], True, NONE
                dead += len(hit)
                some = after[hit] < n
                before[after[hit[some]]] = hit[some]
                changed = np.concatenate((hit, before[hit]))
                changed = changed[changed >= 0]
                changed = changed[~gone[changed]]
                right = after[changed]
                rank[changed[right == n]] = NONE
                changed, right = changed[right < n], right[right < n]
                rank[changed], made[changed] = self.ranked(sym[changed], sym[right])
            sym = sym[~gone]
        return sym

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word, given as its bytes."""
        sizes = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        sym, word = self.inner[flat], np.repeat(np.arange(len(words)), sizes)
        ends = np.cumsum(sizes) - 1
        sym[ends] = self.last[flat[ends]]
        keep = sym >= 0  # bytes without an entry are left out
        sym, word = sym[keep], word[keep]
        done_sym, done_word = [], []
        while len(sym):
            same = word[1:] == word[:-1]
            rank, made = self.ranked(sym[:-1], sym[1:])
            rank = np.append(np.where(same, rank, NONE), NONE)
            start = np.flatnonzero(np.append(True, ~same))
            least = np.minimum.reduceat(rank, start)
            per = np.diff(np.append(start, len(sym)))
            live = np.repeat(least < NONE, per)
            done_sym.append(sym[~live])
            done_word.append(word[~live])
            hit = np.flatnonzero(live & (rank == np.repeat(least, per)))
            hit = apart(hit, hit[1:] == hit[:-1] + 1)
            sym[hit] = made[hit]
            live[hit + 1] = False
            sym, word = sym[live], word[live]
        sym, word = np.concatenate([*done_sym, sym]), np.concatenate([*done_word, word])
        order = np.argsort(word, kind="stable")
        return np.split(sym[order], np.searchsorted(word[order], np.arange(1, len(words))))

    def composed(self, text: str) -> str:
        """The text in composed form; at newer marks it is divided, since for the tokenizer nothing moves or composes across them."""
        if latin(text) or not self.newer_marks.search(text):
            return unicodedata.normalize("NFC", text)
        return "".join(x if k % 2 else unicodedata.normalize("NFC", x) for k, x in enumerate(self.newer_marks.split(text)))

    def pieces(self, text: str) -> Iterator[str | int]:
        """Words of the normalised text, and ids of special tokens that stand in it."""
        for part in self.split_special.split(text) if self.split_special and "<" in text else [text]:
            if part in self.special:
                yield self.special[part]
                continue
            part = self.composed(part)
            low = part.lower() if "Σ" not in part else "".join(c.lower() for c in part)
            if not latin(low):
                low = low.translate(self.newer_small)
            yield from (self.words if latin(low) else self.rare_words).findall(low)

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; null and empty texts have none."""
        part = np.cumsum([len(t) if t else 0 for t in texts], dtype=np.int64) // AT_A_TIME
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(texts)]
        return [ids for lo, hi in itertools.pairwise(cuts) for ids in self.encode_some(texts[lo:hi])]

    def encode_some(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [list(self.pieces(t)) if t else [] for t in texts]
        if len(self.kept) > KEPT_WORDS:
            self.kept.clear()
        new, long = [], {}
        for w in {w for ws in split for w in ws if isinstance(w, str) and w not in self.kept}:
            if len(raw := w.encode("utf-8", "surrogatepass")) < LONG:
                new.append(w)
            else:
                long[w] = self.merge_long(raw).astype("<u4").tobytes()
        for lo in range(0, len(new), 1 << 16):
            some = new[lo : lo + (1 << 16)]
            for w, ids in zip(some, self.merge([w.encode("utf-8", "surrogatepass") for w in some]), strict=True):
                self.kept[w] = ids.astype("<u4").tobytes()
        known = self.kept | long if long else self.kept
        one = {i: np.array([i], "<u4").tobytes() for i in self.special.values()}
        return [np.frombuffer(b"".join([known[w] if isinstance(w, str) else one[w] for w in ws]), "<u4") for ws in split]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens of the ids, joined by blanks, as a tokenizer without a decoder gives them."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


def apart(hit: np.ndarray, touching: np.ndarray) -> np.ndarray:
    """Of places in order, every second one in each run of places that touch the one before: a repeated symbol merges from the left."""
    if not touching.any():
        return hit
    k = np.arange(len(hit))
    start = np.maximum.accumulate(np.where(np.append(True, ~touching), k, 0))
    return hit[(k - start) % 2 == 0]


def latin(text: str) -> bool:
    """Whether all characters are below U+0100, where the tables agree."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids array<int>) for each row; null and empty texts have no ids. path: the tokenizer file, on every machine."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer(path)
        for b in batches:
            yield pd.DataFrame({"k": b["k"], "ids": [x.astype(np.int32) for x in t.encode_batch(b["t"].tolist())]})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def decode(ids: DataFrame, path: str, column: str = "ids", key: str = "doc_id") -> DataFrame:
    """(key, decoded string) for each row of ids; null ids decode to the empty text."""
    bounded_batches(ids.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer(path)
        for b in batches:
            yield pd.DataFrame({"k": b["k"], "decoded": [t.decode(np.asarray(x)) if x is not None else "" for x in b["i"]]})

    kind = ids.schema[key].dataType.simpleString()
    return ids.select(F.col(key).alias("k"), F.col(column).alias("i")).mapInPandas(run, f"k {kind}, decoded string").withColumnRenamed("k", key)


def digests(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encodes each text, decodes the ids, and digests both in the same pass."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer(path)
        for b in batches:
            ids = t.encode_batch(b["t"].tolist())
            yield pd.DataFrame({
                "k": b["k"], "n_tokens": np.array([len(x) for x in ids], np.int64),
                "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(t.decode(x).encode()).hexdigest() for x in ids],
            })

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("k", key)
