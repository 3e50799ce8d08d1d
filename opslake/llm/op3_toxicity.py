"""Toxicity by noisy-channel deobfuscation.

Obfuscated spans (leetspeak, spaced letters, repetitions, hidden letters) become lattices of characters; a Viterbi search
under a character trigram model of the corpus restores them. Words and word beginnings that toxic documents use far more
than others then score the restored text.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import bounded_batches

#: Letters of the character model: Latin ones, a blank, and one symbol for all else.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
BLANK, OTHER, SIZE = len(LETTERS), len(LETTERS) + 1, len(LETTERS) + 2
# Letters that a sign may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "£": "l"}
#: Channel costs in nats: a sign for a letter, a sign that stays, a hidden letter, a dropped or kept separator, a dropped repetition, a kept third letter.
COST_LEET, COST_SIGN, COST_HIDDEN, COST_DROP, COST_KEEP, COST_REPEAT, COST_THIRD = 1.0, 4.0, 2.5, 0.5, 3.0, 0.5, 4.0
#: Letters that asterisks in a row may hide; further ones of a ruled line are dropped.
HIDDEN = 8
#: Labelled documents that the word weights are counted on, as expected number; documents that a feature needs.
SAMPLE, LEAST = 12_000, 5
#: Kinds of preceding words that a feature needs in toxic documents, of 63; share of toxic documents that a word's beginning needs.
CONTEXTS, PURE = 8, 0.97
PREFIXES = (3, 4, 5, 6)

_sign = re.escape("".join(LEET))
SPACED = re.compile(rf"(?<![^\s])(?:[^\W_]|[{_sign}])(?:[ .\-_*](?:[^\W_]|[{_sign}])){{2,}}(?![^\s.,;:!?])")
TOKEN = re.compile(rf"[^\W_]+(?:[{_sign}*.\-_]+[^\W_]+)+|[{_sign}]+[^\W\d_]+(?:[{_sign}*]*[^\W_]+)*|[^\W_]+[@$!|+€£](?=[\s.,;:]|$)|[^\W_]+")
SUSPECT = re.compile(rf"[^\W\d_][\d@$!|+€£(*.\-_]+[^\W_]|[\d@$|+€£(][^\W\d_]|[^\W\d_][\d@$|€£]|([^\W\d_])\1\1")
WORD = re.compile(r"[^\W\d_]{3,}")


def codes(text: str) -> np.ndarray:
    """Symbols of the character model for the lower-case text."""
    raw = np.frombuffer(text.lower().encode("utf-16-le", "surrogatepass"), np.uint16)
    return _CODE[np.minimum(raw, 255)] * (raw < 256) + OTHER * (raw >= 256)


_CODE = np.full(256, OTHER, np.int64)
for _i, _c in enumerate(LETTERS):
    _CODE[ord(_c)] = _i
for _c in " \t\n\r\v\f.,;:?":
    _CODE[ord(_c)] = BLANK


def character_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(gram, n): how often each character trigram occurs in all texts. At most SIZE ** 3 rows; null texts have none."""
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SIZE**3, np.int64)
        for b in batches:
            x = codes("  ".join(t for t in b["t"] if t))
            if len(x) > 2:
                total += np.bincount((x[:-2] * SIZE + x[1:-1]) * SIZE + x[2:], minlength=SIZE**3)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"gram": at, "n": total[at]})

    return docs.select(F.col(text).alias("t")).mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(counts: pd.DataFrame) -> np.ndarray:
    """Cost in nats of each symbol after two others: trigrams backed off to bigrams and single symbols."""
    tri = np.zeros(SIZE**3)
    tri[counts["gram"].to_numpy(np.int64)] = counts["n"]
    tri = tri.reshape(SIZE, SIZE, SIZE)
    bi, one = tri.sum(0), tri.sum((0, 1)) + 1
    p1 = one / one.sum()
    p2 = (bi + 5 * p1) / (bi.sum(1, keepdims=True) + 5)
    p3 = (tri + 5 * p2) / (tri.sum(2, keepdims=True) + 5)
    return -np.log(p3).astype(np.float32)


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """What each character of a span may stand for, and the channel's cost of it; "" where nothing stands behind it."""
    spaced = bool(SPACED.fullmatch(span))
    columns, run = [], 0
    for k, c in enumerate(span):
        run = run + 1 if k and span[k - 1] == c else 1
        if c.isalpha():
            options = [(c, 0.0 if run < 3 else COST_THIRD)]
            if run > 1:
                options.append(("", COST_REPEAT))
        elif c in " .-_*" and (spaced or 0 < k < len(span) - 1):
            options = [("", COST_DROP)]
            if c != "*" or run <= HIDDEN:
                options.append((" ", COST_KEEP))
            if c == "*" and run <= HIDDEN:
                options += [(x, COST_HIDDEN) for x in LETTERS[:26]]
        else:
            options = [(x, COST_LEET) for x in LEET.get(c, "")] + [(c, COST_SIGN)]
            if run > 1:
                options.append(("", COST_REPEAT))
        columns.append(options)
    return columns


def restore(span: str, cost: list) -> str:
    """The most likely text behind an obfuscated span, by Viterbi search over its whole lattice.

    A state is the last two symbols; of each state the cheapest way is kept, as a chain of characters that ways share.
    """
    states = {(BLANK, BLANK): (0.0, None)}
    for options in lattice(span):
        if len(options) == 1 and not options[0][0]:  # costs all ways the same
            continue
        symbols = [(x, int(_CODE[ord(x)]) if x and ord(x) < 256 else OTHER, extra) for x, extra in options]
        new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (so_far, way) in states.items():
            row = cost[a][b]
            for x, s, extra in symbols:
                state, total = ((b, s), so_far + extra + row[s]) if x else ((a, b), so_far + extra)
                if state not in new or total < new[state][0]:
                    new[state] = (total, (way, x) if x else way)
        states = new
    way, out = min(states.items(), key=lambda x: x[1][0] + cost[x[0][0]][x[0][1]][BLANK])[1][1], []
    while way:
        way, x = way
        out.append(x)
    return "".join(reversed(out))


class Restorer:
    """Restores whole texts; keeps what it restored."""

    def __init__(self, cost: np.ndarray):
        self.cost, self.kept = cost.tolist(), {}

    def one(self, span: str) -> str:
        if span not in self.kept:
            if len(self.kept) > 50_000:
                self.kept.clear()
            self.kept[span] = restore(span, self.cost)
        return self.kept[span]

    def text(self, text: str) -> str:
        low = SPACED.sub(lambda m: self.one(m[0]), text.lower())
        if not SUSPECT.search(low):
            return low
        return TOKEN.sub(lambda m: self.one(m[0]) if SUSPECT.search(m[0]) else m[0], low)


def features(word: str) -> list[str]:
    """A word as a whole, and its beginnings."""
    return [word + "$", *[word[:n] for n in PREFIXES if len(word) >= n]]


@dataclass
class Model:
    cost: np.ndarray
    weight: dict[str, float]  # how sure a feature is, as a chance
    base: float

    def __post_init__(self) -> None:
        self.heads = {f[: PREFIXES[0]] for f in self.weight}  # other words have no telling feature

    def score(self, text: str | None, restorer: Restorer) -> tuple[float, int]:
        """Chance that a text is toxic, and the number of telling words."""
        if not text:
            return self.base, 0
        miss, n = 1.0, 0
        for w in {w for w in WORD.findall(restorer.text(text)) if w[: PREFIXES[0]] in self.heads}:
            if best := max((self.weight.get(f, 0.0) for f in features(w)), default=0.0):
                miss, n = miss * (1 - best), n + 1
        return max(self.base, 1 - miss), n


def fit(docs: DataFrame, labelled: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """The character model from all texts of docs, and the weights from about `sample` rows of labelled (key, text, label), chosen by a hash of the key.

    Null labels and texts are left out. Without labelled rows every text scores the base chance.
    """
    cost = language_model(character_counts(docs, text).toPandas())
    bounded_batches(docs.sparkSession)
    rows = labelled.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(label).cast("int").alias("y")).where("t is not null and y is not null")
    n = rows.count()
    some = rows.where(F.pmod(F.xxhash64("k"), F.lit(1 << 20)) < min(1.0, sample / max(n, 1)) * (1 << 20))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer, sides, after = Restorer(cost), (Counter(), Counter()), Counter()
        for b in batches:
            for t, y in zip(b["t"], b["y"], strict=True):
                words = WORD.findall(restorer.text(t))
                found = {f for w in set(words) for f in features(w)}
                sides[y > 0].update(found)
                sides[y > 0][""] += 1  # documents
                if y > 0:
                    for before, w in set(zip(["", *words], words)):
                        bit = 1 << zlib.crc32(before.encode()) % 63
                        for f in features(w):
                            after[f] |= bit
        every = list(sides[0].keys() | sides[1].keys())
        yield pd.DataFrame({"f": every, "pos": [sides[1][x] for x in every], "neg": [sides[0][x] for x in every], "after": [after[x] for x in every]}, dtype=object).astype({"pos": "int64", "neg": "int64", "after": "int64"})

    counted = some.select("t", "y").mapInPandas(count, "f string, pos long, neg long, after long").groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.bit_count(F.bit_or("after")).alias("contexts"))
    # The row of the documents themselves, and features that follow many different words: copies of one text repeat one context.
    told = counted.where(f"f = '' or (pos >= {LEAST} and pos > 4 * neg and contexts >= {CONTEXTS})").toPandas() if n else pd.DataFrame({"f": [], "pos": [], "neg": []})
    sizes = {f: (pos, neg) for f, pos, neg in zip(told["f"], told["pos"], told["neg"], strict=True)}
    pos, neg = sizes.pop("", (0, 0))
    prior = (pos + 1) / (pos + neg + 2) if pos + neg else 0.1
    weight = {}
    for f, (pos, neg) in sizes.items():
        share = pos / (pos + neg)
        gain = pos * math.log(share / prior) + (neg * math.log((1 - share) / (1 - prior)) if neg else 0.0) if share > prior else 0.0
        # Chance alone brings about one such among ten million features. A beginning has to be as good as always toxic.
        if gain > 20 and (f.endswith("$") or share >= PURE):
            weight[f] = pos / (pos + neg + 2)
    return Model(cost, weight, min(0.1, prior / 3))


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, score, n_words) for each row: the chance that it is toxic, and how many telling words its restored text has.

    Null, empty and wordless texts have the base chance.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(model.cost)
        for b in batches:
            got = [model.score(t, restorer) for t in b["t"]]
            yield pd.DataFrame({"k": b["k"], "score": [float(s) for s, _ in got], "n_words": [n for _, n in got]})

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, score double, n_words long").withColumnRenamed("k", key)
