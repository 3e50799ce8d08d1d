"""Language ID by error-correcting output codes.

Each language has a codeword of +1 and -1. One binary character n-gram classifier predicts each bit; a text gets the
language whose codeword has the least summed logistic loss. Texts near a second codeword are flagged ambiguous.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import bounded_batches

#: Hashed features; bits of a codeword at least; labelled documents that the classifiers are fitted on, as expected numbers: of each
#: language, and of all of them together.
WIDTH, BITS, SAMPLE, POOL = 2048, 15, 800, 40_000
#: Values that fewer than one in so many labelled rows have are strays and no languages, so that no more of them reach the driver.
RARE = 10_000
#: Below this share of the best over the two best languages a text is ambiguous.
MARGIN = 0.6


def codes(n: int, seed: int = 7) -> np.ndarray:
    """n codewords of +1 and -1 with a large least distance: the best of many fixed random draws.

    Bits grow with the logarithm of n, so that words stay far apart: 14 of 80 bits or more at 250 words. Of many words the first draw
    is as good as any.
    """
    bits = max(BITS, math.ceil(10 * math.log2(n)))
    rng, best, most = np.random.default_rng(seed), None, -1
    if n > 64:
        return rng.choice([-1, 1], (n, bits))
    for _ in range(400):
        c = rng.choice([-1, 1], (n, bits))
        apart = (bits - c @ c.T) // 2 + bits * np.eye(n, dtype=int)
        constant = np.abs(c.sum(0)).max() == n  # a bit that all share tells nothing
        if n == 1 or (least := int(apart.min()) - 2 * bool(constant and n > 2)) > most:
            best, most = c, 0 if n == 1 else least
    return best


def features(text: str | None, width: int = WIDTH) -> np.ndarray | None:
    """Unit vector of hashed character 1- to 3-grams over the letters of the whole text; None if it has no letter."""
    if not text:
        return None
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    top = int(raw.max()) + 1
    table = _letters(top)
    x = np.where(table[raw], raw, 32).astype(np.uint32)
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32)  # runs of other characters count as one
    x = np.concatenate(([32], x[keep], [32])).astype(np.uint32)
    if not (x != 32).any():
        return None
    counts = np.zeros(width, np.float64)
    gram = x * np.uint32(2654435761)
    counts += np.bincount((gram >> np.uint32(21)) % width, minlength=width)
    for n in (1, 2):
        gram = gram[:-1] * np.uint32(2246822519) + x[n:] * np.uint32(3266489917)
        gram ^= gram >> np.uint32(15)
        counts += np.bincount((gram * np.uint32(2654435761) >> np.uint32(16)) % width, minlength=width)
    counts = np.sqrt(counts)
    return (counts / np.linalg.norm(counts)).astype(np.float32)


_TABLE = np.zeros(0, bool)


def _letters(top: int) -> np.ndarray:
    """For each code point below top, whether it is a letter; kept between texts."""
    global _TABLE
    if len(_TABLE) < top:
        _TABLE = np.array([chr(i).isalpha() for i in range(min(0x110000, max(top, 1024)))], bool)
    return _TABLE


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray
    weights: np.ndarray  # (width + 1, bits)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, its probability, and whether a second one is near."""
        margin = x @ self.weights[:-1] + self.weights[-1]
        # A word c loses sum(log(1 + exp(-c * margin))), and log(1 + exp(-m)) = log(1 + exp(m)) - m: words differ by c * margin / 2 only.
        gain = margin @ self.code.T.astype(margin.dtype) / 2
        p = np.exp(gain - gain.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        first = p.argmax(1)
        most = p[np.arange(len(p)), first]
        second = np.where(np.arange(p.shape[1]) == first[:, None], 0, p).max(1)
        return first, most, most < MARGIN * (most + second)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model | None:
    """Fits on a sample of about `sample` documents of each language, chosen by a hash of key and text, so that rows without a key are drawn like others, repeated rows once; None without any labelled letter.

    With more than POOL / sample languages each gets an even part of the POOL. Rows with null text or language, or without a letter,
    are left out, and those whose language is a stray value (RARE); no other bound on the number of languages.
    """
    bounded_batches(labelled.sparkSession)
    rows = labelled.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")).where("l is not null and t is not null")
    # The roll-up's row without a language counts all rows and is the first; no language beyond RARE others can have its share.
    top = rows.rollup("l").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("l")).limit(RARE + 1).collect()
    counts = {r["l"]: r["n"] for r in top if r["l"] is not None and r["n"] * RARE >= top[0]["n"]}
    if not counts:
        return None
    each = min(sample, POOL / len(counts))
    shares = labelled.sparkSession.createDataFrame([(k, min(1.0, each / n)) for k, n in counts.items()], "l string, share double")
    some = rows.join(F.broadcast(shares), "l").where(F.pmod(F.xxhash64("k", "t"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    some = some.select("k", "l", "t").dropDuplicates().select("l", "t")

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [(lang_, v.astype(np.float16).tobytes()) for lang_, t in zip(b["l"], b["t"], strict=True) if (v := features(t)) is not None]
            yield pd.DataFrame(got, columns=["l", "v"])

    fitted = some.mapInPandas(vectors, "l string, v binary").orderBy("l", "v").toPandas()
    if fitted.empty:
        return None
    langs = sorted(fitted["l"].unique())
    code = codes(len(langs))
    x = np.frombuffer(b"".join(fitted["v"]), np.float16).reshape(len(fitted), WIDTH).astype(np.float32)
    y = code[np.searchsorted(langs, fitted["l"])].astype(np.float32)
    return Model(langs, code, logistic(x, y))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 300, rate: float = 6.0, decay: float = 1e-5) -> np.ndarray:
    """Weights and intercepts of one logistic regression for each column of y (+1, -1), by accelerated gradient descent."""
    x1 = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = np.zeros((x1.shape[1], y.shape[1]), np.float32)
    ahead = w.copy()
    for k in range(rounds):
        slope = -(x1.T @ (y / (1 + np.exp(np.clip(y * (x1 @ ahead), -30, 30))))) / len(x1) + decay * ahead
        new = ahead - rate * slope
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return w


def identify(docs: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score, ambiguous) for each row.

    Null, empty and letterless texts, and any text if nothing was learned: 'und', score 0, not ambiguous.
    Repeated rows and null keys each give their own row; other columns are left alone.
    """
    bounded_batches(docs.sparkSession)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [features(t) if model else None for t in b["t"]]
            lang, score, near = np.full(len(b), "und", object), np.zeros(len(b)), np.zeros(len(b), bool)
            at = [i for i, v in enumerate(found) if v is not None]
            if at:
                first, most, unsure = model.predict(np.stack([found[i] for i in at]))
                lang[at], score[at], near[at] = np.array(model.langs, object)[first], most, unsure
            yield pd.DataFrame({"k": b["k"], "lang_pred": lang, "score": score, "ambiguous": near})

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(predict, f"k {kind}, lang_pred string, score double, ambiguous boolean")
    return out.withColumnRenamed("k", key)
