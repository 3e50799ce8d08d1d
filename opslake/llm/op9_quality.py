"""Quality by co-training of a text view and a metadata view.

Two classifiers see different things of a document: its text, and what is known about it (source, language, length).
Over some rounds each looks at all unlabelled documents and labels those that it is sure of for the other one, which learns
from a hash sample of them in which copies count once. Both are calibrated on labelled documents that neither was fitted on, and combined.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import bounded_batches, written
from opslake.llm.op5_language import logistic

#: Labelled documents for the fit, as expected number; rounds; pseudo-labelled ones of each class and view that a round's fit adds, as expected number
#: over rows (copies of one text count once); margin from which a view is sure.
LABELLED, ROUNDS, HANDED, SURE = 4000, 4, 100, 2.0
HASHED = 256
META = 128


def text_view(text: str | None) -> np.ndarray:
    """Shares of characters, words and lines of the whole text, and hashed character bigrams."""
    out = np.zeros(16 + HASHED, np.float32)
    if not text:
        out[0] = 1
        return out
    raw = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)
    kind = _KIND[np.minimum(raw, 255)]
    shares = np.bincount(kind, minlength=6) / len(raw)
    words = text.split()
    lines = text.split("\n")
    n = max(len(words), 1)
    out[1:7] = shares
    out[7] = min(len(text) / n, 40) / 10
    out[8] = len(set(words)) / n
    out[9] = len(set(lines)) / len(lines)
    out[10] = n / len(lines) / 50
    out[11] = np.log1p(len(raw)) / 12
    out[12] = sum(w.isupper() for w in words) / n
    out[13] = sum(not w[-1].isalnum() for w in words) / n
    out[14] = len({w[-3:] for w in words}) / n
    out[15] = np.log1p(n) / 10
    gram = ((raw[1:].astype(np.uint32) * np.uint32(2654435761)) ^ (raw[:-1].astype(np.uint32) * np.uint32(2246822519))) >> np.uint32(24)
    counts = np.bincount(gram % HASHED, minlength=HASHED).astype(np.float32)
    out[16:] = np.sqrt(counts / max(counts.sum(), 1))
    return out


_KIND = np.array([0 if chr(c).islower() else 1 if chr(c).isupper() else 2 if chr(c).isdigit() else 3 if chr(c).isspace() else 4 if chr(c) in ".,;:?'\"-" else 5 for c in range(256)], np.int64)


def meta_view(source: str | None, lang: str | None, chars: float | None) -> np.ndarray:
    """Hashed source and language, alone and together, and steps of the length. Null values are values of their own."""
    out = np.zeros(META, np.float32)
    length = -1 if chars is None or chars != chars else int(np.log2(max(chars, 0) + 1) * 2)
    for x in (f"s{source}", f"l{lang}", f"b{source}/{lang}", f"n{length}", f"m{lang}/{length // 2}"):
        out[zlib.crc32(x.encode()) % META] = 1
    return out


@dataclass
class Model:
    text: np.ndarray
    meta: np.ndarray
    calibration: np.ndarray  # of both margins, and the intercept
    prior: float

    def score(self, t: np.ndarray, m: np.ndarray) -> np.ndarray:
        margins = np.stack([t @ self.text[:-1] + self.text[-1], m @ self.meta[:-1] + self.meta[-1], np.ones(len(t))], 1)
        return 1 / (1 + np.exp(-np.clip(margins @ self.calibration, -30, 30)))


def _vectors(rows: DataFrame) -> DataFrame:
    """(k, y, t, m): both views of each row as half-precision numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = lambda v: v.astype(np.float16).tobytes()
        for b in batches:
            yield pd.DataFrame({"k": b["k"], "y": b["y"], "t": [pack(text_view(t)) for t in b["t"]], "m": [pack(meta_view(s, g, n)) for s, g, n in zip(b["s"], b["g"], b["n"], strict=True)]})

    return rows.mapInPandas(run, f"k {rows.schema['k'].dataType.simpleString()}, y double, t binary, m binary")


def _stack(column: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float16).reshape(len(column), width).astype(np.float32)


def handed_over(open_: DataFrame, text: np.ndarray, meta: np.ndarray, turn: int, gone: list[int], handed: int) -> pd.DataFrame:
    """(view, want, h, t, m): of all open documents those that a view ("t" or "m") is sure to be of class want (1 or -1), about `handed` rows each.

    They are drawn by a hash of the text's view, h, so copies come together and count once; hashes in gone were handed over before.
    """

    @F.pandas_udf("t double, m double")
    def margins(t: pd.Series, m: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"t": (_stack(t, len(text) - 1) @ text[:-1] + text[-1]).astype(float), "m": (_stack(m, len(meta) - 1) @ meta[:-1] + meta[-1]).astype(float)})

    kinds = [(v, w) for v in "tm" for w in (1, -1)]
    sure = lambda v, w: F.col(f"x.{v}") * w > SURE
    told = open_.where(~F.col("h").isin(gone) if gone else F.lit(True)).withColumn("x", margins("t", "m"))
    n = told.agg(*[F.count_if(sure(v, w)).alias(f"{v}{w}") for v, w in kinds]).first()
    draw = F.pmod(F.xxhash64(F.lit(turn), "h"), F.lit(1 << 30))
    chosen = [F.when(sure(v, w) & (draw < int(min(1.0, handed / max(n[f"{v}{w}"], 1)) * (1 << 30))), F.struct(F.lit(v).alias("view"), F.lit(w).alias("want"))) for v, w in kinds]
    rows = told.withColumn("c", F.explode(F.array_compact(F.array(*chosen)))).groupBy("c.view", "c.want", "h").agg(F.min("t").alias("t"), F.min("m").alias("m"))
    return rows.orderBy("view", "want", "h").toPandas()


def cotrain(docs: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = LABELLED, handed: int = HANDED) -> Model:
    """Fits on about so many labelled documents, chosen by a hash of the id, and on pseudo-labelled ones out of all others. docs: the columns of documents; labels: (doc_id, label).

    Without labels of both classes the model gives the share of good labels to every document, or a half.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    d = docs.select(F.col("doc_id").alias("k"), F.col("text").alias("t"), F.col("source").alias("s"), F.col("lang").alias("g"), F.col("n_chars").cast("double").alias("n"))
    y = labels.select(F.col("doc_id").alias("k"), F.col(label).cast("double").alias("y")).where("y is not null").groupBy("k").agg(F.max("y").alias("y"))
    part = F.pmod(F.xxhash64(F.lit("a"), "k"), F.lit(1 << 20)) < min(1.0, labelled / max(y.count(), 1)) * (1 << 20)
    # Where rows share keys, as many as that are too many: of those a part is drawn by key and text.
    rows = d.select("k").join(y.where(part), "k").count()
    share = F.pmod(F.xxhash64(F.lit("b"), "k", "t"), F.lit(1 << 20)) < min(1.0, 2 * labelled / max(rows, 1)) * (1 << 20)
    known = _vectors(d.join(y.where(part), "k").where(share).select("k", "y", "t", "s", "g", "n")).orderBy("k", "t", "m").toPandas()
    width = 16 + HASHED
    prior = float((known["y"].sum() + 1) / (len(known) + 2))
    if known["y"].nunique() < 2 or len(known) < 8:
        empty = np.array([0, 0, np.log(prior / (1 - prior))])
        return Model(np.zeros(width + 1), np.zeros(META + 1), empty, prior)
    held = np.array([zlib.crc32(str(k).encode()) % 4 == 0 for k in known["k"]])
    if not held.any() or held.all() or known["y"][~held].nunique() < 2 or known["y"][held].nunique() < 2:
        held = np.zeros(len(known), bool)
    views = [_stack(known["t"], width), _stack(known["m"], META)]
    sign = np.where(known["y"].to_numpy() > 0, 1.0, -1.0).astype(np.float32)
    own, rates, gone = [(v[~held], sign[~held]) for v in views], (2.0, 1.0), []
    open_ = _vectors(d.withColumn("y", F.lit(None).cast("double"))).drop("y").join(y.select("k"), "k", "left_anti")
    open_ = written(open_.select(F.xxhash64("t").alias("h"), "t", "m"), "open")
    for turn in range(ROUNDS):
        fitted = [logistic(x, s[:, None], 200, r)[:, 0] for (x, s), r in zip(own, rates, strict=True)]
        new = handed_over(open_, *fitted, turn, gone, handed)
        for k, view in enumerate("tm"):
            some = new[new["view"] == view]
            x, s = own[1 - k]
            own[1 - k] = np.vstack([x, _stack(some["tm"[1 - k]], x.shape[1])]), np.concatenate([s, some["want"].to_numpy(np.float32)])
        gone += [int(h) for h in new["h"].unique()]
    fitted = [logistic(x, s[:, None], 300, r)[:, 0] for (x, s), r in zip(own, rates, strict=True)]
    use = held if held.any() else np.ones(len(known), bool)
    margins = np.stack([v[use] @ f[:-1] + f[-1] for v, f in zip(views, fitted, strict=True)], 1).astype(np.float32)
    scale = np.maximum(np.abs(margins).mean(0), 1e-6)
    calibration = logistic(margins / scale, sign[use][:, None], 400, 0.5, 1e-3)[:, 0]
    return Model(fitted[0], fitted[1], np.append(calibration[:2] / scale, calibration[2]), prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, text_margin, meta_margin) for each row: the chance of good quality and what each view says.

    Null and empty texts and null metadata are values like any other. Extra columns are ignored.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            t = np.stack([text_view(x) for x in b["t"]])
            m = np.stack([meta_view(s, g, n) for s, g, n in zip(b["s"], b["g"], b["n"], strict=True)])
            yield pd.DataFrame({"k": b["k"], "score": model.score(t, m), "text_margin": (t @ model.text[:-1] + model.text[-1]).astype(float), "meta_margin": (m @ model.meta[:-1] + model.meta[-1]).astype(float)})

    d = docs.select(F.col("doc_id").alias("k"), F.col("text").alias("t"), F.col("source").alias("s"), F.col("lang").alias("g"), F.col("n_chars").cast("double").alias("n"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return d.mapInPandas(run, f"k {kind}, score double, text_margin double, meta_margin double").withColumnRenamed("k", "doc_id")
