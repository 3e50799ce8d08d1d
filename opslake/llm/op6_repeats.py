"""Exact substring dedup by prefix-free parsing.

A rolling hash over the bytes places triggers that cut each document into phrases; neighbouring phrases overlap by
one byte less than the match length, so each window of that length lies in one phrase. The dictionary of distinct
phrases is put in order, with the documents of each; a phrase seen in an earlier document is removed whole, and the parse
carries this back to the documents. What is left are the windows of phrases that are new where they stand. Their suffixes are
sampled (in each window the position whose 24 bytes hash lowest) and put in order, by a hash of their beginnings, so that
equal ones are neighbours; neighbours are compared by their contexts, of contexts that differ the 44 bytes that neighbouring
windows share are compared first, then windows one by one, each time in order. Of a beginning that very many documents share
the order is read as a stream: no task holds more than one document's rows of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import bounded_batches, bucketed, many_rows, written

WINDOW = 50
#: Mean distance of triggers, bytes of the rolling hash and of the beginning of a sampled suffix, places of such a beginning in a window.
EVERY, GRAM = 192, 24
STARTS = WINDOW - GRAM + 1
#: Windows around a sampled suffix that are compared together at first, and the bytes that these share.
TOGETHER = 7
SHARED = WINDOW - TOGETHER + 1
#: Window starts that are handled at once; a sampled position has to fit 20 bits. Rows that a task hands on at once.
RUN, ROWS = 1 << 19, 1 << 18
#: Rows of an Arrow batch where suffixes are in order.
ORDERED = 50_000

_P = np.uint64(0x9FB21C651E98DF25)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_BYTES = np.random.default_rng(6).integers(0, 1 << 64, 256, np.uint64)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def words8(b: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number."""
    x = b.astype(np.uint64)
    for n in (1, 2, 4):
        x = x[:-n] | (x[n:] << np.uint64(8 * n))
    return x


def gram_hashes(w: np.ndarray) -> np.ndarray:
    """A hash of the 24 bytes from each position on."""
    x = w[16:] * _A
    x ^= x >> np.uint64(32)
    x += w[8:-8]
    x *= _C
    x ^= x >> np.uint64(31)
    x += w[:-16]
    x *= _B
    x ^= x >> np.uint64(29)
    x *= _C
    x ^= x >> np.uint64(32)
    return x


def phrases(b: np.ndarray) -> np.ndarray:
    """Starts of the phrases of a document, and the end of its window starts; empty if it holds no window."""
    n = len(b) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = gram_hashes(words8(b))[:n]
    cut = np.flatnonzero(h % np.uint64(EVERY) == 0)
    return np.unique(np.concatenate(([0], cut, [n])))


def sampled(b: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the windows that start in [low, high): keys and places of sampled suffixes, and the first and last window of each."""
    out = []
    for lo in range(low, high, RUN):
        hi = min(lo + RUN, high)
        h = gram_hashes(words8(b[lo : hi - 1 + WINDOW]))
        v = ((h >> np.uint64(20)) << np.uint64(20)) | np.arange(len(h), dtype=np.uint64)
        m = v
        for step in (1, 2, 4, 8):
            m = np.minimum(m[:-step], m[step:])
        m = np.minimum(m[: -(STARTS - 16)], m[STARTS - 16 :])
        first = np.flatnonzero(np.append(True, m[1:] != m[:-1]))
        at = (m[first] & np.uint64((1 << 20) - 1)).astype(np.int64)
        last = np.append(first[1:], len(m)) - 1
        out.append(((h[at] * _A >> np.uint64(16)).astype(np.int64), at + lo, first + lo, last + lo))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def window_hashes(w: np.ndarray, starts: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """A hash of the bytes from each start on, as many as a window has or `size`."""
    x = np.full(len(starts), _C)
    for o in (*range(0, size - 8, 8), size - 8):
        x = (x ^ w[starts + o]) * _A
        x ^= x >> np.uint64(31)
        x *= _B
    return (x ^ (x >> np.uint64(29))).astype(np.int64)


def stretch_hashes(b: np.ndarray, start: np.ndarray, end: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """A hash of the bytes in each [start, end), of at most a few hundred bytes, and of a mark: differences of the running sums of bytes times powers."""
    n = len(b)
    power, inverse = (np.cumprod(np.append(np.uint64(1), np.full(n, x))) for x in (_P, _P_INVERSE))
    sums = np.append(np.uint64(0), np.cumsum(_BYTES[b] * power[:n], dtype=np.uint64))
    x = (sums[end] - sums[start]) * inverse[start]
    x = (x ^ (mark.astype(np.uint64) + ((end - start).astype(np.uint64) << np.uint64(20)))) * _A
    x ^= x >> np.uint64(31)
    return (x * _B).astype(np.int64)


def packed_place(at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return (at << 16) | ((at - first) << 8) | (last - at + STARTS)


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = place >> 16
    return at, at - ((place >> 8) & 255), at + (place & 255) - STARTS


def spans_union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, with those that touch or overlap joined."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def ordered(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by the first key and sorted by all."""
    return rows.repartition(keys[0]).sortWithinPartitions(*keys)


def columns_of(batches: Iterator[pd.DataFrame], names: list[str]) -> Iterator[list[np.ndarray]]:
    for b in batches:
        if len(b):
            yield [b[c].to_numpy() for c in names]


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where rows begin that differ in one of the columns from the row before."""
    return np.flatnonzero(np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])))


def several(rows: DataFrame, *payload: str) -> DataFrame:
    """(id, k, payload) of rows (k, id, payload) whose beginning k several documents have. Of a beginning at most one document's rows are held."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, key, seen, held = ["k", "id", *payload], None, False, None
        for b in columns_of(batches, names):
            if held is not None:
                b = [np.concatenate(x) for x in zip(held, b, strict=True)]
            k, i = b[:2]
            start = changes(k)
            more = np.logical_or.reduceat(i != np.repeat(i[start], np.diff(np.append(start, len(k)))), start)
            more[0] |= seen and k[0] == key
            keep = np.repeat(more, np.diff(np.append(start, len(k))))
            yield pd.DataFrame({c: x[keep] for c, x in zip(names, b, strict=True)})[["id", "k", *payload]]
            key, seen = k[-1], bool(more[-1])
            held = None if seen else [x[start[-1] :] for x in b]

    return ordered(rows, "k").mapInPandas(run, "id long, k long, " + ", ".join(f"{c} long" for c in payload))


def told(rows: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """(id, payload, later) of rows (keys, id, payload): whether a document with a smaller id has the same keys."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, first = None, 0
        for b in columns_of(batches, [*keys, "id", *payload]):
            k, i = b[: len(keys)], b[len(keys)]
            start = changes(*k)
            least = i[start]
            if last == [x[0] for x in k]:
                least[0] = first
            last, first = [x[-1] for x in k], least[-1]
            yield pd.DataFrame(dict(zip(["id", *payload], b[len(keys) :], strict=True)) | {"later": i != np.repeat(least, np.diff(np.append(start, len(i))))})

    return ordered(rows, *keys, "id").mapInPandas(run, "id long, " + "".join(f"{c} long, " for c in payload) + "later boolean")


def judged(rows: DataFrame) -> DataFrame:
    """(id, k, place, met) of rows (k, x, id, place): met where an earlier document has the beginning k in the same context x.

    Of the others only those of a beginning with several contexts; of a beginning at most one document's rows are held.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, first, more, held = (None, None), 0, False, None
        for b in columns_of(batches, ["k", "x", "id", "place"]):
            if held is not None:
                b = [np.concatenate(y) for y in zip(held, b, strict=True)]
            k, x, i, place = b
            start, of_k = changes(k, x), changes(k)
            least = i[start]
            if last == (k[0], x[0]):
                least[0] = first
            met = i != np.repeat(least, np.diff(np.append(start, len(k))))
            contexts = np.diff(np.append(np.searchsorted(start, of_k), len(start))) > 1
            contexts[0] |= more and k[0] == last[0]
            keep = met | np.repeat(contexts, np.diff(np.append(of_k, len(k))))
            yield pd.DataFrame({"id": i[keep], "k": k[keep], "place": place[keep], "met": met[keep]})
            last, first, more = (k[-1], x[-1]), least[-1], bool(contexts[-1])
            rest = np.flatnonzero(~met[of_k[-1] :]) + of_k[-1]
            held = None if more else [y[rest] for y in b]

    return ordered(rows, "k", "x", "id").mapInPandas(run, "id long, k long, place long, met boolean")


class Texts:
    """Packed bytes of the documents, bucketed by id, so that every visit moves the requests and not the texts."""

    def __init__(self, docs: DataFrame, key: str, text: str):
        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            z = zstandard.ZstdCompressor(level=3)
            for b in batches:
                yield pd.DataFrame({"id": b["id"], "z": [z.compress((t or "").encode("utf-8", "surrogatepass")) for t in b["t"]]})

        self.table = bucketed(docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t")).mapInPandas(pack, "id long, z binary"), "texts", "id")

    def visit(self, requests: DataFrame, run, schema: str, how: str = "inner") -> DataFrame:
        """run(id, bytes, one array for each column of the requests) -> arrays or lists, the columns of the rows; over the texts with their requests."""
        names, asked = [c.split()[0] for c in schema.split(", ")], [c for c in requests.columns if c != "id"]

        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            z, none = zstandard.ZstdDecompressor(), np.zeros(0, np.int64)
            for b in batches:
                out, n = [], 0
                for i, x, *q in zip(b["id"], b["z"], *(b[c] for c in asked), strict=True):
                    out.append(run(i, z.decompress(x), *(none if v is None else v for v in q)))
                    n += len(out[-1][0])
                    if n >= ROWS:
                        yield frame(names, out)
                        out, n = [], 0
                if out:
                    yield frame(names, out)

        return self.table.join(requests, "id", how).select("id", "z", *asked).mapInPandas(each, schema)


def frame(names: list[str], parts: list[tuple]) -> pd.DataFrame:
    """The parts' columns one below the other."""
    join = lambda x: np.concatenate(x) if isinstance(x[0], np.ndarray) else [v for y in x for v in y]
    return pd.DataFrame({c: join(x) for c, x in zip(names, zip(*parts, strict=True), strict=True)})


def requests(rows: DataFrame, *columns: str) -> DataFrame:
    """(id, one array for each column): the rows of each document; at most a few for each of its bytes."""
    return rows.groupBy("id").agg(F.collect_list(F.struct(*columns)).alias("q")).select("id", *(F.col(f"q.{c}").alias(c) for c in columns))


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept binary): each text without the bytes that 50-byte strings of earlier documents cover.

    A string counts as earlier when it also starts in a document with a smaller key. Texts are UTF-8 bytes, null is empty;
    matches don't cross documents, and overlapping ones count. Texts under 50 bytes keep all. The key is an integer and
    names one text; each row of a repeated key is handled alike, and rows with a null key are dropped from the comparison
    and kept whole.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    # Rows without a key take no part: they aren't packed, where they all would share a bucket.
    none, alone = F.lit(0).cast("long"), docs.where(F.col(key).isNull()).select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias("t"))
    alone = alone.select(key, F.octet_length("t").cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), F.col("t").cast("binary").alias("kept"))
    docs = docs.where(F.col(key).isNotNull())
    texts = Texts(docs, key, text)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, t in zip(b["id"], b["t"], strict=True):
                raw = (t or "").encode("utf-8", "surrogatepass")
                cut = phrases(np.frombuffer(raw, np.uint8)).tolist()
                out += [(i, s, e - s, *_signed(xxhash.xxh3_128_intdigest(raw[s : e + WINDOW - 1]))) for s, e in zip(cut, cut[1:])]
            yield pd.DataFrame(out, columns=["id", "start", "size", "h1", "h2"])

    parsed = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t")).mapInPandas(parse, "id long, start long, size long, h1 long, h2 long")

    def suffixes(i: int, raw: bytes, start: np.ndarray, size: np.ndarray, old: np.ndarray) -> tuple:
        b, new = np.frombuffer(raw, np.uint8), ~old.astype(bool)
        spans = spans_union(list(zip(start[new].tolist(), (start[new] + size[new]).tolist(), strict=True)))
        got = [sampled(b, lo, hi) for lo, hi in spans] or [(np.zeros(0, np.int64),) * 4]
        k, at, first, last = (np.concatenate(x) for x in zip(*got, strict=True))
        return k, np.full(len(k), i), packed_place(at, first, last)

    def contexts(i: int, raw: bytes, k: np.ndarray, place: np.ndarray) -> tuple:
        at, first, last = unpacked(place)
        return k, stretch_hashes(np.frombuffer(raw, np.uint8), first, last + WINDOW, at - first), np.full(len(k), i), place

    def bands(i: int, raw: bytes, k: np.ndarray, place: np.ndarray) -> tuple:
        w = words8(np.frombuffer(raw, np.uint8))
        at, first, last = unpacked(place)
        out = []
        for o in range(0, STARTS, TOGETHER):
            low, high = np.maximum(first, at - o - TOGETHER + 1), np.minimum(last, at - o)
            some = low <= high
            x = k[some] + (window_hashes(w, at[some] - o, SHARED) ^ (o << 40))
            out.append((x, low[some], high[some]))
        x, low, high = (np.concatenate(c) for c in zip(*out, strict=True))
        return x, np.full(len(x), i), low, high

    def windows(i: int, raw: bytes, k: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
        n = high - low + 1
        starts = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(k, n), window_hashes(words8(np.frombuffer(raw, np.uint8)), starts), np.full(len(starts), i), starts

    with many_rows(spark, ORDERED):
        # The dictionary in order: a phrase that an earlier document has is old, and the parse carries this to its places.
        verdict = written(requests(told(parsed, ["h1", "h2"], ["start", "size"]), "start", "size", "later"), "verdict")
        suffix = texts.visit(verdict, suffixes, "k long, id long, place long")
        asked = written(requests(several(suffix, "place"), "k", "place"), "repeated")
        seen = written(judged(texts.visit(asked, contexts, "k long, x long, id long, place long")), "contexts")
        band = texts.visit(requests(seen.where("not met"), "k", "place"), bands, "k long, id long, low long, high long")
        close = written(requests(several(band, "low", "high"), "k", "low", "high"), "close")
        window = texts.visit(close, windows, "k long, x long, id long, start long")
        single = written(told(window, ["k", "x"], ["start"]).where("later").select("id", F.col("start").alias("a"), (F.col("start") + WINDOW).alias("b")), "windows")
    whole = verdict.select("id", F.explode(F.arrays_zip("start", "size", "later")).alias("p")).where("p.later").select("id", F.col("p.start").alias("a"), (F.col("p.start") + F.col("p.size") + WINDOW - 1).alias("b"))
    met = seen.where("met").select("id", (F.shiftright("place", 16) - F.shiftright("place", 8).bitwiseAND(255)).alias("a"), (F.shiftright("place", 16) + F.col("place").bitwiseAND(255) - STARTS + WINDOW).alias("b"))
    spans = written(requests(whole.union(met).union(single), "a", "b"), "spans")

    def rest(i: int, raw: bytes, a: np.ndarray, b: np.ndarray) -> tuple:
        cut = spans_union(list(zip(a.tolist(), b.tolist(), strict=True)))
        edges = [0, *(x for span in cut for x in span), len(raw)]
        kept = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
        return [i], [len(raw)], [sum(y - x for x, y in cut)], [len(cut)], [kept]

    return texts.visit(spans, rest, "id long, n_bytes long, n_removed long, n_spans long, kept binary", "left").withColumnRenamed("id", key).unionByName(alone)


def _signed(h: int) -> tuple[int, int]:
    """Two signed 64-bit halves of a 128-bit number."""
    a, b = h >> 64, h & ((1 << 64) - 1)
    return a - (1 << 64) * (a >> 63), b - (1 << 64) * (b >> 63)


def digest(rows: DataFrame) -> DataFrame:
    """The rows of removed() with the sum of what is kept instead of the bytes."""
    return rows.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
