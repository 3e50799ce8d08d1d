"""Byte-level BPE encoding and decoding by overlapping chunks.

Long texts are cut into chunks that overlap. Chunks are pre-tokenised in parallel, each from its own beginning, where its
boundaries may be wrong at first. Two neighbours are stitched at the first boundary on which they agree in their overlap:
what a match takes depends on the text from its beginning on alone, so from there on both are the same. Then the stitched pieces are
encoded, and a text's ids are those of its pieces in order. Ids decode to the bytes of their tokens, one after the other.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslake.llm.common import bounded_batches, bucketed, written
from opslake.llm.op10_bpe import NEWER, latin

#: Characters from one chunk's beginning to the next one's, and those that two neighbours share.
STRIDE, OVERLAP = 16_384, 512
#: Characters from a match's beginning, and one after its end, on which it may depend at most: the longest fixed alternative of the pattern has three.
LOOK = 3
#: Pieces whose ids one Python worker keeps; bytes from which on a piece is long, and isn't kept.
KEPT, LONG = 500_000, 200
NONE = 1 << 40

Finish = Callable[[list[np.ndarray]], dict]


class ByteBpe:
    """A byte-level BPE from a rank file: of all neighbours that together are a token, the first ones of the lowest rank merge."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        white = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        newer = "[" + "".join("-".join(f"\\U{x:0>8}" for x in r.split("-")) for r in NEWER.split()) + "]"
        self.words, self.newer = regex.compile(white), regex.compile(newer)
        # Letters and digits that are newer than the library's Unicode tables are neither.
        older = white.replace(r"\p{L}", rf"[\p{{L}}--{newer}]").replace(r"\p{N}", rf"[\p{{N}}--{newer}]")
        self.rare_words = regex.compile(older, regex.V1)
        self.kept: dict[str, bytes] = {}
        #: Ids take two bytes while they are shuffled, if the vocabulary lets them.
        self.kind = "<u2" if max(self.ranks.values()) < 1 << 16 else "<u4"

    def rule(self, text: str) -> regex.Pattern:
        return self.words if latin(text) or not self.newer.search(text) else self.rare_words

    def pieces(self, text: str) -> list[str]:
        return self.rule(text).findall(text)

    def ends(self, text: str, at: int = 0) -> Iterator[int]:
        """Where the matches end that follow each other from a place on."""
        return (m.end() for m in self.rule(text).finditer(text, at))

    def merge(self, raw: bytes) -> list[int]:
        """Ids of one piece."""
        if raw in self.ranks:
            return [self.ranks[raw]]
        if len(raw) >= LONG:
            return self.merge_long(raw)
        get, parts = self.ranks.get, [raw[k : k + 1] for k in range(len(raw))]
        rank = [get(raw[k : k + 2], NONE) for k in range(len(raw) - 1)]
        while rank and (least := min(rank)) < NONE:
            k = rank.index(least)
            parts[k] += parts.pop(k + 1)
            del rank[k]
            if k:
                rank[k - 1] = get(parts[k - 1] + parts[k], NONE)
            if k < len(rank):
                rank[k] = get(parts[k] + parts[k + 1], NONE)
        return [self.ranks[x] for x in parts]

    def merge_long(self, raw: bytes) -> list[int]:
        """Ids of a long piece. Parts are known by their beginnings, and a queue has the ranks; pairs that no longer stand are passed over."""
        ranks, n = self.ranks, len(raw)
        end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\1") * n
        queue = [(ranks[pair], k, k + 2) for k in range(n - 1) if (pair := raw[k : k + 2]) in ranks]
        heapq.heapify(queue)
        while queue:
            _, at, to = heapq.heappop(queue)
            middle = end[at]
            if not alive[at] or middle == n or end[middle] != to:
                continue
            end[at], alive[middle] = to, 0
            if to < n:
                before[to] = at
                if (pair := raw[at : end[to]]) in ranks:
                    heapq.heappush(queue, (ranks[pair], at, end[to]))
            if (left := before[at]) >= 0 and (pair := raw[left:to]) in ranks:
                heapq.heappush(queue, (ranks[pair], left, to))
        out, at = [], 0
        while at < n:
            out.append(ranks[raw[at : end[at]]])
            at = end[at]
        return out

    def encode_pieces(self, pieces: list[str]) -> bytes:
        """Ids of pieces as little-endian integers of the vocabulary's width."""
        if len(self.kept) > KEPT:
            self.kept.clear()
        kept = self.kept
        try:
            return b"".join(map(kept.__getitem__, pieces))
        except KeyError:
            long = {}
            for p in set(pieces):
                if p not in kept:
                    (kept if len(p) < LONG else long)[p] = np.array(self.merge(p.encode("utf-8", "surrogatepass")), self.kind).tobytes()
            return b"".join([kept[p] if p in kept else long[p] for p in pieces])

    def ids(self, raw: bytes) -> np.ndarray:
        """Ids from their bytes."""
        return np.frombuffer(raw, self.kind).astype("<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def chunk_count(length: int) -> int:
    return max(1, -(-(length - OVERLAP) // STRIDE))


def boundaries(t: ByteBpe, chunk: str, last: bool) -> list[int]:
    """Ends of a chunk's matches that what follows the chunk can't change."""
    room = len(chunk) - (0 if last else LOOK)
    return [e for e in t.ends(chunk) if e <= room]


#: A blank after another character is a boundary in any scan, wherever it began: no match has a blank behind its first place, unless it has nothing else.
SURE = regex.compile(r"\P{White_Space}\p{White_Space}")


def stitched(chunks: DataFrame) -> DataFrame:
    """(row, chunk, seg, begin, stop, n): segments of neighbouring chunks, from their first true boundary to the next segment's.

    A chunk begins a segment where it agrees with the one before, whose boundaries have to be true there: back to the last chunk that has a sure
    boundary (or is the first one) all have to agree. Chunks that don't agree, as inside a word longer than the overlap,
    belong to the segment before and are scanned anew as one with it.
    """
    place = lambda ends: F.transform(ends, lambda e: e + F.col("start"))
    head = F.array_union(F.array("start"), place(F.filter("ends", lambda e: e <= OVERLAP)))
    tail = place(F.filter("ends", lambda e: e >= STRIDE))
    w = Window.partitionBy("row").orderBy("chunk")
    m = chunks.select("row", "chunk", "sure", head.alias("head"), tail.alias("tail"))
    agreed = F.array_min(F.array_intersect("head", F.lag("tail").over(w)))
    m = m.withColumn("sync", F.when(F.col("chunk") == 0, F.lit(0).cast("long")).otherwise(agreed)).drop("head", "tail")
    true_from = F.max(F.when(F.col("sure") | (F.col("chunk") == 0), F.col("chunk"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    torn = F.max(F.when(F.col("sync").isNull(), F.col("chunk"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    begins = F.col("sync").isNotNull() & ((F.col("chunk") == 0) | F.coalesce(F.col("torn") <= F.col("true_from"), F.lit(True)))
    m = m.withColumn("true_from", true_from).withColumn("torn", torn).withColumn("at", F.when(begins, F.col("sync")))
    m = m.withColumn("seg", F.count("at").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    m = m.withColumn("stop", F.first("at", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)))
    whole = Window.partitionBy("row", "seg")
    return m.select("row", "chunk", "seg", F.max("at").over(whole).alias("begin"), "stop", F.count("*").over(whole).alias("n"))


def encoded(docs: DataFrame, path: str, pattern: str, text: str, key: str, schema: str, finish: Finish) -> DataFrame:
    """(key, columns of schema) for each row: what finish makes of lists of ids.

    Texts of one chunk are encoded where they are read; only longer ones are written as chunks and shuffled.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    names = [c.split()[0] for c in schema.split(", ")]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer(path, pattern)
        for b in batches:
            texts = b["t"].fillna("").tolist()
            count = np.array([chunk_count(len(x)) for x in texts], np.int64)
            one = np.flatnonzero(count == 1)
            ids = [t.ids(t.encode_pieces(t.pieces(texts[k]))) for k in one]
            yield pd.DataFrame({"k": b["k"].iloc[one], "row": b["row"].iloc[one], "chunk": None, "last": None, "start": None, "piece": None} | {c: list(v) for c, v in finish(ids).items()})
            for k in np.flatnonzero(count > 1):
                starts = np.arange(count[k]) * STRIDE
                # Batches of chunks are bounded as those of texts are.
                for some in np.split(starts, range(256, len(starts), 256)):
                    parts = [texts[k][s : s + STRIDE + OVERLAP] for s in some.tolist()]
                    chunk = some // STRIDE
                    yield pd.DataFrame({"k": b["k"].iloc[k], "row": b["row"].iloc[k], "chunk": chunk, "last": chunk == count[k] - 1, "start": some, "piece": parts} | dict.fromkeys(names))

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer(path, pattern)
        for b in batches:
            ends = [boundaries(t, x, last) for x, last in zip(b["piece"], b["last"], strict=True)]
            yield b.assign(ends=ends, sure=[SURE.search(x, 0, STRIDE) is not None for x in b["piece"]])

    def single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer(path, pattern)
        for b in batches:
            out = []
            for x, ends, start, begin, stop in zip(b["piece"], b["ends"], b["start"], b["begin"], b["stop"], strict=True):
                ends = np.asarray(ends, np.int64)
                ends = ends[(ends > begin - start) & (ends <= (len(x) if pd.isna(stop) else stop - start))].tolist()
                out.append(t.encode_pieces([x[a:e] for a, e in zip([int(begin - start), *ends], ends, strict=False)]))
            yield b[["k", "row", "seg"]].assign(ids=out)

    def several(b: pd.DataFrame) -> pd.DataFrame:
        t, b = tokenizer(path, pattern), b.sort_values("chunk")
        first = b.iloc[0]
        x = "".join([p[:STRIDE] for p in b["piece"].iloc[:-1]]) + b["piece"].iloc[-1]
        at, stop = int(first["begin"] - first["start"]), len(x) if pd.isna(first["stop"]) else int(first["stop"] - first["start"])
        pieces = []
        for e in t.ends(x, at):
            if e > stop:
                break
            pieces.append(x[at:e])
            at = e
        return pd.DataFrame({"k": b["k"].iloc[:1], "row": b["row"].iloc[:1], "seg": b["seg"].iloc[:1], "ids": [t.encode_pieces(pieces)]})

    def joined(b: pd.DataFrame) -> pd.DataFrame:
        ids = tokenizer(path, pattern).ids(b"".join(b.sort_values("seg")["ids"]))
        return pd.DataFrame({"k": b["k"].iloc[:1]} | {c: list(v) for c, v in finish([ids]).items()})

    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.monotonically_increasing_id().alias("row"))
    chunk_of = f"k {kind}, row long, chunk long, last boolean, start long, piece string"
    read = written(source.select("k", "t", "row").mapInPandas(cut, f"{chunk_of}, {schema}"), "texts")
    done = read.where("chunk is null").select("k", *names)
    long = read.where("chunk is not null").select("k", "row", "chunk", "last", "start", "piece")
    if long.limit(1).count():
        # Chunks are dealt out once: their table is bucketed as the scan left them, and only the segments come to it.
        dealt = long.withColumn("id", F.concat_ws("/", "row", "chunk")).repartition(int(long.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")
        chunks = bucketed(dealt.mapInPandas(scanned, f"{chunk_of}, id string, ends array<int>, sure boolean"), "chunks", "id", compression="zstd", placed=True)
        segments = stitched(chunks).select(F.concat_ws("/", "row", "chunk").alias("id"), "seg", "begin", "stop", "n")
        rows = chunks.join(segments, "id")
        segment = f"k {kind}, row long, seg long, ids binary"
        alone = rows.where("n = 1").select("k", "row", "seg", "start", "piece", "ends", "begin", "stop").mapInPandas(single, segment)
        merged = rows.where("n > 1").select("k", "row", "seg", "chunk", "start", "piece", "begin", "stop").groupBy("row", "seg").applyInPandas(several, segment)
        done = done.unionByName(alone.unionByName(merged).groupBy("row").applyInPandas(joined, f"k {kind}, {schema}"))
    return done.withColumnRenamed("k", key)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids array<int>) for each row; null and empty texts have no ids, repeated rows and null keys keep a row each.

    path: the rank file, on every machine. pattern: the pre-tokenisation, which has to match every text without gaps, with blanks
    at a match's beginning or alone. Only key and text are read, whatever other columns there are; an empty table gives no rows.
    """
    return encoded(docs, path, pattern, text, key, "ids array<int>", lambda ids: {"ids": [x.astype(np.int32) for x in ids]})


def decode(ids: DataFrame, path: str, pattern: str, column: str = "ids", key: str = "doc_id") -> DataFrame:
    """(key, decoded binary) for each row: the bytes of all tokens, which need not be whole characters; none for null ids."""
    bounded_batches(ids.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer(path, pattern)
        for b in batches:
            yield pd.DataFrame({"k": b["k"], "decoded": [t.decode(np.asarray(x)) if x is not None else b"" for x in b["i"]]})

    kind = ids.schema[key].dataType.simpleString()
    return ids.select(F.col(key).alias("k"), F.col(column).alias("i")).mapInPandas(run, f"k {kind}, decoded binary").withColumnRenamed("k", key)


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encodes each text, decodes the ids, and digests both where they are made."""

    def finish(ids: list[np.ndarray]) -> dict:
        t = tokenizer(path, pattern)
        return {
            "n_tokens": [len(x) for x in ids], "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(t.decode(x)).hexdigest() for x in ids],
        }

    return encoded(docs, path, pattern, text, key, "n_tokens long, ids_sha256 string, decoded_sha256 string", finish)
