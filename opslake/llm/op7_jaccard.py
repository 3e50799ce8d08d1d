"""N-gram Jaccard join in the metric space of shingle sets.

The Jaccard distance is a metric, and linked documents lie within a radius of 0.2.

First a screen, since nearly all documents of a corpus are at distance 1 from all others: one that links has at most a fifth
of its shingles to itself, so those with more of them among the hashes of the lowest three tenths are done. The limit is one
hash for all sizes, so a shingle that two documents share is seen in both.

The pivots of the first division are the shared shingles, taken as sets of one. A document lies as near to each of its own
shingles and at distance 1 from the others; the tie is broken by one order for all, rare shingles first, and so each document
has its Voronoi region. Windows copy a document to the regions of its further shingles as long as a document within the
radius may have its first common shingle there: from place i on at most n - i shingles can be shared. For two documents of
equal size that is a ninth of each.

Each region has a pivot document, the one whose rarer shingles are fewest: of edited copies it is the one they were made from.
All members are compared with it, and regions whose members are then in one component are done. In the others documents
outside the largest component become pivots, meet all members that may link, and leave; what remains goes to the Voronoi
region of the nearest of a few of these pivots and, as the triangle inequality asks, to each whose pivot is at most twice the
radius farther. That is repeated until every region is done, with four times as many pivots in each round. Before each
round members leave that no member of another component can reach by its size and the place of the shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import BROADCAST_IDS, bounded_batches, labelled, merged, written

WORDS, PERCENT = 5, 80
RADIUS = 1 - PERCENT / 100
#: Pivots of a region in the first round, and those of them whose Voronoi regions divide it. Size classes for a factor of e.
PIVOTS, DIVIDING, CLASSES = 16, 4, 50
#: The screen sees the shingles below this hash, about three tenths of each set.
SEEN = np.uint64((1 << 64) * 3 // 10)

_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingles(text: str | None, k: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of the whole text; one for all words if there are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
    s = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        x = (h[j : len(h) - k + 1 + j] + np.uint64(j + 1)) * _MUL[j % 5]
        s = (s ^ x ^ (x >> np.uint64(31))) * _MUL[(j + 1) % 5]
    s ^= s >> np.uint64(32)
    s.sort()
    return s[np.append(True, s[1:] != s[:-1])]


def prints(s: np.ndarray) -> tuple[np.int64, np.int64]:
    """128 bits that name a set of shingles."""
    mixed = (s ^ (s >> np.uint64(29))) * _MUL[1]
    return np.bitwise_xor.reduce(mixed).astype(np.int64), np.add.reduce(mixed ^ (mixed >> np.uint64(32)), dtype=np.uint64).astype(np.int64)


def screened(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, n, c1, c2, firsts): size and name of each document's set, and of its shingles below SEEN those that no other document of the batch has.

    Each batch adds a row of size -1 without id, with the shingles that several of its documents have: a shingle of very
    many documents is sent on once for each batch.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [shingles(t) for t in b["t"]]
            sizes = np.array([len(s) for s in sets], np.int64)
            ahead = np.array([np.searchsorted(s, SEEN) for s in sets], np.int64)
            every = np.concatenate([s[:k] for s, k in zip(sets, ahead, strict=True)]) if len(sets) else np.zeros(0, np.uint64)
            tok, at, n = np.unique(every, return_index=True, return_counts=True)
            own = np.zeros(len(every), bool)
            own[at[n == 1]] = True
            ends = np.cumsum(ahead)
            firsts = [every[e - k : e][own[e - k : e]].astype(np.int64) for e, k in zip(ends, ahead, strict=True)]
            c1, c2 = zip(*map(prints, sets)) if sets else ((), ())
            yield pd.DataFrame({"id": [*b["id"], None], "n": [*sizes, -1], "c1": [*c1, 0], "c2": [*c2, 0], "firsts": [*firsts, tok[n > 1].astype(np.int64)]}).astype({"id": "Int64"})

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t")).mapInPandas(run, "id long, n long, c1 long, c2 long, firsts array<long>")


def candidates(screen: DataFrame, reps: DataFrame) -> DataFrame:
    """(id): representatives of which few enough shingles are seen to be theirs alone."""
    each = screen.select("id", F.explode("firsts").alias("tok")).groupBy("tok").agg(F.count("*").alias("c"), F.min("id").alias("id"))
    alone = each.where("c = 1 and id is not null").groupBy("id").agg(F.count("*").alias("alone"))
    return reps.select(F.col("rep").alias("id"), "n").join(alone, "id", "left").where((100 - PERCENT) * F.col("n") >= 100 * F.coalesce("alone", F.lit(0))).select("id")


def sets_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, n, s): size and sorted shingles of each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [shingles(t).astype(np.int64) for t in b["t"]]
            yield pd.DataFrame({"id": b["id"], "n": np.array([len(s) for s in sets], np.int64), "s": sets})

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t")).mapInPandas(run, "id long, n long, s array<long>")


def regions_of(sets: DataFrame) -> DataFrame:
    """(region, node, n, i): each document in the regions of its first shared shingles, rare ones first, as far as the windows reach.

    i is the shingle's place in the document; the shingles that no other document has come before all shared ones.
    """
    tokens = sets.select("id", "n", F.explode("s").alias("tok"))
    shared = written(tokens.groupBy("tok").agg(F.count("*").alias("df")).where("df > 1"), "shared")
    # At most as many entries as the document has shingles.
    own = tokens.join(shared, "tok").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("t"))
    own = own.withColumn("before", F.col("n") - F.size("t")).withColumn("reach", F.floor((100 - PERCENT) * F.col("n") / 100) - F.col("before") + 1).where("reach > 0")
    placed = own.select("id", "n", "before", F.posexplode(F.slice("t", 1, F.col("reach").cast("int"))).alias("at", "t"))
    return placed.select(F.col("t.tok").alias("region"), F.col("id").alias("node"), "n", (F.col("before") + F.col("at")).alias("i"))


def may_link(n1: Column, i1: Column, n2: Column, i2: Column) -> Column:
    """Whether two documents whose first common shingle has the places i1 and i2 can share enough."""
    return (100 + PERCENT) * F.least(n1 - i1, n2 - i2) >= PERCENT * (n1 + n2)


def compared(sets: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """(a, b, d, linked): the distance of each pair (a, b) of documents, and whether they link."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in batches:
            both = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(g["sa"], g["sb"], strict=True)], np.int64)
            either = g["sa"].map(len).to_numpy(np.int64) + g["sb"].map(len).to_numpy(np.int64) - both
            yield pd.DataFrame({"a": g["a"], "b": g["b"], "d": 1 - both / either, "linked": 100 * both >= PERCENT * either})

    asked = sets.join(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "id", "left_semi")
    side = lambda x: asked.select(F.col("id").alias(x), F.col("s").alias(f"s{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b")
    return written(rows.select("a", "b", "sa", "sb").mapInPandas(run, "a long, b long, d double, linked boolean"), name)


def ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def partnered(rows: DataFrame, others: DataFrame) -> DataFrame:
    """The rows (region, node, n, i, component_id, ...) that may link with one of the others of their region in another component, as far as a summary by size tells.

    The summary holds the least size, the most that can be shared and the components of each size class, a few dozen for a region.
    """
    per = others.groupBy("region", F.floor(F.log("n") * CLASSES).alias("class")).agg(F.min("n").alias("n"), F.max(F.col("n") - F.col("i")).alias("most"), F.min("component_id").alias("c1"), F.max("component_id").alias("c2"))
    known = per.groupBy("region").agg(F.collect_list(F.struct("n", "most", "c1", "c2")).alias("known"))
    fits = lambda o: may_link(F.col("n"), F.col("i"), o["n"], o["n"] - o["most"]) & ((o["c1"] != F.col("component_id")) | (o["c2"] != F.col("component_id")))
    return rows.join(known, "region").where(F.exists("known", fits)).drop("known")


def opened(regions: DataFrame, label: DataFrame, name: str) -> DataFrame:
    """(region, node, n, i, component_id, main, size, outside): the members of regions that may still link with another component.

    main is the component of most members, size counts the members and outside those of other components.
    """
    seen = regions.join(label.withColumnRenamed("id", "node"), "node")
    per = seen.groupBy("region", "component_id").agg(F.count("*").alias("c"))
    several = per.groupBy("region").agg(F.sum("c").alias("size"), F.max(F.struct("c", "component_id")).alias("m")).where("m.c < size")
    several = written(seen.join(several.select("region", F.col("m.component_id").alias("main")), "region"), f"{name}-several")
    outside = written(partnered(several.where("component_id <> main"), several), f"{name}-outside")
    inside = partnered(several.where("component_id = main"), outside)
    left = written(outside.union(inside), f"{name}-left")
    counts = left.groupBy("region").agg(F.count("*").alias("size"), F.count_if(F.col("component_id") != F.col("main")).alias("outside"))
    return left.join(counts, "region").select("region", "node", "n", "i", "component_id", "main", "size", "outside")


def divided(rest: DataFrame, pivots: DataFrame, got: DataFrame, name: str) -> DataFrame:
    """(region, node, n, i): rest, the members of open regions, in the Voronoi regions of the pivots and their windows.

    got holds distances of pairs; those of others lie between what the sizes leave and 1. A region stays whole where
    its parts would hold more pairs to look at than it does.
    """
    both = got.select("a", "b", "d").union(got.select("b", "a", "d")).toDF("node", "pivot", "d")
    each = rest.join(pivots.where("divides").select("region", "pivot", F.col("pn").alias("m")), "region").join(both, ["node", "pivot"], "left")
    each = each.withColumns({"lo": F.coalesce("d", 1 - F.least("n", "m") / F.greatest("n", "m")), "hi": F.coalesce("d", F.lit(1.0))})
    least = each.groupBy("region", "node").agg(F.min("hi").alias("least"))
    within = written(each.join(least, ["region", "node"]).where(F.col("lo") <= F.col("least") + 2 * RADIUS + 1e-9).select("region", "pivot", "node", "n", "i", "main", "component_id", "size", "outside"), name)
    work = within.groupBy("region", "pivot", "size", "outside").agg((F.count("*") * F.count_if(F.col("component_id") != F.col("main"))).alias("w"))
    fewer = work.groupBy("region", "size", "outside").agg(F.sum("w").alias("w")).where("w < size * outside").select("region")
    parts = within.join(fewer, "region", "left_semi").select(F.xxhash64("region", "pivot").alias("region"), "node", "n", "i")
    return rest.join(fewer, "region", "left_anti").select("region", "node", "n", "i").union(parts)


def components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) for each row.

    Words are `[^\\x20\\x09-\\x0D]+` after A-Z became lower-case; a document's set holds its distinct five-word shingles, or
    its whole word sequence if that is shorter. Documents link when 100 * intersection >= 80 * union. Null, empty and
    blank texts have no shingles and link with nothing. Documents with equal sets are one representative, the smallest id,
    so a group of copies costs one document. The key is an integer that names one text: repeated rows each get the same
    result, rows with a null key have no component. Other columns are not read, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    screen = written(screened(docs, key, text), "screen")
    known = screen.where("n > 0 and id is not null").select("id", "n", "c1", "c2")
    reps = written(known.groupBy("c1", "c2", "n").agg(F.min("id").alias("rep")), "reps")
    asked = written(candidates(screen, reps), "candidates")
    few = asked.count() <= BROADCAST_IDS
    ids = asked.withColumnRenamed("id", key)
    sets = written(sets_of(docs.join(F.broadcast(ids) if few else ids, key, "left_semi"), key, text).dropDuplicates(["id"]), "sets")
    regions = written(regions_of(sets), "regions")

    # Every region's members against its pivot document.
    pivot = regions.groupBy("region").agg(F.count("*").alias("c"), F.min(F.struct("i", "node", "n")).alias("p")).where("c > 1")
    star = regions.join(pivot, "region").where((F.col("node") != F.col("p.node")) & may_link(F.col("n"), F.col("i"), F.col("p.n"), F.col("p.i")))
    met = compared(sets, star.select("node", F.col("p.node").alias("pivot")).select(*ordered("node", "pivot")).distinct(), "stars")
    label = written(labelled(regions.select(F.col("node").alias("id")).distinct(), met.where("linked")), "labels")

    left, k = regions, 0
    while True:
        open_ = opened(left, label, f"open{k}")
        if not open_.limit(1).count():
            break
        draw = F.pmod(F.xxhash64("node", F.lit(k)), F.col("outside"))
        outside = open_.where("component_id <> main")
        # The first of each region goes anyway, so that every round ends with fewer members.
        first = outside.groupBy("region").agg(F.min(F.struct("i", "node", "n", "component_id")).alias("p")).select("region", "p.*", F.lit(True).alias("divides"))
        pivots = outside.where(draw < PIVOTS * 4**k).select("region", "i", "node", "n", "component_id", (draw < DIVIDING).alias("divides")).union(first)
        pivots = pivots.groupBy("region", F.col("node").alias("pivot"), F.col("n").alias("pn"), F.col("i").alias("pi"), F.col("component_id").alias("pc")).agg(F.max("divides").alias("divides"))
        pivots = written(pivots, f"pivots{k}")
        pairs = open_.join(pivots, "region").where((F.col("component_id") != F.col("pc")) & may_link(F.col("n"), F.col("i"), F.col("pn"), F.col("pi")))
        got = compared(sets, pairs.select(*ordered("node", "pivot")).distinct(), f"met{k}")
        label = merged(label, got.where("linked"), f"label{k}")
        done = pivots.select("region", F.col("pivot").alias("node"))
        rest = open_.join(done, ["region", "node"], "left_anti").join(pivots.groupBy("region").agg(F.count("*").alias("gone")), "region").where("gone < outside")
        left, k = divided(rest, pivots, got, f"windows{k}"), k + 1

    of = known.join(reps, ["c1", "c2", "n"]).select("id", "rep").distinct()
    final = of.join(label.withColumnRenamed("id", "rep"), "rep", "left").select("id", F.coalesce("component_id", "rep").alias("component_id"))
    out = screen.where("n >= 0").select("id", F.col("n").alias("n_shingles")).join(final, "id", "left")
    return out.select(F.col("id").alias(key), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
