"""Embedding near-dedup by Euclidean p-stable hashing.

Vectors are normalised, so that a cosine is a distance. Each of several tables quantises random projections into a
bucket key; vectors that meet in a bucket get an exact cosine check. A pair counts in the first table in which it meets.
Projections and tables follow from the number of vectors, so that chance meetings stay few and recall stays the same.
In a large bucket the vectors within half the link angle of one of them are a ball: by the triangle inequality all of them
link with each other, so only pairs with a member outside the bucket's largest ball are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import bounded_batches, labelled, written

#: Width of a quantised step, expected recall at the least cosine that links, expected chance meetings of a vector in a table.
STEP, RECALL, MEETINGS = 1.5, 0.96, 0.05
COSINE = 0.93
#: Members of one block on each side of a comparison, pairs that are compared at once, members of a bucket in which balls are formed, tables whose buckets form them.
BLOCK, PAIRS, LARGE, FIRST = 1000, 1 << 15, 12, 6


def collision(distance: float, step: float = STEP) -> float:
    """How often one projection puts two vectors at this distance into the same step."""
    r = step / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def design(n: int, cosine: float = COSINE) -> tuple[int, int]:
    """Projections of a key and number of tables for n vectors that could link: chance pairs are at right angles."""
    far, near = collision(math.sqrt(2)), collision(math.sqrt(2 - 2 * cosine))
    projections = max(4, math.ceil(math.log(max(n, 2) / MEETINGS) / -math.log(far)))
    return projections, math.ceil(math.log(1 - RECALL) / math.log(1 - near**projections))


def keys(x: np.ndarray, projections: int, tables: int, step: float = STEP, seed: int = 11) -> np.ndarray:
    """A 64-bit bucket key for each unit vector and table."""
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((x.shape[1], tables * projections))
    cell = np.floor((x @ a + rng.uniform(0, step, tables * projections)) / step).astype(np.int64).reshape(len(x), tables, projections)
    out = np.zeros((len(x), tables), np.uint64)
    for k in range(projections):
        out = (out ^ cell[:, :, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.astype(np.int64)


def scaled(x: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that brings its largest component near 1: cosines stay the same, and squares neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The cosine of each row of x with that of y."""
    return np.einsum("ij,ij->i", x, y) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))


def balls(met: DataFrame, points: DataFrame, cosine: float) -> DataFrame:
    """(id, ball): vectors of large buckets of the first tables that lie within half the link angle of a bucket's first vector, which names the ball; one for each vector."""
    half = math.cos(math.acos(cosine) / 2) + 1e-9
    large = met.where((F.col("n") > LARGE) & (F.col("t") < FIRST))
    first = large.groupBy("bucket").agg(F.min("id").alias("ball"))
    asked = large.join(first, "bucket").where("id <> ball").select("id", "ball").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                near = [cosines(np.array([x]), np.array([y]))[0] >= half for x, y in zip(b["x"], b["y"], strict=True)]
                yield b.loc[near, ["id", "ball"]]

    pairs = asked.join(points.select("id", "x"), "id").join(points.select(F.col("id").alias("ball"), F.col("x").alias("y")), "ball")
    return written(pairs.select("id", "ball", "x", "y").mapInPandas(run, "id long, ball long").groupBy("id").agg(F.min("ball").alias("ball")), "balls")


def linked(g: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """(id, n, to): of the anchors and members in g, whose groups are complete, the weight of new links and the smallest id that links reach."""
    lead, rest = g[g["anchor"]], g[~g["anchor"]]
    groups = rest["g"].to_numpy()
    order = np.argsort(groups, kind="stable")
    rest, groups = rest.iloc[order], groups[order]
    low, high = (np.searchsorted(groups, lead["g"].to_numpy(), s) for s in ("left", "right"))
    a, b = ({c: d[c].to_numpy() for c in ("id", "ball", "outer", "copies", "t")} for d in (lead, rest))
    (xa, ka), (xb, kb) = ((np.array(d["x"].tolist()), np.array(d["keys"].tolist())) for d in (lead, rest))
    ends, at, found = np.cumsum(high - low), 0, [(np.zeros(0, np.int64),) * 3]
    while at < len(lead):  # anchors for about PAIRS pairs at a time
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        per = (high - low)[at:to]
        i = np.repeat(np.arange(at, to), per)
        j = np.repeat(low[at:to] - np.cumsum(per) + per, per) + np.arange(per.sum())
        # Two outer members are each other's anchors; those of one ball are linked already.
        keep = (a["ball"][i] != b["ball"][j]) & ~(b["outer"][j] & (a["id"][i] >= b["id"][j]))
        i, j = i[keep], j[keep]
        if len(i):
            near = cosines(xa[i], xb[j]) >= cosine
            i, j = i[near], j[near]
            earlier = np.arange(ka.shape[1]) < a["t"][i][:, None]
            new = ~((ka[i] == kb[j]) & earlier).any(1)
            i, j = i[new], j[new]
            found += [(a["id"][i], b["id"][j], b["copies"][j]), (b["id"][j], a["id"][i], a["copies"][i])]
        at = to
    left, right, weight = (np.concatenate(c) for c in zip(*found, strict=True))
    ids, at = np.unique(left, return_inverse=True)
    n, root, other = np.bincount(at, weight, len(ids)).astype(np.int64), ids.copy(), np.searchsorted(ids, right)
    while True:
        lower = root.copy()
        np.minimum.at(lower, at, root[other])
        lower = lower[np.searchsorted(ids, lower)]
        if (lower == root).all():
            return pd.DataFrame({"id": ids, "n": n, "to": root})
        root = lower


def near_duplicates(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept) for each row.

    Two vectors link when their labels are equal and not null and their cosine in double precision is at least `cosine`.
    Null, empty and zero vectors, and those with null or non-finite components, link with nothing; vectors of different
    lengths don't link. Equal vectors under one label are one representative with a weight, so many copies are no hot
    bucket. A repeated key names one vector (of several the smallest), and each of its rows gets the same result; rows with
    a null key link with nothing. Other columns are not read, whatever their names.
    Buckets are split into pairs of blocks: no task holds a whole bucket, and no pairs are written.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    v = vectors.select(F.col(key).alias("id"), F.col(label).cast("string").alias("label"), F.col(embedding).cast("array<double>").alias("x"))
    usable = v.where(F.col("label").isNotNull() & F.col("id").isNotNull() & F.expr("size(x) > 0 and forall(x, c -> c is not null and not isnan(c) and abs(c) < double('infinity')) and exists(x, c -> c <> 0)"))
    one = usable.groupBy("id").agg(F.min(F.struct("label", "x")).alias("v")).select("id", F.concat_ws("/", F.size("v.x"), "v.label").alias("label"), "v.x", F.sha2(F.array_join(F.col("v.x").cast("array<string>"), ","), 256).alias("h"))
    one = written(one, "vectors")
    same = ["label", "h"]
    reps = written(one.groupBy(*same).agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "reps")
    most = reps.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    projections, tables = design(most, cosine)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, g in b.groupby(b["x"].map(len)):
                x = scaled(np.array(g["x"].tolist(), np.float64))
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                yield pd.DataFrame({"id": g["id"], "label": g["label"], "copies": g["copies"], "x": list(x), "keys": list(keys(unit, projections, tables))})

    rep = one.join(reps.select(F.col("rep").alias("id"), "copies"), "id")
    points = written(rep.select("id", "label", "copies", "x").mapInPandas(hashed, "id long, label string, copies long, x array<double>, keys array<long>"), "points")
    met = points.select("id", "label", F.posexplode("keys").alias("t", "k")).select("id", "t", F.xxhash64("label", "t", "k").alias("bucket"))
    met = written(met.join(met.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "bucket"), "met")
    ball = balls(met, points, cosine)

    # Members outside the bucket's largest ball meet all others; those inside it meet no one of their own.
    placed = met.join(ball, "id", "left").withColumn("ball", F.coalesce("ball", "id"))
    main = placed.groupBy("bucket", "ball").agg(F.count("*").alias("c")).groupBy("bucket").agg(F.max(F.struct("c", "ball")).alias("m"))
    placed = placed.join(main, "bucket").withColumn("outer", F.col("ball") != F.col("m.ball")).withColumn("out", F.col("n") - F.col("m.c")).where("out > 0")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    own = lambda n: F.pmod(F.xxhash64("id"), blocks(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    columns = ["id", "t", "bucket", "ball", "outer"]
    anchors = placed.where("outer").select(*columns, own("out").alias("b1"), every("n").alias("b2"), F.lit(True).alias("anchor"))
    members = placed.select(*columns, every("out").alias("b1"), own("n").alias("b2"), F.lit(False).alias("anchor"))
    group = ["bucket", "b1", "b2"]
    rows = anchors.union(members).join(points.select("id", "copies", "x", "keys"), "id")
    dealt = rows.repartition(*group).sortWithinPartitions(*group).select(F.xxhash64(*group).alias("g"), "t", "id", "ball", "outer", "anchor", "copies", "x", "keys")

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def each(b: pd.DataFrame) -> Iterator[pd.DataFrame]:
            for _, same_size in b.groupby(b["x"].map(len)):
                yield linked(same_size, cosine)

        left: list[pd.DataFrame] = []  # rows of a group that may go on in the next batch
        for b in batches:
            if not len(b):
                continue
            if left and b["g"].iloc[-1] == left[0]["g"].iloc[0]:
                left.append(b)
                continue
            b = pd.concat([*left, b])
            last = (b["g"] == b["g"].iloc[-1]).to_numpy()
            left = [b[last]]
            yield from each(b[~last])
        if left:
            yield from each(pd.concat(left))

    links = written(dealt.mapInPandas(compared, "id long, n long, to long"), "links")
    counts = links.groupBy("id").agg(F.sum("n").alias("n"))
    whole = reps.select(F.col("rep").alias("id"), "copies", *same).join(ball, "id", "left").withColumn("ball", F.coalesce("ball", "id"))
    sizes = whole.groupBy("ball").agg(F.sum("copies").alias("within"))
    edges = links.select(F.col("id").alias("a"), F.col("to").alias("b")).union(ball.select("id", "ball")).where("a <> b")
    component = labelled(whole.select("id"), edges)
    # Equal vectors and those of the ball are links, and those found in buckets.
    of_rep = whole.join(sizes, "ball").join(counts, "id", "left").join(component, "id").select(*same, (F.coalesce("n", F.lit(0)) + F.col("within") - 1).alias("n_links"), "component_id")
    each_ = one.select("id", *same).join(of_rep, same).select("id", "n_links", "component_id")
    out = vectors.select(F.col(key).alias("k")).join(each_, F.col("k") == F.col("id"), "left")
    return out.select(F.col("k").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", F.col("k")).cast("long").alias("component_id"), F.coalesce(F.col("component_id") == F.col("k"), F.lit(True)).alias("kept"))
