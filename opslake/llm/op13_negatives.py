"""Hard-negative mining by inner products with an STR-packed R-tree.

Rows of one label lie in shards, each packed by sort-tile-recursion into boxes of boxes. The coordinates' bounds of a box
and the anchor give an interval that holds the inner products of all rows in it. A queue gives the boxes of the highest
upper bound first; boxes outside every score window, or strictly below the kth score of all that are left, are pruned.

The stated anchors meet all shards in blocks: a task gets one shard and one block of anchors, whatever the sizes of labels.
"""

from __future__ import annotations

import bisect
import heapq
import math
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslake.llm.common import written

#: Rows of a leaf box, boxes of a box, rows of a shard, anchors that meet a shard in one task.
LEAF, FAN, SHARD, ANCHORS = 64, 16, 16_384, 4_096
#: Components are floor(SCALE * x); those of a larger magnitude than LARGEST count like non-finite ones, so that scores fit into 64 bits.
SCALE, LARGEST = 256, 1 << 18
#: First rows of the same label that are positives, and rows of other labels for each of them.
POSITIVES, NEGATIVES = 5, 3
#: Shares of the positive's score, in hundredths, between which a negative's score lies.
LEAST, MOST = 50, 95
#: Stands for a null key, which comes last among equal scores.
NO_ID = (1 << 63) - 1


def tiles(x: np.ndarray) -> np.ndarray:
    """The order of rows in which each LEAF of them are a tile: slabs of equal size along one coordinate after the other, the widest first."""
    n, dims = x.shape
    wanted, tile = -(-n // LEAF), np.zeros(n, np.int64)
    by_spread = np.argsort(-(x.max(0) - x.min(0)), kind="stable")
    for k, dim in enumerate(by_spread):
        if wanted <= 1:
            break
        slabs = max(2, round(wanted ** (1 / (dims - k))))
        order = np.lexsort((x[:, dim], tile))
        sizes = np.bincount(tile)
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        place = np.arange(n) - first[tile[order]]
        per = np.maximum(LEAF, LEAF * -(-sizes // (slabs * LEAF)))  # slabs hold whole leaves
        new = tile.copy()
        new[order] = tile[order] * slabs + place // per[tile[order]]
        tile = np.unique(new, return_inverse=True)[1]
        wanted = -(-wanted // slabs)
    return np.argsort(tile, kind="stable")


class RTree:
    """Boxes of packed rows; a node's children are consecutive nodes of the level below."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = tiles(x)
        self.ids, self.x = ids[order], x[order]
        starts = np.arange(0, len(x), LEAF)
        low, high = np.minimum.reduceat(self.x, starts), np.maximum.reduceat(self.x, starts)
        self.levels = [(low, high)]
        while len(low) > 1:
            starts = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            self.levels.append((low, high))

    def intervals(self, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each level the bounds of the inner products of each anchor with what each box holds."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return [(up @ low.T + down @ high.T, up @ high.T + down @ low.T) for low, high in self.levels]


class Best:
    """The best k rows of one score window; floor is the least score that still may belong to them."""

    def __init__(self, low: float, high: float, k: int):
        self.floor, self.high, self.k, self.rows = low, high, k, []

    def offer(self, score: int, row: int) -> None:
        """Takes a row if it is among the best; equal scores go by the smaller id."""
        if self.floor <= score <= self.high:
            bisect.insort(self.rows, (-score, row))
            if len(self.rows) >= self.k:
                del self.rows[self.k :]
                self.floor = max(self.floor, -self.rows[-1][0])


def search(tree: RTree, anchor: np.ndarray, bounds: list[tuple[np.ndarray, np.ndarray]], windows: list[Best], own: int | None = None) -> int:
    """Fills the windows with the tree's rows, but for those of the anchor's own id; gives the number of leaves that were read."""
    top, read = len(tree.levels) - 1, 0
    queue = [(-bounds[top][1][0], top, 0)]
    while queue:
        most, level, node = heapq.heappop(queue)
        least = bounds[level][0][node]
        # Outside a window, or strictly below its kth score: floor is the larger of the window's beginning and that score.
        open_ = [w for w in windows if -most >= w.floor and least <= w.high]
        if not open_:
            continue
        if level:
            low, high = bounds[level - 1]
            for child in range(node * FAN, min(node * FAN + FAN, len(high))):
                heapq.heappush(queue, (-high[child], level - 1, child))
            continue
        at, read = node * LEAF, read + 1
        scores = tree.x[at : at + LEAF] @ anchor
        hit = np.flatnonzero((scores >= min(w.floor for w in open_)) & (scores <= max(w.high for w in open_)))
        for score, row in zip(scores[hit].tolist(), tree.ids[at + hit].tolist(), strict=True):
            if row != own:
                for w in open_:
                    w.offer(int(score), row)
    return read


def matrix(*rows: Iterable) -> list[np.ndarray]:
    """Vectors as matrices whose products are exact: doubles while all sums stay below 2 ** 53, else 64-bit integers."""
    out = [np.array(list(r), np.int64) for r in rows]
    largest = max(int(np.abs(x).max(initial=0)) for x in out)
    return [x.astype(np.float64) for x in out] if largest * largest * out[0].shape[1] < 1 << 53 else out


def searched(shard: pd.DataFrame, anchors: pd.DataFrame, found: Callable[[pd.Series, RTree, np.ndarray, list], list[tuple]], columns: list[str]) -> pd.DataFrame:
    """Each anchor's rows from one shard."""
    out: list[tuple] = []
    if len(shard) and len(anchors):
        x, a = matrix(shard["v"], anchors["v"])
        tree = RTree(shard["id"].to_numpy(np.int64), x)
        for at in range(0, len(a), 256):
            bounds = tree.intervals(a[at : at + 256])
            for k, row in enumerate(anchors.iloc[at : at + 256].itertuples(index=False)):
                out += found(row, tree, a[at + k], [(low[k].tolist(), high[k].tolist()) for low, high in bounds])
    return pd.DataFrame(out, columns=columns)


def first(df: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k rows by score and id, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def blocked(shards: DataFrame, sizes: DataFrame, anchors: DataFrame, other: bool) -> tuple[DataFrame, DataFrame]:
    """Shards and anchors, each repeated for the blocks of the other side: the anchors of a label meet its shards, or with `other` those of the other labels.

    Anchors are dealt into blocks by their own number, so that no task gets more than about ANCHORS of them.
    """
    n_blocks = max(1, -(-anchors.count() // ANCHORS))
    a = anchors.withColumn("b", F.pmod(F.xxhash64("a"), F.lit(n_blocks)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("b")
    meets = F.col("kind") != F.col("s_kind") if other else F.col("kind") == F.col("s_kind")
    # The list of shards is short against the rows, one for SHARD rows at most and label, and each block of anchors gets its own.
    pairs = a.join(sizes.select("g", F.col("kind").alias("s_kind"), "dims", every), ["b", "dims"]).where(meets)
    return shards.select("g", "id", "v", every), pairs


def mine(vectors: DataFrame, is_anchor: Column, key: str = "vec_id", embedding: str = "embedding", label: str | Column = "label", positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of each anchor and positive.

    A component x is floor(256 * x), a score the inner product with the anchor; higher ones come first, ties by smaller key, null keys last.
    An anchor's positives are its first rows of the same label, negatives the first rows of other labels whose score is between
    50 and 95 hundredths of the positive's. Where there are fewer, all are returned; a positive without any negative has no rows.
    Rows with a null label or vector, with a null or non-finite component, one of a magnitude of 2 ** 18 or more, or no component
    take no part; vectors of different lengths don't meet. Equal rows count once. An anchor never meets rows of its own key.
    Rows with a null key take part and can't be anchors. An empty table gives no rows; other columns aren't read, whatever their names.

    Of equal vectors of one label only the first few keys can be among the results, so a vector of any number of copies is no hot
    group: all but those go before rows are dealt into shards.
    """
    spark = vectors.sparkSession
    kind = F.col(label) if isinstance(label, str) else label
    v = vectors.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), kind.cast("string").alias("kind"), F.col(embedding).cast("array<double>").alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    usable = v.where(F.col("kind").isNotNull() & F.expr(f"size(x) > 0 and forall(x, c -> c is not null and not isnan(c) and abs(c) < {LARGEST})"))
    rows = usable.select("id", "kind", "is_anchor", F.size("x").alias("dims"), F.transform("x", lambda c: F.floor(c * SCALE).cast("int")).alias("v")).distinct()
    rows = written(rows, "vectors")
    anchors = written(rows.where(F.col("is_anchor") & (F.col("id") < NO_ID)).select(F.monotonically_increasing_id().alias("a"), "id", "kind", "dims", "v"), "anchors")

    needed = max(positives, negatives) + 1
    few = rows.drop("is_anchor").withColumn("_rn", F.row_number().over(Window.partitionBy("kind", "v").orderBy("id"))).where(F.col("_rn") <= needed).drop("_rn")
    parts = max(1, -(-rows.count() // SHARD))
    # Shards are slabs of each label along its first coordinates; the id tells equal vectors apart.
    near = [F.element_at("v", 1), F.col("v")]
    dealt = few.repartitionByRange(parts, "kind", "dims", *near, "id")
    shards = written(dealt.withColumn("g", F.concat_ws("/", F.spark_partition_id(), "dims", "kind")), "shards")
    sizes = written(shards.groupBy("g", "kind", "dims").agg(F.count("*").alias("n")), "sizes")

    def same_label(a: pd.Series, tree: RTree, x: np.ndarray, bounds: list) -> list[tuple]:
        w = Best(-math.inf, math.inf, positives)
        search(tree, x, bounds, [w], a.id)
        return [(a.a, i, -s) for s, i in w.rows]

    def other_labels(a: pd.Series, tree: RTree, x: np.ndarray, bounds: list) -> list[tuple]:
        windows = [Best(-(-LEAST * int(p) // 100), MOST * int(p) // 100, negatives) for p in a.scores]
        search(tree, x, bounds, windows, a.id)
        return [(a.a, k, i, -s) for k, w in enumerate(windows) for s, i in w.rows]

    def positive_rows(_: tuple, s: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        return searched(s, a, same_label, ["a", "id", "score"])

    def negative_rows(_: tuple, s: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        return searched(s, a, other_labels, ["a", "p", "id", "score"])

    s, pairs = blocked(shards, sizes, anchors, other=False)
    with_label = s.groupBy("g", "b").cogroup(pairs.select("g", "b", "a", "id", "v").groupBy("g", "b")).applyInPandas(positive_rows, "a long, id long, score long")
    chosen = written(first(with_label, ["a"], positives), "positives")
    scores = chosen.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("s")).select("a", F.col("s.score").alias("scores"))
    s, pairs = blocked(shards, sizes, anchors.join(scores, "a"), other=True)
    without_label = s.groupBy("g", "b").cogroup(pairs.select("g", "b", "a", "id", "v", "scores").groupBy("g", "b")).applyInPandas(negative_rows, "a long, p int, id long, score long")
    hard = first(without_label, ["a", "p"], negatives).select("a", (F.col("p") + 1).alias("nth"), "rank", F.expr(f"nullif(id, {NO_ID})").alias("negative_id"), F.col("score").alias("negative_score"))
    out = hard.join(chosen.select("a", F.col("rank").alias("nth"), F.expr(f"nullif(id, {NO_ID})").alias("positive_id"), F.col("score").alias("positive_score")), ["a", "nth"]).join(anchors.select("a", F.col("id").alias("anchor_id")), "a")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
