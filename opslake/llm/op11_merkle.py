"""Merkle manifest of a dataset by SHA midstates.

A parent's digest is the hash of its children's digests, so the hash state before a child's slot covers all children left of
it. Parents keep a copy of that state for every slot: to fold a replaced child up, the copy is resumed with the replacement
and the digests right of it, and nothing left of it is hashed again.

Leaves are hashed where their rows are read; after that only digests move. Nodes get their places from one range shuffle,
and a block of FAN ** DEEP consecutive nodes is raised by one task. On the way down each block gets its path, the
digests beside it on all levels above, so that every leaf is folded to the root in its own block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslake.llm.common import bounded_batches, written

#: Children of a node; levels that one task raises at once; rows for each partition of the range shuffle.
FAN, DEEP, PART = 8, 3, 200_000
BLOCK = FAN**DEEP
#: What is hashed of a row, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(c: Column) -> Column:
    """'-' for null, else the length in UTF-8 bytes, ':' and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, all else as it is."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, capitals, capitals.lower())


def placed(nodes: DataFrame, order: list[str], rows: int) -> DataFrame:
    """nodes (g, ...) with pos, the place of each row in its group in the given order, and n, the group's size.

    One range shuffle over group and order; a last key tells equal rows apart, so that a group of any size, of equal rows too,
    is spread. Only counts by partition and group are gathered to find where each partition begins.
    """
    parts = max(1, -(-rows // PART), int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = nodes.withColumn("_salt", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(parts, "g", *order, "_salt").sortWithinPartitions("g", *order, "_salt").drop("_salt")
    # Row numbers of a partition are the lower 33 bits of these ids, which follow the sorted order.
    dealt = written(dealt.withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33)), "placed")
    counts = dealt.groupBy("g", "_part").agg(F.count("*").alias("c"), F.min("_id").alias("first"))
    whole = Window.partitionBy("g")
    before = F.coalesce(F.sum("c").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("g").alias("_g"), F.col("_part").alias("_p"), "first", before.alias("before"), F.sum("c").over(whole).alias("n"))
    joined = dealt.join(starts, F.col("g").eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return joined.withColumn("pos", F.col("before") + F.col("_id") - F.col("first")).drop("_id", "_part", "_g", "_p", "first", "before")


class Subtree:
    """The levels above some consecutive nodes of one group, with the states that parents keep."""

    def __init__(self, digests: list[str], n: int):
        """n: how many nodes the whole group has on this level; with a single one there is nothing above."""
        self.levels, self.states = [digests], []
        while len(self.states) < DEEP and n > 1:
            below, up, kept = self.levels[-1], [], []
            for at in range(0, len(below), FAN):
                state = hashlib.sha256()
                for child in below[at : at + FAN]:
                    kept.append(state.copy())
                    state.update(child.encode())
                up.append(state.hexdigest())
            self.levels.append(up)
            self.states.append(kept)
            n = -(-n // FAN)

    def fold(self, at: int, digest: str) -> str:
        """The block's node with another digest at a place: kept states go on with it and the digests right of it."""
        for below, kept in zip(self.levels, self.states, strict=False):
            state = kept[at].copy()
            state.update("".join([digest, *below[at + 1 : at - at % FAN + FAN]]).encode())
            digest, at = state.hexdigest(), at // FAN
        return digest

    def beside(self, at: int) -> tuple[list[str], list[str]]:
        """The digests left and right of a node and of its ancestors, joined level by level."""
        left, right = [], []
        for below in self.levels[: len(self.states)]:
            run = at - at % FAN
            left.append("".join(below[run:at]))
            right.append("".join(below[at + 1 : run + FAN]))
            at //= FAN
        return left, right


class Path:
    """The states that the ancestors of a block keep for the slots on its way to the root."""

    def __init__(self, left: Sequence[str], right: Sequence[str]):
        self.states = [hashlib.sha256(x.encode()) for x in left]
        self.right = list(right)

    def fold(self, digest: str) -> str:
        for kept, right in zip(self.states, self.right, strict=True):
            state = kept.copy()
            state.update((digest + right).encode())
            digest = state.hexdigest()
        return digest


def blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / BLOCK))


def raised(nodes: DataFrame, name: str) -> DataFrame:
    """(g, pos, n, digest) of the nodes DEEP levels higher, or of the group's last one where that is reached before."""

    def run(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("pos")
        top = Subtree(b["digest"].tolist(), int(b["n"].iloc[0])).levels[-1]
        return pd.DataFrame({"g": b["g"].iloc[:1], "pos": b["block"].iloc[:1], "n": -(-b["n"].iloc[:1] // BLOCK), "digest": top})

    kind = nodes.schema["g"].dataType.simpleString()
    return written(blocks(nodes).select("g", "block", "pos", "n", "digest").groupBy("g", "block").applyInPandas(run, f"g {kind}, pos long, n long, digest string"), name)


def lowered(nodes: DataFrame, paths: DataFrame | None, name: str) -> DataFrame:
    """(g, pos, left, right): the path of each node. paths: (g, pos, left, right) of the blocks above; None where there are none."""

    def run(b: pd.DataFrame) -> pd.DataFrame:
        above, b = b[b["pos"] < 0], b[b["pos"] >= 0].sort_values("pos")
        tree = Subtree(b["digest"].tolist(), int(b["n"].iloc[0]))
        left, right = (list(above[c].iloc[0]) if len(above) else [] for c in ("left", "right"))
        each = [tree.beside(k) for k in range(len(b))]
        return pd.DataFrame({"g": b["g"], "pos": b["pos"], "left": [x + left for x, _ in each], "right": [y + right for _, y in each]})

    kind = nodes.schema["g"].dataType.simpleString()
    rows = with_paths(nodes.select("g", "pos", "n", "digest"), paths)
    return written(rows.groupBy("g", "block").applyInPandas(run, f"g {kind}, pos long, left array<string>, right array<string>"), name)


def with_paths(nodes: DataFrame, paths: DataFrame | None) -> DataFrame:
    """Nodes with their blocks, and each block's path as a further row of it at place -1."""
    rows = blocks(nodes)
    if paths is None:
        return rows.withColumns({c: F.lit(None).cast("array<string>") for c in ("left", "right")})
    heads = paths.withColumnRenamed("pos", "block").withColumn("pos", F.lit(-1).cast("long"))
    return rows.unionByName(heads, allowMissingColumns=True)


def tower(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The nodes of every DEEP-th level, from those given to the one node of each group. Only the largest size reaches the driver."""
    stages = [nodes]
    while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
        nodes = raised(nodes, f"{name}{len(stages)}")
        stages.append(nodes)
    return stages


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang", tampered: dict[str, Column] | None = None) -> DataFrame:
    """(key, group, leaf, subroot, root, left, right, folded_root, verified), one row for each row.

    A leaf is the sha256 of the fields, each '-' if null, else its length in UTF-8 bytes, ':' and the value. Leaves of a group
    (null is one) ascend by key, null keys first, equal keys by their leaves; of each FAN consecutive nodes one is made, until one is left, the subroot.
    Subroots, ordered by group, null first, are raised to the root alike. left and right are the proof: for each level up to the
    root the digests beside the node, joined ('' where there are none). tampered: other values of some columns, as expressions; folded_root is
    the root that follows from the leaf of the tampered row and the original digests beside it, verified tells whether it is the root.

    Null and empty texts are values of their own; repeated rows are leaves of their own; an empty table gives no rows; other columns,
    whatever their names, are not read. A group of any size is divided by place, so none is a hot key.
    """
    bounded_batches(docs.sparkSession)
    new = [(tampered or {}).get(c, F.col(c)) for c in fields]
    leaves = docs.select(F.col(key).alias("k"), F.col(group).cast("string").alias("g"), leaf_digest([F.col(c) for c in fields]).alias("digest"), leaf_digest(new).alias("changed"))
    leaves = written(leaves.withColumn("changed", F.expr("nullif(changed, digest)")), "leaves")
    low = tower(placed(leaves, ["k", "digest"], leaves.count()), "tree")
    subroots = low[-1].select(F.lit(0).alias("g"), F.col("g").alias("name"), "digest")
    high = tower(placed(subroots, ["name"], 1), "top")

    paths = None
    for stage in high[-2::-1]:
        paths = lowered(stage, paths, "high-path")
    if paths is None:  # a single group has no levels above it, and an empty table no group
        paths = high[0].select("g", "pos", F.array().cast("array<string>").alias("left"), F.array().cast("array<string>").alias("right"))
    paths = high[0].select("name", "g", "pos").join(paths, ["g", "pos"]).select(F.col("name").alias("g"), F.lit(0).cast("long").alias("pos"), "left", "right")
    for stage in low[-2:0:-1]:
        paths = lowered(stage, paths, "path")

    kind = docs.schema[key].dataType.simpleString()

    def run(b: pd.DataFrame) -> pd.DataFrame:
        above, b = b[b["pos"] < 0], b[b["pos"] >= 0].sort_values("pos")
        digests, changed = b["digest"].tolist(), b["changed"].tolist()
        tree = Subtree(digests, int(b["n"].iloc[0]))
        left, right = (list(above[c].iloc[0]) for c in ("left", "right"))
        path = Path(left, right)
        folded = [path.fold(tree.fold(k, new or old)) for k, (old, new) in enumerate(zip(digests, changed, strict=True))]
        each = [tree.beside(k) for k in range(len(b))]
        return pd.DataFrame({"k": b["k"], "g": b["g"], "leaf": digests, "subroot": above["subroot"].iloc[0], "root": above["root"].iloc[0], "left": [x + left for x, _ in each], "right": [y + right for _, y in each], "folded_root": folded})

    root = high[-1].select(F.col("digest").alias("root"))
    named = low[-1].select(F.col("g").alias("_g"), F.col("digest").alias("subroot")).crossJoin(F.broadcast(root))  # the root is one row
    paths = paths.join(named, F.col("g").eqNullSafe(F.col("_g"))).drop("_g")
    rows = with_paths(low[0].select("k", "g", "pos", "n", "digest", "changed"), paths)
    out = rows.groupBy("g", "block").applyInPandas(run, f"k {kind}, g string, leaf string, subroot string, root string, left array<string>, right array<string>, folded_root string")
    return out.select(F.col("k").alias(key), F.col("g").alias(group), "leaf", "subroot", "root", "left", "right", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
