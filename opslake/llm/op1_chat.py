"""Chat formatting by cumulative-snapshot collapse, with DataFrame operations only.

Loggers often store a conversation again after every turn. Rolling hashes of turn prefixes identify the logged
conversations that are prefixes of longer ones; an anti-join keeps the maximal ones, which are then rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslake.llm.common import bucketed, written

#: Turn numbers in one block and rows in one segment: no row holds more turns, and windows over turns lie within blocks.
BLOCK = 256


def stored(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(seg, part, block, conv, key, lines, ha, hb): at most BLOCK turns in a row, with the hashes of role and text of each.

    seg stands for conversation and block of turn numbers, part for the pieces of a block that holds more rows than numbers.
    Turns are ordered by number (null first), then role and text for repeated numbers. The table is bucketed by seg, so the texts are shuffled
    this once; what follows moves hashes and counts only. key names a conversation and is never null.
    """
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit("user")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    t = t.withColumns({"key": named("conv"), "block": F.coalesce(F.floor(F.col("turn") / BLOCK).cast("long"), F.lit(-(1 << 62)).cast("long"))})
    t = t.withColumn("seg", F.concat_ws(" ", "key", F.col("block").cast("string"))).repartition(n, "seg")
    t = t.withColumn("row", F.row_number().over(Window.partitionBy("seg").orderBy("turn", "role", "text")) - 1).withColumn("part", F.floor(F.col("row") / BLOCK).cast("int"))
    hashes = [F.xxhash64(F.lit(seed), "role", "text").alias(name) for seed, name in (("a", "ha"), ("b", "hb"))]
    rows = t.groupBy("seg", "part", "block", "conv", "key").agg(F.array_sort(F.collect_list(F.struct("row", "role", "text", *hashes))).alias("lines"))
    rows = rows.select("seg", "part", "block", "conv", "key", F.transform("lines", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("lines"), F.col("lines.ha").alias("ha"), F.col("lines.hb").alias("hb"))
    return bucketed(rows, "turns", "seg", compression="zstd", placed=True)


def named(conv: str) -> Column:
    """A conversation's id as a text that is never null."""
    return F.coalesce(F.concat(F.lit("v"), F.col(conv).cast("string")), F.lit("n"))


def index(segs: DataFrame) -> DataFrame:
    """(seg, block, conv, key, size, offset, first, total): where the blocks of conversations begin, in turns and in segments."""
    every = Window.partitionBy("key")
    before = every.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = segs.groupBy("seg", "block", "conv", "key").agg(F.sum(F.size("ha")).alias("size"), F.count("*").alias("pieces"))
    return written(sizes.select("seg", "block", "conv", "key", "size", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"), F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("first"), F.sum("size").over(every).alias("total")), "blocks")


def prefixes(segs: DataFrame, blocks: DataFrame) -> DataFrame:
    """(conv, pos, h1, h2, whole): the hashes of each conversation's first pos turns; whole for all of them.

    A hash of position, role and text of each turn is xor-ed along the conversation, twice with different seeds, so
    equal 128 bits mean equal prefixes. The hashes run within blocks; totals of earlier blocks are added to each.
    """
    turns = segs.select("seg", "part", F.posexplode(F.arrays_zip("ha", "hb")).alias("i", "h")).join(blocks, "seg")
    turns = turns.withColumn("pos", F.col("offset") + F.col("part") * BLOCK + F.col("i") + 1)
    run = Window.partitionBy("seg").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.bit_xor(F.xxhash64("pos", F.col("h")[h])).over(run).alias(r) for h, r in (("ha", "r1"), ("hb", "r2"))]
    runs = written(turns.select("seg", "block", "conv", "key", "pos", *sums, (F.col("pos") == F.col("total")).alias("whole"), (F.col("pos") == F.col("offset") + F.col("size")).alias("ends")), "runs")
    before = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = runs.where("ends").select("seg", *[F.bit_xor(r).over(before).alias(c) for r, c in (("r1", "c1"), ("r2", "c2"))]).where("c1 is not null")
    added = [F.col(r).bitwiseXOR(F.coalesce(F.col(c), F.lit(0).cast("long"))).alias(h) for r, c, h in (("r1", "c1", "h1"), ("r2", "c2", "h2"))]
    return runs.join(carried, "seg", "left").select("conv", "pos", *added, "whole")


def template(role: Column, text: Column) -> Column:
    """One rendered turn."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def render_maximal(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, segment, n_turns, n_copies, rendered) of the maximal conversations.

    A conversation is dropped when its turns are the first turns of a longer one; of equal ones the smallest id stays,
    and n_copies says how many there were. rendered holds the turns of one segment: at most BLOCK turn numbers and BLOCK rows;
    segments from 0 on, concatenated in order, are the conversation, and nearly all have only one. n_turns counts the whole
    conversation. Null role: user. Null text: empty. Null turn numbers come first; null ids are one conversation.
    Repeated rows are repeated turns. Equal ones are grouped with partial sums and prefixes are made distinct before the
    anti-join, so a first turn or whole conversation that very many share is one row there.
    """
    segs = stored(conversations, conv, turn, role, text)
    blocks = index(segs)
    p = prefixes(segs, blocks)
    kept = p.where("whole").groupBy("pos", "h1", "h2").agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    proper = p.where("not whole").select("pos", "h1", "h2").distinct()
    maximal = kept.join(proper, ["pos", "h1", "h2"], "left_anti").select(named("conv").alias("key"), F.col("pos").alias("n_turns"), "n_copies")
    places = blocks.join(maximal, "key").select("seg", "first", "n_turns", "n_copies")
    rendered = F.array_join(F.transform("lines", lambda x: template(x["role"], x["text"])), "")
    return segs.select("seg", "part", F.col("conv").alias("c"), "lines").join(places, "seg").select(F.col("c").alias(conv), (F.col("first") + F.col("part")).alias("segment"), F.col("n_turns").cast("long").alias("n_turns"), "n_copies", rendered.alias("rendered"))
