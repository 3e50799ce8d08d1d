"""Benchmark decontamination by spaced-seed hashing, with DataFrame operations only.

A mask picks some words of a short window and ignores the others, so a window with substituted words at ignored places
still has the same hash. Hashes of the test items meet hashes of the training texts; around each hit the two word
sequences are compared on the hit's diagonal, and the best local segment decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import written

#: Fixed masks: the places that count. At every place of a best segment more than two thirds of its words so far are equal
#: (MISMATCH), so it begins with 3 equal words, another one and 2 equal ones; with 4, another one and an equal one; with 5 and
#: another one; or with 6. One of the masks fits each of these beginnings, so every overlap is met.
MASKS = ((0, 1, 2, 4, 5), (0, 1, 2, 3, 5), (0, 1, 2, 3, 4))
#: So many words at the beginning of every mask, also of those for short items, have no gap.
START = 3
#: Shorter items are ignored; those below WHOLE words must be met word for word.
SHORTEST, WHOLE = 5, 10
#: A segment scores 1 for an equal word and this for another one.
MISMATCH = -2
#: With more seeds than this the hashes are joined by a shuffle instead of a broadcast.
BROADCAST_SEEDS = 500_000
#: With more diagonals to be verified than this, texts are shuffled to them.
BROADCAST_SHIFTS = 1_000_000


def words(text: Column) -> Column:
    """Hashes of the lower-case words; empty for null."""
    split = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(split, lambda w: F.xxhash64(w))


def seed(mask_id: Column | int, mask: tuple[int, ...], hashes: Column, at: Column) -> Column:
    return F.xxhash64(F.lit(mask_id), *[F.get(hashes, at + o) for o in mask])


def opening(hashes: Column, at: Column) -> Column:
    return F.xxhash64(*[F.get(hashes, at + o) for o in range(START)])


def placed(df: DataFrame, keys: list[str], words_: str, masks: list[tuple[int, ...]], spans: list[int], fits: list[Column]) -> DataFrame:
    """(keys, h, before, at): the hash of each mask at each place that it fits, and that of the same mask one place before. Words aren't carried along."""

    def hashes(k: int) -> Column:
        last = F.size(words_) - spans[k]
        at_each = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: seed(k, masks[k], F.col(words_), i))
        return F.when((last >= 0) & fits[k], at_each).otherwise(F.array().cast("array<bigint>"))

    def places(k: int) -> Column:
        return F.transform(f"_h{k}", lambda h, i: F.struct(h.alias("h"), F.when(i > 0, F.get(F.col(f"_h{k}"), i - 1)).alias("before"), i.alias("at")))

    hashed = df.select(*keys, *[hashes(k).alias(f"_h{k}") for k in range(len(masks))])
    return hashed.select(*keys, F.explode(F.concat(*[places(k) for k in range(len(masks))])).alias("_p")).select(*keys, "_p.*")


def needed(size: Column) -> Column:
    """Equal words that make an overlap with an item of so many words."""
    return F.when(size < WHOLE, size).otherwise(F.greatest(F.lit(8), F.least(F.lit(13), F.ceil(size * 0.6).cast("int"))))


def best_segment(doc: Column, item: Column, shift: Column) -> Column:
    """Equal words of the best-scoring local segment where word q of the item lies on word q + shift of the text."""
    low, high = F.greatest(F.lit(0), -shift), F.least(F.size(item), F.size(doc) - shift) - 1
    zero = F.struct(F.lit(0).alias("s"), F.lit(0).alias("m"), F.lit(0).alias("bs"), F.lit(0).alias("bm"))

    def step(a: Column, q: Column) -> Column:
        same = F.get(item, q) == F.get(doc, q + shift)
        s, m = a["s"] + F.when(same, 1).otherwise(MISMATCH), a["m"] + F.when(same, 1).otherwise(0)
        s, m = F.greatest(s, F.lit(0)), F.when(s > 0, m).otherwise(0)
        return F.struct(s.alias("s"), m.alias("m"), F.greatest(a["bs"], s).alias("bs"), F.when(s > a["bs"], m).otherwise(a["bm"]).alias("bm"))

    return F.aggregate(F.sequence(low, high), zero, step, lambda a: a["bm"])


def overlaps(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """(key, item, matched, item_words): each text and item with a verified overlap, and its equal words.

    matched has to reach 60 % of the item's words, 8 at least and 13 at most, within one segment in which a substituted
    word costs two equal ones; items of 5 to 9 words have to be met whole, shorter and null ones are ignored. Texts that
    are null or empty overlap with nothing. Repeated rows of a text or item give one row. A text is compared where a hash
    meets, so the passage that very many texts share costs each of them the same, and nothing is grouped by it.
    """
    it = items.select(F.col(item_key).alias("item"), words(F.col(item_text)).alias("iw")).where(F.size("iw") >= SHORTEST).distinct()
    short = sorted(r["n"] for r in it.where(F.size("iw") < WHOLE).select(F.size("iw").alias("n")).distinct().collect())  # at most five lengths
    masks = [*MASKS, *[tuple(range(n)) for n in short]]
    spans = [*[m[-1] + 1 for m in MASKS], *short]
    fits = [*[F.size("iw") >= WHOLE] * len(MASKS), *[F.size("iw") == n for n in short]]
    seeds = placed(it, ["item"], "iw", masks, spans, fits).withColumnsRenamed({"at": "j", "before": "item_before"})
    sizes = it.agg(F.coalesce(F.sum(F.size("iw")), F.lit(0)).alias("n")).first()["n"] * len(masks)
    small = sizes <= broadcast_seeds

    # Texts are known by what they hold, so that those with a null key, or several with one key, are not lost or mixed up.
    d = docs.select(F.col(key).alias("key"), words(F.col(text)).alias("dw")).withColumn("row", F.xxhash64("key", "dw"))
    at = d.select("row", "dw", F.posexplode_outer("dw").alias("at", "_w")).where(F.col("at") <= F.size("dw") - min(spans))
    if small:
        # Every mask begins with the same words: places whose first words begin no seed leave before any mask is hashed.
        firsts = it.select("iw", F.explode(F.sequence(F.lit(0), F.size("iw") - START)).alias("j")).select(opening(F.col("iw"), F.col("j")).alias("first")).distinct()
        at = at.withColumn("first", opening(F.col("dw"), F.col("at"))).join(F.broadcast(firsts), "first", "left_semi")
    hashed = lambda k, place: seed(k, masks[k], F.col("dw"), place)
    here, back = F.col("at"), F.col("at") - 1
    each = [F.when(here <= F.size("dw") - spans[k], F.struct(hashed(k, here).alias("h"), F.when(here > 0, hashed(k, back)).alias("before"))) for k in range(len(masks))]
    places = at.select("row", "at", F.explode(F.array(*each)).alias("_p")).select("row", "at", "_p.h", "_p.before").where("h is not null")
    # Hits that follow each other on a diagonal say the same: the first of them is enough, however often a text repeats itself.
    met = places.join(F.broadcast(seeds) if small else seeds, "h").where(~F.coalesce(F.col("before") == F.col("item_before"), F.lit(False)))
    pairs = met.select("row", "item", (F.col("at") - F.col("j")).alias("shift")).distinct().groupBy("row", "item").agg(F.collect_list("shift").alias("shifts"))
    pairs = written(pairs, "pairs")
    few = pairs.agg(F.coalesce(F.sum(F.size("shifts") + 4), F.lit(0)).alias("n")).first()["n"] <= BROADCAST_SHIFTS
    # Each text comes once to each item that it may hold.
    both = d.join(F.broadcast(pairs) if few else pairs, "row").join(F.broadcast(it) if small else it, "item")
    # A diagonal that is too short to beat the best one so far isn't compared.
    room = lambda shift: F.least(F.size("iw"), F.size("dw") - shift) - F.greatest(F.lit(0), -shift)
    matched = F.aggregate("shifts", F.lit(0), lambda best, shift: F.when(room(shift) <= best, best).otherwise(F.greatest(best, best_segment(F.col("dw"), F.col("iw"), shift))))
    found = both.select("key", "item", F.size("iw").alias("item_words"), matched.alias("matched"))
    best = found.where(F.col("matched") >= needed(F.col("item_words"))).groupBy("key", "item").agg(F.max("matched").alias("matched"), F.max("item_words").alias("item_words"))
    return best.select(F.col("key").alias(key), F.col("item").alias("item_id"), "matched", "item_words")
