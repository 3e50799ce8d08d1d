"""Table mutation without a table format: results are new DataFrames, to be written and swapped by the caller."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the order; give a full tie-break."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], newer: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """target with source's rows: new keys are inserted, known ones updated where `newer` is larger in source (always without it).

    columns: those that an update sets; all by default. Null keys are equal. Keys are unique in the target; a key that source repeats
    raises an error when the result is computed, instead of multiplying rows.
    """
    once = F.when(F.count("*").over(Window.partitionBy(*keys)) > 1, F.raise_error(F.lit(f"the source repeats a key of {', '.join(keys)}")).cast("boolean")).otherwise(F.lit(True))
    s = source.select([F.col(c).alias(f"_s_{c}") for c in source.columns] + [once.alias("_in_s")])
    t = target.withColumn("_in_t", F.lit(True))
    joined = t.join(s, reduce(lambda a, b: a & b, [t[k].eqNullSafe(s[f"_s_{k}"]) for k in keys]), "full_outer")
    update = F.col("_in_s").isNotNull() & (F.lit(True) if newer is None else F.coalesce(F.col(f"_s_{newer}") > F.col(newer), F.lit(False)))
    set_ = set(columns or source.columns)
    out = []
    for c in target.columns:
        new = F.col(f"_s_{c}") if c in source.columns else F.lit(None).cast(target.schema[c].dataType)
        kept = F.when(update, new).otherwise(F.col(c)) if c in set_ and c not in keys else F.col(c)
        out.append(F.when(F.col("_in_t").isNull(), new).otherwise(kept).alias(c))
    return joined.select(out)


def replace_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Update-all, insert-all."""
    new = source.select([F.col(k).alias(f"_s_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys])
    return target.join(new, same, "left_anti").unionByName(source, allowMissingColumns=True)


def merge_available(target: DataFrame, source: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """Update and insert by whatever columns both sides have: technical ones (leading underscore) only with inserts, _processed_at anew."""
    out = upsert(target, source, keys, columns=[c for c in source.columns if c in target.columns and not c.startswith("_")])
    touched = source.select([F.col(k).alias(f"_s_{k}") for k in keys] + [F.lit(True).alias("_hit")])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys])
    return out.join(touched, same, "left").withColumn("_processed_at", F.when(F.col("_hit"), now).otherwise(F.col("_processed_at"))).select(target.columns)


def since_watermark(raw: DataFrame, column: str, processed: DataFrame, mark: str, default: str = "1970-01-01") -> DataFrame:
    """Rows that came in after the latest processed ones; the mark is one value, so the filter reaches the scan."""
    last = processed.agg(F.max(mark)).first()[0]
    return raw.where(F.col(column) > (F.lit(last) if last is not None else F.lit(default).cast(raw.schema[column].dataType)))

def delete_stale(target: DataFrame, recomputed: DataFrame, keys: list[str], in_window: Column) -> DataFrame:
    """Rows of the window whose key is no longer in the recomputed set go; rows outside it stay."""
    stale = target.where(in_window).join(recomputed.select(keys), keys, "left_anti").select(keys)
    return target.join(stale, keys, "left_anti")


def scd2(current: DataFrame, profiles: DataFrame, key: str, tracked: list[str], today: Column) -> DataFrame:
    """Slowly changing dimension: changed current rows are expired today, changed and new profiles start today."""
    c = current.where("is_current").select(F.col(key), *[F.col(x).alias(f"_c_{x}") for x in tracked], F.lit(True).alias("_known"))
    p = profiles.join(c, key, "left")
    differs = reduce(lambda a, b: a | b, [~F.col(x).eqNullSafe(F.col(f"_c_{x}")) for x in tracked])
    news = p.where(F.col("_known").isNull() | differs).select(key, *tracked)
    changed = current.join(news.select(key).withColumn("_hit", F.lit(True)), key, "left")
    hit = F.col("is_current") & F.col("_hit").isNotNull()
    expired = changed.select(key, *tracked, "effective_from", F.when(hit, today).otherwise(F.col("effective_to")).alias("effective_to"), F.when(hit, False).otherwise(F.col("is_current")).alias("is_current"))
    fresh = news.select(key, *tracked, today.alias("effective_from"), F.to_date(F.lit("9999-12-31")).alias("effective_to"), F.lit(True).alias("is_current"))
    return expired.unionByName(fresh)


def rebuild_touched(target: DataFrame, history: DataFrame, batch: DataFrame, key: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """target with the rows of every key that a batch touches built anew from the key's whole history, so that an incremental run equals a full one.

    history: all source rows, those of the batch included. Keys that the batch doesn't touch aren't read from it but to be passed over; a key that
    builds no rows any more is gone. Null is a key.
    """
    touched = batch.select(F.col(key).alias("_touched")).distinct()
    hit = F.col(key).eqNullSafe(F.col("_touched"))
    return target.join(touched, hit, "left_anti").unionByName(build(history.join(touched, hit, "left_semi")))


def dimension_history(observed: DataFrame, key: str, ts: str, tracked: list[str]) -> DataFrame:
    """(key, tracked, effective_from, effective_to, is_current): all versions of each key's profile, from its rows in time.

    A day has its latest profile (of several at one time the largest); days in a row with the same profile, also null ones, are one version,
    which is valid until the next one begins. Rows without a key or time have no profile.
    """
    day, profile = F.to_date(ts), F.struct(*tracked)
    daily = observed.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(key, day.alias("effective_from")).agg(F.max(F.struct(F.col(ts).alias("_ts"), profile.alias("_p"))).alias("_last"))
    w = Window.partitionBy(key).orderBy("effective_from")
    daily = daily.select(key, "effective_from", "_last._p").withColumn("_before", F.lag("_p").over(w))
    versions = daily.where(F.col("_before").isNull() | ~F.col("_p").eqNullSafe(F.col("_before")))
    ends = versions.withColumn("_next", F.lead("effective_from").over(w))
    return ends.select(key, "_p.*", "effective_from", F.coalesce("_next", F.to_date(F.lit("9999-12-31"))).alias("effective_to"), F.col("_next").isNull().alias("is_current"))


def latest_profiles(observed: DataFrame, key: str, ts: str, tracked: list[str]) -> DataFrame:
    """(key, tracked): each key's profile at its latest time (of several the largest), for scd2()."""
    last = observed.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(F.col(ts), F.struct(*tracked).alias("_p"))).alias("_last"))
    return last.select(key, "_last._p.*")


def chunk_plan(events: DataFrame, ts: str, start: str, hours: float = 24.0, least_hours: float = 0.75, cap: int = 1000) -> DataFrame:
    """Time chunks of a source: those with `cap` events or more are halved until the least width. (width_hours, bin, n)."""
    epoch = F.unix_timestamp(F.col(ts).cast("timestamp")) - F.unix_timestamp(F.lit(start).cast("timestamp"))
    widths = []
    while hours >= least_hours:
        widths.append(hours)
        hours /= 2
    last = len(widths) - 1
    counted = events.groupBy(F.floor(epoch / (widths[-1] * 3600)).alias("fine")).agg(F.count("*").alias(f"n{last}"))
    # Of the events only the finest counts are shuffled; every fine bin learns those of the wider bins around it.
    wider = lambda level: F.floor(F.col("fine") / (1 << (last - level)))
    for level in range(last):
        counted = counted.withColumn(f"n{level}", F.sum(f"n{last}").over(Window.partitionBy(wider(level))))
    bins = [F.struct(F.lit(w).alias("width_hours"), wider(i).alias("bin"), F.col(f"n{i}").alias("n")) for i, w in enumerate(widths)]
    leaf = F.coalesce(*[F.when(F.col(f"n{i}") < cap, b) for i, b in enumerate(bins[:-1])], bins[-1])
    return counted.select(leaf.alias("leaf")).distinct().select("leaf.*")
