"""Structured Streaming forms of the batch operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from opslake.operators import correlation
from opslake.operators.tables import latest, upsert

#: Days of the blocks by which landed calls and incidents meet.
BLOCK = 8


def daily_counts(events: DataFrame, ts: str, *dims: str, late: str = "2 days") -> DataFrame:
    """Events by day and dimensions; days that are older than the watermark are final."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, "1 day").alias("w"), *dims).agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("day"), *dims, "n")


def deduplicated(events: DataFrame, keys: list[str], ts: str, late: str = "10 minutes") -> DataFrame:
    """Overlapping extraction windows deliver rows twice; each is kept once."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def upsert_batches(keys: list[str], newer: str, read: Callable[[], DataFrame | None], swap: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: merges the newest row of each key of a micro-batch into the table. swap(table, batch id) must be idempotent."""

    def run(batch: DataFrame, batch_id: int) -> None:
        new = latest(batch, keys, F.col(newer).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in batch.columns if c not in keys and c != newer])
        old = read()
        swap(new if old is None else upsert(old, new, keys, newer=newer), batch_id)

    return run


def transitions(updates: DataFrame, key: str, state: str, ts: str) -> DataFrame:
    """(key, from_state, to_state, at, minutes) for each change of a key's state, over all micro-batches; null is a state, the first state no change.

    Rows of one batch are taken in the order of ts; one last state for each key is kept between batches.
    """
    kind = updates.schema[key].dataType.simpleString()

    def run(k: tuple, batches: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values([ts, state], kind="stable")
        known, (last, since) = kept.exists, kept.get if kept.exists else (None, None)
        out = []
        for s, t in zip(rows[state], rows[ts], strict=True):
            s, t = None if pd.isna(s) else s, int(t.value // 1000)
            if known and s != last:
                out.append((k[0], last, s, pd.Timestamp(t, unit="us"), round((t - since) / 60e6, 2)))
            if not known or s != last:
                last, since, known = s, t, True
        kept.update((last, since))
        yield pd.DataFrame(out, columns=["key", "from_state", "to_state", "at", "minutes"])

    schema = f"key {kind}, from_state string, to_state string, at timestamp, minutes double"
    grouped = updates.select(F.col(key), F.col(state).cast("string"), F.col(ts).cast("timestamp")).groupBy(key)
    return grouped.applyInPandasWithState(run, schema, "last string, since long", "append", GroupStateTimeout.NoTimeout).withColumnRenamed("key", key)


def hourly_lag(records: DataFrame, event: str, ingested: str, batch: str, late: str = "2 hours") -> DataFrame:
    """(hour, records, batches, avg_lag_minutes) by hour of ingestion, each hour once it is older than the watermark.

    Two stateful steps: records by hour and batch, then the batches of an hour. So an hour's batches are distinct without their records being kept.
    """
    lag = (F.unix_micros(F.col(ingested)) - F.unix_micros(F.col(event))) / 60e6
    rows = records.select(F.col(ingested), F.col(batch).alias("_batch"), lag.alias("_lag")).withWatermark(ingested, late)
    of_batch = rows.groupBy(F.window(ingested, "1 hour").alias("w"), "_batch").agg(F.count("*").alias("n"), F.sum("_lag").alias("lag"))
    hours = of_batch.groupBy(F.window(F.window_time("w"), "1 hour").alias("w")).agg(F.sum("n").alias("records"), F.count("_batch").alias("batches"), F.sum("lag").alias("lag"))
    return hours.select(F.col("w.start").alias("hour"), "records", "batches", F.round(F.col("lag") / F.col("records"), 2).alias("avg_lag_minutes"))


def active_incidents(calls: DataFrame, incidents: DataFrame, hours: int = 1, longest_days: int = 15, late: str = "1 day") -> DataFrame:
    """(call_id, incident_number) of two streams: calls with the incidents of their vendor that were active meanwhile, the call widened by some hours.

    For alerts, where a bounded state counts for more than all pairs; landed() and new_pairs() leave none out. calls: (call_id, vendor, start_ts, end_ts), incidents: (incident_number, vendor, opened_at, ended_at). Incidents of more than longest_days
    are found by calls until that many days after their opening only: that bounds what both sides have to keep.
    """
    pad, longest, block = F.expr(f"INTERVAL {hours} HOURS"), F.expr(f"INTERVAL {longest_days} DAYS"), max(1, longest_days // 4) * 86_400
    opened, until = F.col("start_ts") - longest, F.least(F.col("end_ts") + pad, F.col("start_ts") + longest)
    # Both sides meet by vendor and block of days: an incident lies in the block of its opening, a call in each in which its incidents may have been opened.
    at = lambda ts: F.floor(F.unix_seconds(ts) / block)
    c = calls.withColumn("_key", F.upper("vendor")).withWatermark("start_ts", late).where(until >= opened).withColumn("_block", F.explode(F.sequence(at(opened), at(until))))
    i = incidents.select("incident_number", F.upper("vendor").alias("_ikey"), "opened_at", "ended_at", at(F.col("opened_at")).alias("_iblock")).withWatermark("opened_at", late)
    near = (F.col("opened_at") >= F.col("start_ts") - longest) & (F.col("opened_at") <= F.col("end_ts") + pad)
    # A call's length is bounded too, else its opening side could never be forgotten.
    short = F.col("opened_at") <= F.col("start_ts") + longest
    meanwhile = F.col("ended_at") >= F.col("start_ts") - pad
    return c.join(i, (F.col("_key") == F.col("_ikey")) & (F.col("_block") == F.col("_iblock")) & near & short & meanwhile).select("call_id", "incident_number")


def landed(path: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: a micro-batch's rows go to a folder of their own, batch=N; a batch that is repeated replaces its own rows."""
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def new_pairs(calls: DataFrame, incidents: DataFrame, hours: int = 1, since: tuple[int, int] = (-1, -1)) -> DataFrame:
    """(call_id, incident_number) of two landed streams: calls with all incidents of their vendor that were active meanwhile, the call widened by some hours.

    since: batches of calls and of incidents; what later ones have added is returned, by default all. A pair comes up with the later one of its two rows, however
    long the incident lasts and however late a row comes in. So nothing is forgotten, no state lies in memory, and pairs, which are far more than rows, aren't kept.
    calls: (call_id, vendor, start_ts, end_ts, batch), incidents: (incident_number, vendor, opened_at, ended_at, batch).
    """
    pad, (seen_calls, seen_incidents) = F.expr(f"INTERVAL {hours} HOURS"), since
    c = calls.select("batch", "call_id", F.upper("vendor").alias("_vendor"), (F.col("start_ts") - pad).alias("_from"), (F.col("end_ts") + pad).alias("_to"))
    i = incidents.select("batch", "incident_number", F.upper("vendor").alias("_ivendor"), F.col("opened_at").alias("_opened"), F.col("ended_at").alias("_ended"))
    of = lambda c, i: correlation.met(c.drop("batch"), i.drop("batch"), BLOCK).select("call_id", "incident_number")
    batch = F.col("batch")
    pairs = of(c.where(batch > seen_calls), i)
    return pairs if seen_calls < 0 else pairs.union(of(c.where(batch <= seen_calls), i.where(batch > seen_incidents)))


def recompute_days(days: int, ts: str, read: Callable[[], DataFrame], aggregate: Callable[[DataFrame], DataFrame], swap: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: late rows change old days, so the aggregate of the last days before the batch's newest row is computed anew from the table."""

    def run(batch: DataFrame, batch_id: int) -> None:
        newest = batch.agg(F.max(F.to_date(ts))).first()[0]
        if newest is not None:
            swap(aggregate(read().where(F.to_date(ts) >= F.date_sub(F.lit(newest), days))), batch_id)

    return run


def snapshots(view: Callable[[], DataFrame], swap: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: a live snapshot is written whole in every cycle."""
    return lambda batch, batch_id: swap(view(), batch_id)


def drain(stream: DataFrame, name: str, checkpoint: str, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None, path: str | None = None) -> None:
    """Runs a stream over what is there now, then stops."""
    w = stream.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = w.foreachBatch(each).start() if each else w.format("parquet").option("path", path).start()
    q.awaitTermination()
