"""Streams over the given tables, replayed until all that is there is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.operators import tables
from opslake.plans.fixtures import BASES, oracle, spark_sql
from opslake.plans.registry import ORACLES, query, table
from opslake.sources.scratch import folder
from opslake.sources.store import TableStore
from opslake.streaming import jobs

#: The tables are replayed in the order of their files, whatever times these hold: so lateness spans them all.
LATE = "20000 days"


def stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A table's files, as a pattern, since it may be a single file as well as a folder."""
    return spark.readStream.schema(table(spark, d, name).schema).parquet(f"{d}/{name}.parque[t]")


def stream_fixture(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A fixture of one table as a stream."""
    (base,) = BASES[name]
    return spark.sql(spark_sql(name).replace(f"FROM {base}", f"FROM {{{base}}}"), **{base: stream(spark, d, base)})


def appended(df: DataFrame, name: str) -> DataFrame:
    """What the stream has written when all is read."""
    spark = df.sparkSession
    path = folder(spark, name)
    jobs.drain(df, name, f"{path}/checkpoint", path=f"{path}/rows")
    return spark.read.schema(df.schema).parquet(f"{path}/rows")


def stored(df: DataFrame, name: str, each=None, mode: str = "update") -> DataFrame:
    """The table that the micro-batches have left. each(store): what a batch does; by default it is the new table."""
    path = folder(df.sparkSession, name)
    store = TableStore(df.sparkSession, f"{path}/table")
    jobs.drain(df, name, f"{path}/checkpoint", mode, each(store) if each else store.swap)
    return store.read()


def events(spark, d):
    return stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_daily_counts", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, d):
    return stored(jobs.daily_counts(events(spark, d), "ts", "event_type"), "daily", mode="complete")


@query("stream_deduplicated", "SELECT event_id, user_id, event_type FROM events")
def _(spark, d):
    twice = events(spark, d).union(events(spark, d))  # extraction windows that overlap as a whole
    return appended(jobs.deduplicated(twice, ["event_id"], "ts", LATE).select("event_id", "user_id", "event_type"), "deduplicated")


@query("stream_upsert", "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def _(spark, d):
    each = lambda store: jobs.upsert_batches(["user_id"], "ts", store.read, store.swap)
    return stored(events(spark, d).select("user_id", "event_id", "event_type", "value", "ts"), "upsert", each, "append").drop("ts")


TRANSITIONS = """SELECT user_id, before AS from_state, event_type AS to_state, ts AS "at", round((epoch_us(ts) - epoch_us(since)) / 60e6, 2) AS minutes FROM (
  SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS since FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS before FROM events) WHERE before IS NULL OR event_type <> before) WHERE before IS NOT NULL"""


@query("stream_transitions", TRANSITIONS)
def _(spark, d):
    return appended(jobs.transitions(events(spark, d), "user_id", "event_type", "ts"), "transitions").withColumn("at", F.col("at").cast("timestamp_ntz"))


@query("stream_recent_days", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) FROM events) - 2 GROUP BY 1")
def _(spark, d):
    whole = table(spark, d, "events")
    count = lambda t: t.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    each = lambda store: jobs.recompute_days(2, "ts", lambda: whole, count, lambda df, batch: store.swap(newest(store, df), batch))
    return stored(events(spark, d), "recent", each, "append")


def newest(store: TableStore, days: DataFrame) -> DataFrame:
    """The recomputed days, or those of an earlier batch that go further."""
    old = store.read()
    if old is None:
        return days
    last = days.agg(F.max("day")).first()[0]
    return days if last is None or old.where(F.col("day") > F.lit(last)).limit(1).count() == 0 else old


@query("stream_ingestion_lag", ORACLES["dq_ingestion_lag"])
def _(spark, d):
    rows = stream_fixture(spark, d, "incidents").select(F.col("opened_at").cast("timestamp").alias("opened_at"), F.col("ingestion_ts").cast("timestamp").alias("ingestion_ts"), (F.col("incident_number") % 10).alias("batch"))
    # A last record far behind all others closes every hour before it.
    closing = spark.sql("SELECT TIMESTAMP '9000-01-01 00:00:00' AS opened_at, TIMESTAMP '9000-01-01 00:00:00' AS ingestion_ts, CAST(0 AS BIGINT) AS batch")
    mark = folder(spark, "closing")
    closing.write.parquet(mark)
    closed = rows.unionByName(spark.readStream.schema(closing.schema).parquet(mark))
    return appended(jobs.hourly_lag(closed, "opened_at", "ingestion_ts", "batch", LATE), "lag").withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query("stream_snapshot", oracle(" SELECT state, count(*) AS n FROM incidents WHERE state <> 'Closed' GROUP BY 1", "incidents"))
def _(spark, d):
    view = lambda: tables.latest(spark.sql(spark_sql("incidents").replace("FROM orders", "FROM {orders}"), orders=table(spark, d, "orders")), ["incident_number"], F.desc("ingestion_ts")).where("state <> 'Closed'").groupBy("state").agg(F.count("*").alias("n"))
    return stored(stream(spark, d, "orders"), "snapshot", lambda store: jobs.snapshots(view, store.swap), "append")


JOINED = """ SELECT c.conversation_id * 10 + c.participant_id AS call_id, incident_number FROM participants c JOIN (SELECT *, coalesce(resolved_at, opened_at + INTERVAL 30 DAY) AS ended_at FROM outages) i ON upper(c.vendor) = upper(i.vendor)
  AND opened_at <= end_ts + INTERVAL 1 HOUR AND ended_at >= start_ts - INTERVAL 1 HOUR WHERE error_code IS NOT NULL"""


def landed(df: DataFrame, name: str) -> DataFrame:
    """What a stream has brought, with the number of its batch."""
    spark = df.sparkSession
    path = folder(spark, name)
    jobs.landed(f"{path}/rows")(spark.createDataFrame([], df.schema), -1)  # there are rows to read, even if no batch ever comes
    jobs.drain(df, name, f"{path}/checkpoint", each=jobs.landed(f"{path}/rows"))
    return spark.read.schema(df.schema.add("batch", "long")).parquet(f"{path}/rows")


@query("stream_call_incidents", oracle(JOINED, "participants", "outages"))
def _(spark, d):
    c = stream_fixture(spark, d, "participants").where("error_code is not null").select((F.col("conversation_id") * 10 + F.col("participant_id")).alias("call_id"), "vendor", "start_ts", "end_ts")
    i = stream_fixture(spark, d, "outages").select("incident_number", "vendor", "opened_at", F.coalesce("resolved_at", F.expr("opened_at + INTERVAL 30 DAYS")).alias("ended_at"))
    return jobs.new_pairs(landed(c, "calls"), landed(i, "outages"))
