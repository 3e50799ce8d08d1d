"""The table store under failures and repeats, and streams into it."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opslake.sources.store import TableStore
from opslake.streaming import jobs


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_failed_and_repeated_batches_change_nothing(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/t")
    assert store.read() is None and store.state() is None
    one, two = (spark.createDataFrame([(k, "x")], "k int, v string") for k in (1, 2))
    assert store.swap(one, 0)
    reader = store.read()
    with pytest.raises(Exception, match="broken"):
        store.swap(two.withColumn("v", F.raise_error(F.lit("broken"))), 1)
    assert rows(store.read()) == [(1, "x")] and store.state()["batch"] == 0
    assert store.swap(two, 1)
    assert not store.swap(one, 1) and not store.swap(one, 0)
    assert rows(store.read()) == [(2, "x")] and rows(reader) == [(1, "x")]
    # Another writer over the same path goes on from the pointer.
    again = TableStore(spark, f"file://{tmp_path}/t")
    assert again.state() == store.state() and again.swap(one.limit(0), 2)
    assert rows(store.read()) == []
    assert again.vacuum() >= 2
    assert rows(again.read()) == [] and again.vacuum() == 0


def test_a_stream_that_fails_goes_on_where_it_was(spark, tmp_path):
    for n, batch in enumerate([[(1, "a", 1), (2, "b", 1)], [(1, "c", 2)], [(1, "late", 1), (3, "d", 9)]]):
        spark.createDataFrame(batch, "k int, v string, ts int").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    store = TableStore(spark, f"file://{tmp_path}/t")
    merge = jobs.upsert_batches(["k"], "ts", store.read, store.swap)
    failed = []

    def each(df, batch):
        merge(df, batch)
        if batch == 1 and not failed:  # after the table was swapped, before the checkpoint was written
            failed.append(batch)
            raise RuntimeError("lost")

    def run():
        stream = spark.readStream.schema("k int, v string, ts int").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        jobs.drain(stream, "merge", f"{tmp_path}/c", "append", each)

    with pytest.raises(Exception, match="lost"):
        run()
    before = store.state()
    run()
    assert failed == [1] and store.state()["batch"] == before["batch"] + 1
    assert rows(store.read()) == [(1, "c", 2), (2, "b", 1), (3, "d", 9)]


def test_hours_come_out_once_they_are_closed(spark, tmp_path):
    t = lambda h, m=0: datetime(2024, 1, 1) + timedelta(hours=h, minutes=m)
    batches = [[(t(0), t(1), 1), (t(0), t(1, 10), 1), (t(0), t(1, 30), 2)], [(t(1), t(1, 50), 2), (t(2), t(8), 1)]]
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, "e timestamp, i timestamp, b int").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    stream = spark.readStream.schema("e timestamp, i timestamp, b int").option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    got = []
    jobs.drain(jobs.hourly_lag(stream, "e", "i", "b"), "lag", f"{tmp_path}/c", "append", lambda df, b: got.extend(map(tuple, df.collect())))
    assert got == [(t(1), 4, 2, 67.5)]


def test_two_streams_meet(spark, tmp_path):
    t = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    calls = [(1, "Acme", t(100), t(101)), (2, "acme", t(100), t(102)), (3, None, t(100), t(101)), (4, "Beta", t(100), t(101))]
    outages = [(7, "ACME", t(90), t(99)), (8, "ACME", t(103), t(200)), (9, "acme", t(0), t(98)), (10, None, t(90), t(300))]
    spark.createDataFrame(calls, "call_id int, vendor string, start_ts timestamp, end_ts timestamp").write.parquet(f"{tmp_path}/calls")
    spark.createDataFrame(outages, "incident_number int, vendor string, opened_at timestamp, ended_at timestamp").write.parquet(f"{tmp_path}/outages")
    read = lambda name: spark.readStream.schema(spark.read.parquet(f"{tmp_path}/{name}").schema).parquet(f"{tmp_path}/{name}")
    got = []
    jobs.drain(jobs.active_incidents(read("calls"), read("outages")), "meet", f"{tmp_path}/c", "append", lambda df, b: got.extend(map(tuple, df.collect())))
    assert sorted(got) == [(1, 7), (2, 7), (2, 8)]
