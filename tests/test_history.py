"""Operators over histories: transitions, rebuilt keys, dimensions, guarded upserts, business hours."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opslake.functions import rules
from opslake.operators import calls, incidents, tables


def test_transitions_of_one_batch_all_come_out(spark):
    t = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    rows = [(1, "New", t(0)), (1, "New", t(5)), (1, "Open", t(10)), (1, None, t(30)), (1, None, t(31)), (1, "Open", t(40)), (2, None, t(0)), (2, "New", t(90)), (3, "New", t(1)), (None, "New", t(1)), (None, "Open", t(2))]
    df = spark.createDataFrame(rows, "incident_number int, state string, ingestion_ts timestamp_ntz").repartition(3)
    got = sorted(((r["incident_number"], r["from_state"], r["to_state"], r["minutes"]) for r in incidents.transitions(df).collect()), key=repr)
    assert got == sorted([(1, "New", "Open", 10.0), (1, "Open", None, 20.0), (1, None, "Open", 10.0), (2, None, "New", 90.0)], key=repr)
    assert incidents.transitions(df.limit(0)).count() == 0


def test_a_source_that_repeats_a_key_is_refused(spark):
    target = spark.createDataFrame([(1, "a", 1), (None, "n", 1)], "k int, v string, ts int")
    for twice in ([(1, "b", 2), (1, "c", 3)], [(None, "b", 2), (None, "c", 3)], [(9, "b", 2), (9, "c", 3)]):
        with pytest.raises(Exception, match="the source repeats a key of k"):
            tables.upsert(target, spark.createDataFrame(twice, "k int, v string, ts int"), ["k"], newer="ts").collect()
    once = tables.upsert(target, spark.createDataFrame([(None, "m", 2), (2, "c", 3)], "k int, v string, ts int"), ["k"], newer="ts")
    assert sorted(map(tuple, once.collect()), key=repr) == sorted([(1, "a", 1), (None, "m", 2), (2, "c", 3)], key=repr)


PARTICIPANTS = "conversation_id int, purpose string, participant_id int, call_status string, agent_id int, vendor string, location_key int, start_ts timestamp, end_ts timestamp"


def test_an_incremental_run_equals_a_full_one(spark):
    r = random.Random(3)
    t = datetime(2024, 1, 1)
    rows = [(r.choice([*range(40), None]), r.choice(["agent", "customer"]), k, r.choice(["NORMAL", "DEGRADED", "ERRORED"]), r.randrange(5), "v", 1, t, t + timedelta(minutes=k)) for k in range(200)]
    for build in (calls.conversation_rollup, calls.agent_legs):
        known = spark.createDataFrame([], PARTICIPANTS)
        table = build(known)
        for n in range(0, 200, 50):  # four batches; conversations get participants in several of them
            batch = spark.createDataFrame(rows[n : n + 50], PARTICIPANTS)
            known = spark.createDataFrame(rows[: n + 50], PARTICIPANTS)
            table = spark.createDataFrame(tables.rebuild_touched(table, known, batch, "conversation_id", build).collect(), table.schema)
            again = tables.rebuild_touched(table, known, batch, "conversation_id", build)
            assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, table.collect()), key=repr) == sorted(map(tuple, build(known).collect()), key=repr)


def test_dimension(spark):
    d = lambda n, h=0: datetime(2024, 1, n, h)
    rows = [(1, d(1), "A", 1), (1, d(1, 5), "B", 1), (1, d(2), "B", 1), (1, d(4), None, 1), (1, d(6), "B", 1), (2, d(3), None, None), (2, d(5), None, None), (None, d(1), "A", 1), (3, None, "A", 1)]
    observed = spark.createDataFrame(rows, "agent_id int, start_ts timestamp_ntz, division string, location int")
    end = date(9999, 12, 31)
    got = sorted(map(tuple, tables.dimension_history(observed, "agent_id", "start_ts", ["division", "location"]).collect()), key=repr)
    want = [(1, "B", 1, date(2024, 1, 1), date(2024, 1, 4), False), (1, None, 1, date(2024, 1, 4), date(2024, 1, 6), False), (1, "B", 1, date(2024, 1, 6), end, True), (2, None, None, date(2024, 1, 3), end, True)]
    assert got == sorted(want, key=repr)
    # A second run over the same history changes nothing, although agent 1 has had three profiles.
    latest = tables.latest_profiles(observed.where("start_ts is not null"), "agent_id", "start_ts", ["division", "location"])
    first = latest.select("*", F.lit(date(2024, 1, 7)).alias("effective_from"), F.lit(end).alias("effective_to"), F.lit(True).alias("is_current"))
    second = tables.scd2(first.select("agent_id", "division", "location", "effective_from", "effective_to", "is_current"), latest, "agent_id", ["division", "location"], F.lit(date(2024, 2, 1)))
    assert sorted(map(tuple, second.collect()), key=repr) == sorted(map(tuple, first.collect()), key=repr)
    assert second.count() == 2


def test_business_minutes_equal_a_count_of_minutes(spark):
    def plain(a, b):
        n = 0
        while a < b:
            n += a.weekday() < 5 and 9 * 60 <= a.hour * 60 + a.minute < 18 * 60
            a += timedelta(minutes=1)
        return float(n)

    r = random.Random(1)
    start = datetime(2023, 12, 20)
    pairs = [(a := start + timedelta(minutes=r.randrange(40_000)), a + timedelta(minutes=r.choice([0, 1, 59, 600, 1440, 5000, 20_000]))) for _ in range(60)]
    pairs += [(datetime(1969, 12, 31, 12), datetime(1970, 1, 6, 10)), (datetime(2024, 1, 6), datetime(2024, 1, 8, 9)), (datetime(2024, 1, 5, 17, 59), datetime(2024, 1, 8, 9, 1))]
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    both = df.select("a", "b", rules.business_minutes(F.col("a"), F.col("b")).alias("n"), rules.business_minutes(F.col("b"), F.col("a")).alias("back")).collect()
    assert [(x["n"], -x["back"]) for x in both] == [(plain(x["a"], x["b"]),) * 2 for x in both]
    half = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-08 09:00:30' AS a, TIMESTAMP_NTZ '2024-01-08 09:02:00' AS b, CAST(NULL AS TIMESTAMP_NTZ) AS c")
    assert tuple(half.select(rules.business_minutes(F.col("a"), F.col("b")), rules.business_minutes(F.col("a"), F.col("c"))).first()) == (1.5, None)


def test_worst_session_of_a_participant_counts(spark):
    t = datetime(2024, 1, 1)
    rows = [(1, "agent", 1, t, 4.2, None, 7, "v", t), (1, "agent", 1, t, 1.5, None, 7, "v", t), (1, "agent", 1, t, None, None, 7, "v", t)]
    df = spark.createDataFrame(rows, "conversation_id int, purpose string, participant_id int, ingestion_ts timestamp, mos double, error_code string, agent_id int, vendor string, start_ts timestamp")
    assert [(r["mos"], r["call_status"]) for r in calls.participants_latest(df).collect()] == [(1.5, "ERRORED")]
