"""Results whose work must not grow with the product of two tables, against plain ways, and results that must not change from run to run."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opslake.operators import calls, monitoring
from opslake.streaming import jobs

TAGGED = "entity_id long, entity_type string, tags array<struct<key:string,value:string>>"


def test_app_health_by_tags(spark):
    r = random.Random(2)
    entities = [(k, r.choice(monitoring.ENTITY_TYPES), [{"key": "a", "value": str(k % 5)}, {"key": "b", "value": r.choice(["x", "y", None])}]) for k in range(60)]
    entities += [(k, "HOST", [{"key": "big", "value": "1"}] * 2) for k in range(100, 4100)]  # repeated tags count once
    entities.append((5000, "HOST", None))
    apps = [(k, r.choice(["FULL", "PARTIAL", "NOT_MONITORED"]), r.choice(["a", "b"]), r.choice(["0", "3", "x", "9", None])) for k in range(40)]
    apps += [(k, "HOSTS_ONLY", "big", "1") for k in range(1000, 5000)]
    wide = [(k, float(r.randrange(100)), r.choice([None, 50.0]), float(r.randrange(9))) for k in range(0, 4100, 3)]
    problems = [(k % 70, r.choice(["ERROR", "PERFORMANCE", "CUSTOM_ALERT"]), r.randrange(200)) for k in range(90)]
    e = spark.createDataFrame(entities, TAGGED)
    c = spark.createDataFrame(apps, "app_id long, coverage string, matched_key string, matched_value string")
    w = spark.createDataFrame(wide, "entity_id long, cpu double, memory double, failure_rate double")
    p = spark.createDataFrame(problems, "problem_id long, severity string, entity_id long")
    measures = {"HOST": ["cpu", "memory"], "SERVICE": ["failure_rate"]}, {"APPLICATION": ["failure_rate"]}
    got = monitoring.app_health(c, e, w, p, *measures)
    few = c.where("app_id < 1001")  # every application with each of its entities, for one of the large tag
    want = monitoring.group_health(monitoring.members(few, e), w, p, *measures)
    assert got.columns == want.columns
    assert sorted(map(str, got.where("app_id < 1001").collect())) == sorted(map(str, want.collect()))
    # The large tag has 16 million pairs of applications and entities.
    assert {tuple(x) for x in got.where("app_id >= 1000").groupBy("host_count").count().collect()} == {(4000, 4000)}


def test_places_over_blocks(spark):
    r = random.Random(3)
    ids = r.sample(range(300_000), 2000)
    df = spark.createDataFrame([(i, i % 3) for i in ids], "id long, rank int").withColumn("block", F.shiftright("id", 16))
    got = {x["id"]: x["place"] for x in monitoring.placed(df, ["rank", "block"], "id").collect()}
    assert got == {i: k for k, i in enumerate(sorted(ids, key=lambda i: (i % 3, i)), 1)}
    assert monitoring.placed(df.limit(0), ["rank", "block"], "id").count() == 0


def test_streams_meet_by_days(spark, tmp_path):
    r = random.Random(4)
    t = lambda m: datetime(2023, 12, 20) + timedelta(minutes=m)
    begin = [r.randrange(80_000) for _ in range(300)]
    made = [(k, r.choice(["Acme", "Beta", None]), t(b), t(b + r.choice([0, 7, 3000, 40_000]))) for k, b in enumerate(begin)]
    begin = [r.choice([r.randrange(80_000), 4320 * r.randrange(18)]) for _ in range(300)]  # also on the edges of blocks
    outages = [(k, r.choice(["ACME", "beta", None]), t(b), t(b + r.choice([0, 30, 9000, 60_000]))) for k, b in enumerate(begin)]
    made += [(900, "Edge", t(30_000), t(30_007)), (901, "Edge", t(60_000), t(60_000 + 30 * 1440))]
    outages += [(900, "EDGE", t(30_000 - 15 * 1440), t(29_940)), (901, "EDGE", t(30_067), t(30_068)), (902, "EDGE", t(30_068), t(30_069)), (903, "EDGE", t(60_000 + 15 * 1440), t(99_000)), (904, "EDGE", t(60_001 + 15 * 1440), t(99_000))]
    for name, rows, schema in (("calls", made, "call_id int, vendor string, start_ts timestamp, end_ts timestamp"), ("outages", outages, "incident_number int, vendor string, opened_at timestamp, ended_at timestamp")):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/{name}")
    read = lambda name: spark.readStream.schema(spark.read.parquet(f"{tmp_path}/{name}").schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")
    joined = jobs.active_incidents(read("calls"), read("outages"), late="20000 days")
    got = []
    jobs.drain(joined, "days", f"{tmp_path}/c", "append", lambda df, b: got.extend(map(tuple, df.collect())))
    hour, days = timedelta(hours=1), timedelta(days=15)
    same = lambda c, i: c[1] and i[1] and c[1].upper() == i[1].upper()
    want = [(c[0], i[0]) for c in made for i in outages if same(c, i) and c[2] - days <= i[2] <= min(c[3] + hour, c[2] + days) and i[3] >= c[2] - hour]
    assert sorted(got) == sorted(want)
    assert {x for x in got if x[0] >= 900} == {(900, 900), (900, 901), (901, 903)}
    # Not all calls of a vendor are compared with all of its incidents: the sides meet by block, too.
    assert "_block#" in joined._jdf.queryExecution().analyzed().toString().split("Join Inner, ", 1)[1].split("\n")[0]


def test_places_are_screened_before_masks(spark, monkeypatch):
    op2 = pytest.importorskip("opslake.llm.op2_decontaminate")
    r = random.Random(5)
    text = lambda n: [f"w{r.randrange(40)}" for _ in range(n)]
    items = [(k, text(n)) for k, n in enumerate([4, 5, 5, 7, 9, 10, 12, 20, 30])]
    docs = [(None, "one two three four five"), (1, None), (1, ""), (1, "w1 w2")]
    for k in range(60):
        passage = list(r.choice(items)[1])
        if len(passage) > 9:
            passage[r.randrange(len(passage))] = "other"
        docs.append((k % 50, " ".join(text(r.randrange(30)) + passage * r.choice([1, 2]) + text(r.randrange(30)))))
    plans, write = [], op2.written
    monkeypatch.setattr(op2, "written", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df, name))
    run = lambda **how: sorted(map(tuple, op2.overlaps(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame([(k, " ".join(t)) for k, t in items], "item_id int, text string"), **how).collect()))
    got = run()
    assert got == run(broadcast_seeds=0) and len(got) >= 40
    assert "LeftSemi" in plans[0] and "LeftSemi" not in plans[1]
    assert all(m[: op2.START] == tuple(range(op2.START)) for m in op2.MASKS)


def test_equal_sessions_are_chosen_by_what_they_hold(spark):
    t = datetime(2024, 1, 1)
    rows = [(c, 3, "customer", None, None, "V", place, 3.0, t, t, t) for c in range(40) for place in ((1, 2) if c % 2 else (2, 1))]
    df = spark.createDataFrame(rows, "conversation_id int, participant_id int, purpose string, error_code string, agent_id int, vendor string, location_key int, mos double, start_ts timestamp_ntz, end_ts timestamp_ntz, ingestion_ts timestamp_ntz").coalesce(1)
    assert {r["location_key"] for r in calls.participants_latest(df).collect()} == {2}
