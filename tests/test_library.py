"""The registered queries against their SQL, and the operators on small cases."""

import json
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from opslake.functions import rules
from opslake.operators import calls, discovery, incidents, monitoring, tables
from opslake.plans import load
from opslake.sources import landing
from opslake.streaming import jobs

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows):
    return sorted((tuple(None if x is None else round(x, 6) if isinstance(x, float) else str(x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = duck.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({ORACLES[name]})").fetchall()
    assert plain(tuple(r) for r in df.select(cols).collect()) == plain(want)


def test_rules(spark):
    rows = spark.createDataFrame([("E", None), (None, 1.99), (None, 2.0), (None, 3.49), (None, 3.5), (None, None)], "e string, m double")
    assert [r[0] for r in rows.select(rules.classify_call(F.col("e"), F.col("m"))).collect()] == ["ERRORED", "ERRORED", "DEGRADED", "DEGRADED", "NORMAL", "NORMAL"]
    p = spark.createDataFrame([("1 - Critical",), ("P2",), (" ",), ("Critical",), (None,)], "p string")
    assert [r[0] for r in p.select(rules.normalize_priority(F.col("p"))).collect()] == ["P1", "P2", " ", "PC", None]
    s = spark.createDataFrame([(True, 100.0), (True, 100.1), (False, 100.1), (False, 80.1), (False, 80.0), (False, None)], "k boolean, p double")
    assert [r[0] for r in s.select(rules.sla_status(F.col("k"), F.col("p"))).collect()] == ["MET", "BREACHED", "BREACHED", "AT_RISK", "IN_PROGRESS", "IN_PROGRESS"]
    a = spark.createDataFrame([("Billing-Service",), ("pay_v2.1",), ("x9",), ("1234",)], "a string")
    assert [(r[0], r[1]) for r in a.select(rules.normalize_app(F.col("a")), rules.valid_app(F.col("a"))).collect()] == [("billing", True), ("pay", True), ("x", False), ("", False)]
    b = spark.createDataFrame([("myapp",), ("PROD",), ("shop-daemon",)], "a string")
    assert [(r[0], r[1]) for r in b.select(rules.normalize_app(F.col("a")), rules.valid_app(F.col("a"))).collect()] == [("my", True), ("prod", False), ("shop", True)]


def test_upsert_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 5)], "k int, v string, ts int")
    s = spark.createDataFrame([(1, "A", 2), (2, "B", 4), (3, "C", 1)], "k int, v string, ts int")
    once = tables.upsert(t, s, ["k"], newer="ts")
    want = [(1, "A", 2), (2, "b", 5), (3, "C", 1)]
    assert sorted(map(tuple, once.collect())) == want == sorted(map(tuple, tables.upsert(once, s, ["k"], newer="ts").collect()))
    assert sorted(map(tuple, tables.upsert(t, s, ["k"], newer="ts", columns=["ts"]).collect())) == [(1, "a", 2), (2, "b", 5), (3, "C", 1)]
    assert sorted(map(tuple, tables.replace_rows(t, s, ["k"]).collect())) == sorted(map(tuple, s.collect()))


def test_null_keys_and_states_are_values(spark):
    t = spark.createDataFrame([(None, "a", 1), (2, "b", 5)], "k int, v string, ts int")
    s = spark.createDataFrame([(None, "A", 2)], "k int, v string, ts int")
    for got in (tables.upsert(t, s, ["k"], newer="ts"), tables.replace_rows(t, s, ["k"])):
        assert sorted(map(tuple, got.collect()), key=str) == [(2, "b", 5), (None, "A", 2)]
    b = spark.createDataFrame([(1, None, 9), (2, "New", 9), (3, "New", 9)], "incident_number int, state string, t int").withColumn("ingestion_ts", F.timestamp_seconds("t"))
    c = spark.createDataFrame([(1, "New", 0), (2, None, 0), (3, "New", 0)], "incident_number int, state string, t int").withColumn("ingestion_ts", F.timestamp_seconds("t"))
    assert sorted((r.incident_number, r.from_state, r.to_state) for r in incidents.state_changes(b, c).collect()) == [(1, "New", None), (2, None, "New")]


def test_discovery_rules(spark):
    paths = ["/var/log/myapp/application.log", "/opt/shop/bin", "C:\\x\\logs\\cart", "/var/log/app-1/service.log", "/srv/mail-2.7", "nothing"]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(discovery.first_match(F.col("p"), discovery.any_case(discovery.SOURCE_PATTERNS))).collect()
    assert [r[0] for r in got] == ["application", "shop", "cart", "service", "mail", None]
    texts = ["app=cart [Shop] x", "com.acme.Billing", 'logger: "a.b.Core"', "[Shop]", "none here", None]
    assert [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(discovery.content_name(F.col("t"))).collect()] == ["Shop", "Billing", "Core", "Shop", None, None]
    e = spark.createDataFrame([("s", "prd-x01", "a_json", 0, '{"app": "Billing-Service"}'), ("s", "pay-cart3.corp", "a_json", 0, '{"k": "zzz"}')], "source string, host string, sourcetype string, ts int, props string")
    tallied = discovery.tally(e)
    assert [r.app for r in discovery.discover(tallied, ("host",)).collect()] == ["pay"] and [r.app for r in discovery.discover(tallied, ("json",), least_fields=0).collect()] == ["billing"]


def test_health_does_not_depend_on_row_order(spark):
    wide = spark.createDataFrame([(1, None, None, None)], "entity_id int, cpu double, memory double, failure_rate double")
    for order in (["PERFORMANCE", "MONITORING_UNAVAILABLE"], ["MONITORING_UNAVAILABLE", "PERFORMANCE"]):
        p = spark.createDataFrame([(1, s) for s in order], "entity_id int, severity string").coalesce(1)
        assert monitoring.assess_health(wide, p).first().health == "WARNING"


def test_landing_functions(spark, tmp_path):
    df = spark.createDataFrame([("1", "2024-01-02 03:04:05"), ("2", "02/01/2024 03:04"), ("3", "soon"), (None, None)], "a string, t string")
    out = landing.parsed_timestamps(landing.renamed(df, {"a": "id", "t": "at", "none": "gone"}), ["at"], ("yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm")).collect()
    assert [str(r["at"])[:16] for r in out] == ["2024-01-02 03:04", "2024-01-02 03:04", "None", "None"] and out[0].gone is None
    landing.append(df, f"{tmp_path}/p", ["a"])
    landing.append(df, f"{tmp_path}/p", ["a"])
    assert spark.read.parquet(f"{tmp_path}/p").where("a = '1'").count() == 2
    assert spark.read.parquet(landing.refresh(df, f"{tmp_path}/r")).count() == 4
    for h, status in ((1, "SUCCESS"), (2, "FAILED"), (3, "SUCCESS")):
        landing.log_run(f"{tmp_path}/runs", spark, "job", status, datetime(2024, 1, 1, h - 1), datetime(2024, 1, 1, h), 5)
    runs = spark.read.parquet(f"{tmp_path}/runs")
    assert landing.incremental_window(runs).first()[0] == datetime(2024, 1, 1, 2, 57) and landing.latest_runs(runs, 1).first().window_end.hour == 3
    assert landing.concatenated([df, df.select("a")]).count() == 8


def test_stream_of_transitions(spark, tmp_path):
    batches = [[(1, "New", 0), (2, "New", 0), (1, "Open", 60)], [(1, "Open", 120), (1, "Closed", 180), (2, None, 300)]]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, "k int, state string, t int").select("k", "state", F.timestamp_seconds("t").alias("ts")).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    stream = spark.readStream.schema("k int, state string, ts timestamp").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = []
    jobs.drain(jobs.transitions(stream, "k", "state", "ts"), "moves", f"{tmp_path}/c", "append", lambda df, b: got.extend((r.k, r.from_state, r.to_state, r.minutes) for r in df.collect()))
    assert sorted(got, key=str) == [(1, "New", "Open", 1.0), (1, "Open", "Closed", 2.0), (2, "New", None, 5.0)]
    seen = []
    table = spark.read.parquet(f"{tmp_path}/in/0", f"{tmp_path}/in/1")
    jobs.recompute_days(2, "ts", lambda: table, lambda t: t.agg(F.count("*").alias("n")), lambda df, b: seen.append((b, df.first().n)))(table, 7)
    jobs.snapshots(lambda: table, lambda df, b: seen.append((b, df.count())))(table, 8)
    assert seen == [(7, 6), (8, 6)]


def test_conversation_without_sessions_has_no_rows(spark):
    schema = "conversation_id int, start_ts timestamp, end_ts timestamp, divisions array<string>, participants array<struct<participant_id:int,purpose:string,user_id:int,sessions:array<struct<vendor:string,error_code:string,metrics:array<struct<name:string,value:double>>>>>>"
    rows = [(1, None, None, [], [(1, "agent", 7, []), (2, "customer", 8, [("v", None, None)])])]
    got = calls.flatten_conversations(spark.createDataFrame(rows, schema)).collect()
    assert [(r.participant_id, r.agent_id, r.mos, r.division) for r in got] == [(2, None, None, None)]


def test_landed_files_and_reports(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"a": 1, "b": "x", "z": 3}\n{"a": "2"}\n')
    df = landing.json_lines(spark, str(tmp_path / "in"), ["a", "b"])
    assert sorted(map(tuple, df.collect()), key=str) == [("1", "x"), ("2", None)]
    landing.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    e = spark.createDataFrame([("app", "source", 200, [f"s{k}" for k in range(150)], ["h"], ["t"], ["e"])], "app string, method string, event_count long, sources array<string>, hosts array<string>, sourcetypes array<string>, evidence array<string>")
    landing.write_report(discovery.merge(e), str(tmp_path / "json"))
    row = json.loads(spark.read.text(str(tmp_path / "json")).first()[0])
    assert len(row["sources"]) == 100 and row["confidence"] == 8 + 10 + 15 + 5 + 5


def test_streams(spark, tmp_path):
    schema = "k int, state string, ts timestamp"
    batches = [[(1, "New", "2024-01-01 10:00:00"), (2, "New", "2024-01-01 11:00:00")], [(1, "Closed", "2024-01-02 10:00:00"), (1, "New", "2024-01-01 10:00:00")]]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, "k int, state string, ts string").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    stream = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    state = {"table": None, "done": set()}

    def swap(df, batch_id):
        if batch_id not in state["done"]:
            df.write.mode("overwrite").parquet(f"{tmp_path}/t{batch_id}")
            state["table"] = spark.read.parquet(f"{tmp_path}/t{batch_id}")
            state["done"].add(batch_id)

    jobs.drain(stream().repartition(1), "up", f"{tmp_path}/c1", "append", jobs.upsert_batches(["k"], "ts", lambda: state["table"], swap))
    assert sorted((r.k, r.state) for r in state["table"].collect()) == [(1, "Closed"), (2, "New")]
    days = {}
    jobs.drain(jobs.daily_counts(stream(), "ts"), "days", f"{tmp_path}/c2", "update", lambda df, b: days.update({str(r.day): r.n for r in df.collect()}))
    assert days == {"2024-01-01": 3, "2024-01-02": 1}
    jobs.drain(jobs.deduplicated(stream(), ["k", "state"], "ts"), "dedup", f"{tmp_path}/c3", path=f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3
