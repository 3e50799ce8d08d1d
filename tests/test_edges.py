"""Small rules at their edges: landed texts, required fields, responses, states, the report's summary."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from opslake.operators import incidents, quality
from opslake.sources import landing


def test_texts_with_a_zone_and_others(spark):
    texts = ["2024-01-15T10:30:00Z", "2024-01-15T10:30:00.250Z", "2024-01-15T12:30:00+02:00", "2024-01-15 10:30:00", "15/01/2024 10:30", "soon", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in landing.parsed_timestamps(df, ["t"], ("yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm")).collect()]
    at = datetime(2024, 1, 15, 10, 30)
    assert got == [at, at.replace(microsecond=250_000), at, at, at, None, None, None]


def test_windows_are_half_open_and_appends_carry_metadata(spark, tmp_path):
    t = lambda h: datetime(2024, 1, 1, h)
    df = spark.createDataFrame([(k, t(k)) for k in range(5)] + [(9, None)], "k int, ts timestamp_ntz")
    start, end = (F.lit(t(h)).cast("timestamp_ntz") for h in (1, 3))
    rows = landing.with_metadata(landing.in_window(df, "ts", start, end), "b7", start, end, "search", end)
    landing.append(rows, f"{tmp_path}/bronze")
    landing.append(rows, f"{tmp_path}/bronze")
    got = spark.read.parquet(f"{tmp_path}/bronze")
    assert sorted(r["k"] for r in got.collect()) == [1, 1, 2, 2]
    assert {tuple(r) for r in got.select("_batch_id", "_window_start", "_window_end", "_source_system").collect()} == {("b7", t(1), t(3), "search")}


def test_required_fields(spark):
    df = spark.createDataFrame([("a", None), ("b", None), (None, None)], "x string, y int")
    got = {r["field"]: tuple(r)[1:] for r in quality.required_fields(df, ["x", "y", "z"]).collect()}
    assert got == {"x": (True, 2, 2), "y": (True, 0, 0), "z": (False, 0, 0)} and quality.missing_fields(df, ["z", "x"]) == ["z"]
    assert {r["field"]: r["filled"] for r in quality.required_fields(df.limit(0), ["x", "z"]).collect()} == {"x": 0, "z": 0}
    assert quality.required_fields(df, ["z"]).count() == 1


def test_the_response_is_the_first_column_that_is_there(spark):
    t = lambda m: datetime(2024, 1, 1, 0, m)
    rows = [(1, "New", t(0), t(1), None, t(9)), (1, "Closed", t(0), t(2), None, t(30)), (2, "New", t(0), t(1), t(5), t(6))]
    df = spark.createDataFrame(rows, "number int, state string, opened_at timestamp_ntz, extracted timestamp_ntz, response_time_ts timestamp_ntz, work_start_ts timestamp_ntz")
    get = lambda d, **k: sorted((r["number"], r["state"], r["response_minutes"]) for r in incidents.latest_incident(d, "number", "extracted", "state", **k).collect())
    assert get(df) == [(1, "Closed", None), (2, "New", 5.0)]
    assert get(df, filled=True) == [(1, "Closed", 30.0), (2, "New", 5.0)]
    assert get(df.drop("response_time_ts")) == [(1, "Closed", 30.0), (2, "New", 6.0)]
    assert get(df.drop("response_time_ts", "work_start_ts"), filled=True) == [(1, "Closed", None), (2, "New", None)]


def test_states_as_texts_and_codes(spark):
    df = spark.createDataFrame([(s,) for s in ("Resolved", "6", "7", "On Hold", "3", "Canceled", None)], "state string")
    assert tuple(incidents.state_counts(df).first()) == (7, 2, 1, 2)


def test_summary_of_the_report(spark, tmp_path):
    apps = spark.createDataFrame([("a", 90, 5), ("b", 50, 4), ("c", 31, 3)], "app string, confidence int, event_count long").withColumns({c: F.array(F.lit("x")) for c in ("methods", "sources", "hosts", "evidence")})
    landing.write_report(apps, f"{tmp_path}/apps", f"{tmp_path}/summary")
    assert json.loads(spark.read.text(f"{tmp_path}/summary").first()[0]) == {"total_applications": 3, "high_confidence": 1, "medium_confidence": 1, "low_confidence": 1, "confidence_threshold": 30}
    assert spark.read.json(f"{tmp_path}/apps").count() == 3
