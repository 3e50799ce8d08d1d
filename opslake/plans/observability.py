"""Discovery, monitoring, data quality and reports over the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslake.operators import calls, incidents, monitoring, quality, tables
from opslake.plans.fixtures import AS_OF, fixture, oracle
from opslake.plans.operations import FACTS, GEO, OPEN, all_facts, by, latest, now, sla_sql
from opslake.plans.registry import query, table
from opslake.sources.landing import in_window, incremental_window, with_metadata

def entities(spark, d):
    s = table(spark, d, "supplier")
    kind = F.when(F.col("s_suppkey") % 3 == 0, "HOST").when(F.col("s_suppkey") % 3 == 1, "SERVICE").otherwise("APPLICATION")
    tag = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))
    tags = F.array(tag("nation", F.col("s_nationkey")), tag("bucket", F.col("s_suppkey") % 40))
    near = F.create_map(F.lit("runsOn"), F.array(F.col("s_suppkey") + 1, F.col("s_suppkey") + 2))
    return s.select(F.col("s_suppkey").alias("entity_id"), kind.alias("entity_type"), tags.alias("tags"), near.alias("from_relationships"), F.create_map(F.lit("calls"), F.array("s_nationkey").cast("array<bigint>")).alias("to_relationships"))


ENTITIES = "SELECT s_suppkey AS entity_id, CASE s_suppkey % 3 WHEN 0 THEN 'HOST' WHEN 1 THEN 'SERVICE' ELSE 'APPLICATION' END AS entity_type, s_nationkey, s_suppkey % 40 AS bucket FROM supplier"
COVER = f"""WITH e AS ({ENTITIES}), t AS (SELECT entity_id, entity_type, 'bucket' AS key, CAST(bucket AS VARCHAR) AS value FROM e UNION ALL SELECT entity_id, entity_type, 'nation', CAST(s_nationkey AS VARCHAR) FROM e),
  n AS (SELECT key, value, count(*) FILTER (entity_type = 'HOST') AS h, count(*) FILTER (entity_type = 'SERVICE') AS s, count(*) FILTER (entity_type = 'APPLICATION') AS a FROM t GROUP BY 1, 2),
  l AS (SELECT c_custkey AS app_id, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 60 AS VARCHAR) END AS bucket, CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS nation FROM customer),
  j AS (SELECT l.*, b.key IS NOT NULL AS bh, m.key IS NOT NULL AS mh, b.h AS b1, b.s AS b2, b.a AS b3, m.h AS m1, m.s AS m2, m.a AS m3 FROM l LEFT JOIN n b ON b.key = 'bucket' AND b.value = l.bucket LEFT JOIN n m ON m.key = 'nation' AND m.value = l.nation),
  c AS (SELECT app_id, CASE WHEN bh THEN 'bucket' WHEN mh THEN 'nation' WHEN bucket IS NOT NULL THEN 'bucket' WHEN nation IS NOT NULL THEN 'nation' END AS matched_key, CASE WHEN bh THEN bucket WHEN mh THEN nation ELSE coalesce(bucket, nation) END AS matched_value,
    coalesce(CASE WHEN bh THEN b1 ELSE m1 END, 0) AS hosts, coalesce(CASE WHEN bh THEN b2 ELSE m2 END, 0) AS services, coalesce(CASE WHEN bh THEN b3 ELSE m3 END, 0) AS applications FROM j),
  k AS (SELECT *, CASE WHEN hosts > 0 AND services > 0 THEN 'FULL' WHEN hosts > 0 AND applications = 0 THEN 'HOSTS_ONLY' WHEN hosts + services + applications > 0 THEN 'PARTIAL' ELSE 'NOT_MONITORED' END AS coverage FROM c)"""


def covered(spark, d):
    c = table(spark, d, "customer")
    a = c.select(F.col("c_custkey").alias("app_id"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey") % 60).alias("bucket"), F.when(F.col("c_custkey") % 7 != 0, F.col("c_nationkey")).alias("nation"))
    return monitoring.coverage(a, entities(spark, d), ["bucket", "nation"])


@query("coverage", f"{COVER} SELECT * FROM k")
def _(spark, d):
    return covered(spark, d)


@query("coverage_summary", f"{COVER} SELECT coverage, count(*) AS apps FROM k GROUP BY 1")
def _(spark, d):
    return covered(spark, d).groupBy("coverage").agg(F.count("*").alias("apps"))


@query("tag_counts", f"WITH e AS ({ENTITIES}) SELECT entity_type, 'bucket' AS key, count(*) AS entities, count(DISTINCT bucket) AS distinct_values FROM e GROUP BY 1 UNION ALL SELECT entity_type, 'nation', count(*), count(DISTINCT s_nationkey) FROM e GROUP BY 1")
def _(spark, d):
    return monitoring.tag_counts(entities(spark, d))


@query("relationship_edges", "SELECT s_suppkey AS entity_id, 'from' AS direction, 'runsOn' AS type, s_suppkey + unnest([1, 2]) AS related_id FROM supplier UNION ALL SELECT s_suppkey, 'to', 'calls', s_nationkey FROM supplier")
def _(spark, d):
    return monitoring.relationship_edges(entities(spark, d))


METRICS = {"click": "cpu", "view": "memory", "error": "failure_rate"}
SERIES = "SELECT user_id AS entity_id, CASE event_type WHEN 'click' THEN 'cpu' WHEN 'view' THEN 'memory' WHEN 'error' THEN 'failure_rate' ELSE 'other' END AS metric, ts, value FROM events"
WIDE = f"w AS (SELECT entity_id, {', '.join(f'''round(max_by(value, struct_pack(ts, value)) FILTER (metric = '{m}'), 2) AS {m}''' for m in METRICS.values())} FROM ({SERIES}) WHERE value IS NOT NULL GROUP BY 1)"
HEALTH = f"""WITH {WIDE}, pr AS (SELECT user_id AS entity_id, count(*) AS open_problems, min(CASE WHEN event_id % 30 = 0 THEN 0 WHEN event_id % 30 < 8 THEN 1 ELSE 2 END) AS r FROM events WHERE event_type = 'error' GROUP BY 1),
  a AS (SELECT w.*, coalesce(open_problems, 0) AS open_problems, CASE r WHEN 0 THEN 'ERROR' WHEN 1 THEN 'PERFORMANCE' WHEN 2 THEN 'MONITORING_UNAVAILABLE' END AS worst_severity FROM w LEFT JOIN pr USING (entity_id)),
  h AS (SELECT *, CASE WHEN worst_severity = 'ERROR' THEN 'CRITICAL' WHEN worst_severity = 'PERFORMANCE' OR cpu > 90 OR memory > 90 OR failure_rate > 5 THEN 'WARNING' WHEN worst_severity IS NULL AND cpu IS NULL AND memory IS NULL AND failure_rate IS NULL THEN 'UNKNOWN' ELSE 'HEALTHY' END AS health FROM a)"""


def wide_metrics(spark, d):
    e = table(spark, d, "events")
    name = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in METRICS.items()], F.lit("other"))
    return monitoring.latest_metrics(e.select(F.col("user_id").alias("entity_id"), name.alias("metric"), "ts", "value"), list(METRICS.values()))


def assessed(spark, d):
    e = table(spark, d, "events")
    n = F.col("event_id") % 30
    problems = e.where("event_type = 'error'").select(F.col("user_id").alias("entity_id"), F.when(n == 0, "ERROR").when(n < 8, "PERFORMANCE").otherwise("MONITORING_UNAVAILABLE").alias("severity"))
    return monitoring.assess_health(wide_metrics(spark, d), problems)


@query("latest_metrics", f"WITH {WIDE} SELECT * FROM w")
def _(spark, d):
    return wide_metrics(spark, d)


@query("assess_health", f"{HEALTH} SELECT * FROM h")
def _(spark, d):
    return assessed(spark, d)


@query("health_summary", f"{HEALTH} SELECT health, count(*) AS entities FROM h GROUP BY 1")
def _(spark, d):
    return assessed(spark, d).groupBy("health").agg(F.count("*").alias("entities"))


INVENTORY = f"""WITH {WIDE}, known AS (SELECT max(s_suppkey) AS entity_id, lower('Host-' || (s_suppkey % 30)) AS k FROM supplier GROUP BY 2),
  want AS (SELECT lower(h) AS k, min(h) AS hostname FROM (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'HOST-' ELSE 'host-' END || (c_custkey % 50) AS h FROM customer) GROUP BY 1),
  inv AS (SELECT hostname, entity_id IS NOT NULL AS found, entity_id, CASE WHEN entity_id IS NULL OR entity_id % 4 = 0 THEN 'NOT_INSTALLED' WHEN entity_id % 3 = 0 THEN 'RUNNING' ELSE 'STOPPED' END AS agent_status, cpu, memory, failure_rate FROM want LEFT JOIN known USING (k) LEFT JOIN w USING (entity_id))"""


def inventory(spark, d):
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    wanted = c.select(F.concat(F.when(F.col("c_custkey") % 2 == 0, "HOST-").otherwise("host-"), (F.col("c_custkey") % 50).cast("string")).alias("hostname"))
    known = s.select(F.col("s_suppkey").alias("entity_id"), F.concat(F.lit("Host-"), (F.col("s_suppkey") % 30).cast("string")).alias("hostname"), F.when(F.col("s_suppkey") % 4 != 0, "1.2").alias("version"), F.when(F.col("s_suppkey") % 3 == 0, "RUNNING").otherwise("UNKNOWN").alias("state"))
    return monitoring.host_inventory(wanted, known, wide_metrics(spark, d))


@query("host_inventory", f"{INVENTORY} SELECT * FROM inv")
def _(spark, d):
    return inventory(spark, d)


@query("host_inventory_summary", f"{INVENTORY} SELECT count(*) AS hosts, count(*) FILTER (found) AS found, count(*) FILTER (NOT found) AS missing, count(*) FILTER (agent_status = 'RUNNING') AS running, round(avg(cpu), 2) AS avg_cpu, round(avg(memory), 2) AS avg_memory FROM inv")
def _(spark, d):
    return monitoring.inventory_summary(inventory(spark, d))


def leaf_sql(cap: int) -> str:
    widths = [24.0, 12.0, 6.0, 3.0, 1.5, 0.75]
    counts = " UNION ALL ".join(f"SELECT {k} AS level, {w} AS width, CAST(floor(floor(epoch(ts) - epoch(TIMESTAMP '2024-01-01')) / {w * 3600}) AS BIGINT) AS bin FROM events" for k, w in enumerate(widths))
    up = " AND ".join(f"NOT EXISTS (SELECT 1 FROM d WHERE d.level = x.level - {u} AND d.bin = CAST(floor(x.bin / {2.0**u}) AS BIGINT))" for u in range(1, 6))
    return f"WITH n AS (SELECT level, width, bin, count(*) AS n FROM ({counts}) GROUP BY ALL), d AS (SELECT * FROM n WHERE n < {cap} OR level = 5) SELECT CAST(width AS DOUBLE) AS width_hours, bin, n FROM d x WHERE {up}"


@query("chunk_plan", leaf_sql(200))
def _(spark, d):
    return tables.chunk_plan(table(spark, d, "events"), "ts", "2024-01-01 00:00:00", cap=200)


@query("incremental_window", "SELECT max(ts) FILTER (event_type = 'purchase') - INTERVAL 3 MINUTE AS next_start FROM events")
def _(spark, d):
    return incremental_window(table(spark, d, "events").select(F.when(F.col("event_type") == "purchase", "SUCCESS").otherwise("FAILED").alias("status"), F.col("ts").alias("window_end")))


@query("dq_field_profile", oracle(" SELECT field, count(v) AS present, count(DISTINCT v) AS distinct_values, count(*) FILTER (regexp_matches(v, '^-?\\d+(\\.\\d+)?$')) AS numeric FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS field, CAST({c} AS VARCHAR) AS v FROM incidents" for c in ("vendor", "service", "priority_raw", "state")) + ") GROUP BY 1", "incidents"))
def _(spark, d):
    return quality.field_profile(fixture(spark, d, "incidents"), ["vendor", "service", "priority_raw", "state"])


@query("dq_required_fields", oracle(" SELECT 'vendor' AS field, true AS present, count(vendor) AS filled, count(DISTINCT vendor) AS distinct_values FROM incidents UNION ALL SELECT 'priority', true, count(priority), count(DISTINCT priority) FROM incidents UNION ALL SELECT 'resolved_at', true, count(resolved_at), count(DISTINCT resolved_at) FROM incidents UNION ALL SELECT 'category', false, 0, 0", "incidents"))
def _(spark, d):
    return quality.required_fields(fixture(spark, d, "incidents"), ["vendor", "category", "priority", "resolved_at"])


WINDOW = "TIMESTAMP '1997-01-01 00:00:00'", "TIMESTAMP '1998-07-01 00:00:00'"


@query("window_read", oracle(f" SELECT conversation_id, participant_id, start_ts, {AS_OF} AS _ingestion_ts, 'b1' AS _batch_id, {WINDOW[0]} AS _window_start, {WINDOW[1]} AS _window_end, 'search' AS _source_system FROM participants WHERE start_ts >= {WINDOW[0]} AND start_ts < {WINDOW[1]}", "participants"))
def _(spark, d):
    start, end = (F.expr(w).cast("timestamp_ntz") for w in WINDOW)
    rows = in_window(fixture(spark, d, "participants").select("conversation_id", "participant_id", "start_ts"), "start_ts", start, end)
    return with_metadata(rows, "b1", start, end, "search", now())


@query("dq_populated_pct", oracle(" SELECT field, pct AS populated_pct, CASE WHEN pct >= wanted THEN 'PASS' ELSE 'FAIL' END AS verdict FROM (SELECT 'vendor' AS field, 95.0 AS wanted, round(count(vendor) * 100.0 / count(*), 2) AS pct FROM incidents UNION ALL SELECT 'service', 50.0, round(count(service) * 100.0 / count(*), 2) FROM incidents)", "incidents"))
def _(spark, d):
    return quality.populated(fixture(spark, d, "incidents"), vendor=95, service=50)


@query("dq_distribution", oracle(" SELECT state, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM incidents GROUP BY 1", "incidents"))
def _(spark, d):
    return quality.distribution(fixture(spark, d, "incidents"), "state")


@query("dq_top_k", oracle(" SELECT service, vendor, count(*) AS n FROM incidents GROUP BY 1, 2 ORDER BY n DESC, service NULLS FIRST, vendor NULLS FIRST LIMIT 20", "incidents"))
def _(spark, d):
    return quality.top_k(fixture(spark, d, "incidents"), 20, "service", "vendor")


@query("dq_presence", oracle(" SELECT count(*) AS rows_, count(opened_at) AS opened, count(responded_at) AS responded, count(resolved_at) AS resolved FROM incidents", "incidents"))
def _(spark, d):
    return fixture(spark, d, "incidents").agg(F.count("*").alias("rows_"), F.count("opened_at").alias("opened"), F.count("responded_at").alias("responded"), F.count("resolved_at").alias("resolved"))


@query("dq_minutes_stats", oracle(f"{FACTS} SELECT priority, round(avg(resolution_minutes), 2) AS avg_minutes, median(resolution_minutes) AS median_minutes, max(resolution_minutes) AS max_minutes, min(resolution_minutes) AS min_minutes FROM f GROUP BY 1", "incidents", "targets", "services"))
def _(spark, d):
    m = "resolution_minutes"
    return all_facts(spark, d).groupBy("priority").agg(F.round(F.avg(m), 2).alias("avg_minutes"), F.median(m).alias("median_minutes"), F.max(m).alias("max_minutes"), F.min(m).alias("min_minutes"))


@query("dq_ingestion_lag", oracle(" SELECT date_trunc('hour', ingestion_ts) AS hour, count(*) AS records, count(DISTINCT incident_number % 10) AS batches, round(avg((epoch(ingestion_ts) - epoch(opened_at)) / 60.0), 2) AS avg_lag_minutes FROM incidents GROUP BY 1", "incidents"))
def _(spark, d):
    out = quality.ingestion_lag(fixture(spark, d, "incidents"), F.col("opened_at"), F.col("ingestion_ts"), F.col("incident_number") % 10)
    return out.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query("dq_breach_matrix", oracle(f"{FACTS} SELECT priority, resolution_status, count(*) AS n FROM f GROUP BY 1, 2", "incidents", "targets", "services"))
def _(spark, d):
    return all_facts(spark, d).groupBy("priority", "resolution_status").agg(F.count("*").alias("n"))


@query("rpt_sla_compliance", oracle(f"{FACTS} SELECT priority, CAST(sum(total) AS BIGINT) AS total, CAST(sum(resolution_breached) AS BIGINT) AS breached, round(avg(resolution_compliance), 2) AS avg_daily_compliance FROM ({sla_sql('incident_date, priority')}) WHERE incident_date >= DATE '2001-06-01' GROUP BY 1", "incidents", "targets", "services"))
def _(spark, d):
    g = incidents.sla_by(all_facts(spark, d), "incident_date", "priority").where("incident_date >= DATE '2001-06-01'")
    return g.groupBy("priority").agg(F.sum("total").alias("total"), F.sum("resolution_breached").alias("breached"), F.round(F.avg("resolution_compliance"), 2).alias("avg_daily_compliance"))


@query("rpt_worst_services", oracle(f"{FACTS} SELECT service, resolution_compliance, total FROM ({sla_sql('service')}) ORDER BY resolution_compliance ASC NULLS LAST, service LIMIT 20", "incidents", "targets", "services"))
def _(spark, d):
    return incidents.sla_by(all_facts(spark, d), "service").select("service", "resolution_compliance", "total").orderBy(F.asc_nulls_last("resolution_compliance"), "service").limit(20)


@query("rpt_open_dashboard", oracle(f"{FACTS} SELECT priority, risk, count(*) AS n, round(max(time_open), 2) AS longest FROM ({OPEN}) GROUP BY 1, 2", "incidents", "targets", "services"))
def _(spark, d):
    return incidents.open_incidents(all_facts(spark, d), now()).groupBy("priority", "risk").agg(F.count("*").alias("n"), F.round(F.max("time_open"), 2).alias("longest"))


@query("rpt_vendor_quality", oracle(f"{GEO} {by('vendor, continent', 'g')}", "participants", "locations"))
def _(spark, d):
    return calls.quality_by(calls.with_geography(latest(spark, d), fixture(spark, d, "locations")), "vendor", "continent")


@query("rpt_breach_totals", oracle(f"{FACTS} SELECT count(*) FILTER (response_status = 'BREACHED') AS response_breached, count(*) FILTER (resolution_status = 'BREACHED') AS resolution_breached, count(*) AS total FROM f", "incidents", "targets", "services"))
def _(spark, d):
    return all_facts(spark, d).agg(F.count_if(F.col("response_status") == "BREACHED").alias("response_breached"), F.count_if(F.col("resolution_status") == "BREACHED").alias("resolution_breached"), F.count("*").alias("total"))


