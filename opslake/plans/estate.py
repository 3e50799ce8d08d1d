"""Catalog, applications' and hosts' health, bronze records, lists and reports over the fixtures."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from opslake.operators import calls, incidents, monitoring, quality, tables
from opslake.plans.fixtures import AS_OF, fixture, oracle
from opslake.plans.observability import COVER, WIDE, covered, entities, wide_metrics
from opslake.plans.operations import FACTS, OPEN, P, all_facts, latest, now, sla_sql
from opslake.plans.registry import query, table
from opslake.sources import landing

THREE = ("incidents", "targets", "services")
LOOKED = "trim(CAST({} AS VARCHAR))"
COLUMNS = {"app_id": "c_custkey", "app_name": "c_name", "owner": "c_owner", "environment": "c_mktsegment", "service_id": "service_id", "short_name": "short_name"}


@query("cmdb_lookups", """SELECT app_id, app_name, owner, service_id, array_to_string([x FOR x IN ['service_id=' || service_id, 'short_name=' || short_name] IF x IS NOT NULL], ',') AS lookups, service_id IS NOT NULL OR short_name IS NOT NULL AS has_lookups
  FROM (SELECT CAST(c_custkey AS VARCHAR) AS app_id, trim(c_name) AS app_name, CAST(NULL AS VARCHAR) AS owner, CASE WHEN c_custkey % 5 <> 0 THEN 'S' || c_custkey END AS service_id, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS short_name FROM customer WHERE c_mktsegment = 'BUILDING')""")
def _(spark, d):
    c = table(spark, d, "customer")
    catalog = c.withColumns({"service_id": F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit(" S"), F.col("c_custkey").cast("string"))).otherwise(F.lit("  ")), "short_name": F.when(F.col("c_custkey") % 3 != 0, F.col("c_name"))})
    out = monitoring.cmdb_lookups(catalog, COLUMNS, ["service_id", "short_name"], "building")
    text = F.array_join(F.transform("lookups", lambda x: F.concat(x["key"], F.lit("="), x["value"])), ",")
    return out.select("app_id", "app_name", "owner", F.nullif("service_id", F.lit("")).alias("service_id"), text.alias("lookups"), "has_lookups")


#: The present of the monitored estate.
EST = "TIMESTAMP '2024-01-31 00:00:00'"
SEVERITY = "CASE event_id % 6 WHEN 0 THEN 'AVAILABILITY' WHEN 1 THEN 'ERROR' WHEN 2 THEN 'PERFORMANCE' WHEN 3 THEN 'RESOURCE_CONTENTION' WHEN 4 THEN 'CUSTOM_ALERT' ELSE 'MONITORING_UNAVAILABLE' END"
PROBLEMS = f"""pb AS (SELECT problem_id, severity, title, unnest(affected) AS entity_id FROM (SELECT event_id AS problem_id, {SEVERITY} AS severity, 'problem ' || (event_id % 17) AS title, ts AS started, CASE WHEN value < 100 THEN 'OPEN' ELSE 'CLOSED' END AS status, [user_id, user_id + 1] AS affected FROM events WHERE event_type = 'error')
  WHERE status = 'OPEN' AND started >= {EST} - INTERVAL 240 HOURS)"""
WORST = "arg_min(severity, CASE WHEN severity IN ('AVAILABILITY', 'ERROR') THEN '0' WHEN severity IN ('PERFORMANCE', 'RESOURCE_CONTENTION', 'CUSTOM_ALERT') THEN '1' ELSE '2' END || severity)"


def problems(spark, d):
    e = table(spark, d, "events").where("event_type = 'error'")
    raw = e.select(F.col("event_id").alias("problem_id"), F.expr(SEVERITY).alias("severity"), F.concat(F.lit("problem "), (F.col("event_id") % 17).cast("string")).alias("title"), F.col("ts").alias("started"), F.when(F.col("value") < 100, "OPEN").otherwise("CLOSED").alias("status"), F.array("user_id", F.col("user_id") + 1).alias("affected"))
    return monitoring.open_problems(raw, F.expr(EST).cast("timestamp_ntz"), 240)


#: Whole numbers, so that sums don't depend on their order.
WHOLE = WIDE.replace("w AS (", "w0 AS (") + ", w AS (SELECT entity_id, round(cpu) AS cpu, round(memory) AS memory, round(failure_rate) AS failure_rate FROM w0)"
MEMBERS = f"""{COVER}, {WHOLE}, {PROBLEMS}, m AS (SELECT app_id, t.entity_id, t.entity_type FROM k JOIN t ON t.key = k.matched_key AND t.value = k.matched_value WHERE coverage <> 'NOT_MONITORED')"""
APP_HEALTH = f"""{MEMBERS}, g AS (SELECT app_id, round(avg(cpu) FILTER (entity_type = 'HOST'), 2) AS avg_cpu, round(avg(memory) FILTER (entity_type = 'HOST'), 2) AS avg_memory, round(avg(failure_rate) FILTER (entity_type = 'SERVICE'), 2) AS avg_failure_rate, round(sum(failure_rate) FILTER (entity_type = 'APPLICATION'), 2) AS total_failure_rate,
    count(*) FILTER (entity_type = 'HOST') AS host_count, count(*) FILTER (entity_type = 'SERVICE') AS service_count, count(*) FILTER (entity_type = 'APPLICATION') AS application_count FROM m LEFT JOIN w USING (entity_id) GROUP BY 1),
  s AS (SELECT app_id, severity, count(*) AS n FROM (SELECT DISTINCT app_id, problem_id, severity FROM m JOIN pb USING (entity_id)) GROUP BY 1, 2),
  o AS (SELECT app_id, CAST(sum(n) AS BIGINT) AS open_problems, '{{' || string_agg('"' || severity || '":' || n, ',' ORDER BY severity) || '}}' AS problem_severities, {WORST} AS worst FROM s GROUP BY 1),
  h AS (SELECT g.*, coalesce(open_problems, 0) AS open_problems, problem_severities, CASE WHEN worst IN ('AVAILABILITY', 'ERROR') THEN 'CRITICAL' WHEN worst IN ('PERFORMANCE', 'RESOURCE_CONTENTION', 'CUSTOM_ALERT') OR avg_cpu > 90 OR avg_memory > 90 OR avg_failure_rate > 5 THEN 'WARNING'
    WHEN worst IS NULL AND avg_cpu IS NULL AND avg_memory IS NULL AND avg_failure_rate IS NULL THEN 'UNKNOWN' ELSE 'HEALTHY' END AS health FROM g LEFT JOIN o USING (app_id))"""


def app_health(spark, d):
    whole = wide_metrics(spark, d).select("entity_id", *[F.round(m).alias(m) for m in ("cpu", "memory", "failure_rate")])
    return monitoring.app_health(covered(spark, d), entities(spark, d), whole, problems(spark, d), {"HOST": ["cpu", "memory"], "SERVICE": ["failure_rate"]}, {"APPLICATION": ["failure_rate"]})


@query("app_health", f"{APP_HEALTH} SELECT * FROM h")
def _(spark, d):
    return app_health(spark, d)


@query("app_health_ranked", f"{APP_HEALTH} SELECT app_id, health, row_number() OVER (ORDER BY CASE health WHEN 'CRITICAL' THEN 0 WHEN 'WARNING' THEN 1 WHEN 'UNKNOWN' THEN 2 ELSE 3 END, app_id) AS place FROM h ORDER BY place")
def _(spark, d):
    rank = F.when(F.col("health") == "CRITICAL", 0).when(F.col("health") == "WARNING", 1).when(F.col("health") == "UNKNOWN", 2).otherwise(3)
    rows = app_health(spark, d).select("app_id", "health", rank.alias("rank"), F.shiftright("app_id", 16).alias("block"))
    return monitoring.placed(rows, ["rank", "block"], "app_id").orderBy("place").select("app_id", "health", "place")


@query("affected_entities", f"{COVER}, {PROBLEMS} SELECT entity_type, count(*) AS n FROM e WHERE entity_id IN (SELECT entity_id FROM pb) GROUP BY 1")
def _(spark, d):
    return monitoring.affected(entities(spark, d), problems(spark, d)).groupBy("entity_type").agg(F.count("*").alias("n"))


HOSTS = "hosts AS (SELECT s_suppkey AS entity_id, 'Host-' || (s_suppkey % 30) AS hostname, CASE WHEN s_suppkey % 4 <> 0 THEN '1.' || (s_suppkey % 3) END AS version, CASE s_suppkey % 5 WHEN 0 THEN 'FULL_STACK' WHEN 1 THEN 'DISCOVERY' END AS mode, CASE WHEN s_suppkey % 3 = 0 THEN 'RUNNING' ELSE 'UNKNOWN' END AS state FROM supplier)"


def hosts(spark, d):
    n = F.col("s_suppkey")
    return table(spark, d, "supplier").select(
        n.alias("entity_id"), F.concat(F.lit("Host-"), (n % 30).cast("string")).alias("hostname"), F.when(n % 4 != 0, F.concat(F.lit("1."), (n % 3).cast("string"))).alias("version"),
        F.when(n % 5 == 0, "FULL_STACK").when(n % 5 == 1, "DISCOVERY").alias("mode"), F.when(n % 3 == 0, "RUNNING").otherwise("UNKNOWN").alias("state"),
    )


@query("host_health", f"WITH {HOSTS}, {PROBLEMS}, g AS (SELECT entity_id, count(*) AS n, {WORST} AS worst, bool_or(severity IN ('PERFORMANCE', 'RESOURCE_CONTENTION')) AS slow, min(severity) AS f, array_to_string(list_sort(list(DISTINCT title))[1:3], '; ') AS titles FROM pb GROUP BY 1) SELECT entity_id, hostname, CASE WHEN worst IS NULL THEN 'HEALTHY' WHEN worst IN ('ERROR', 'AVAILABILITY') THEN 'CRITICAL' ELSE 'WARNING' END AS health, CASE WHEN worst IS NULL THEN 'NONE' WHEN worst IN ('ERROR', 'AVAILABILITY') THEN 'ERROR' WHEN slow THEN 'PERFORMANCE' ELSE f END AS trouble, coalesce(n, 0) AS problems, coalesce(titles, '') AS titles FROM hosts LEFT JOIN g USING (entity_id)")
def _(spark, d):
    return monitoring.host_health(hosts(spark, d).select("entity_id", "hostname"), problems(spark, d))


@query("agent_status", f"WITH {HOSTS} SELECT entity_id, version, mode, state, coalesce(version, '') <> '' OR coalesce(mode, '') IN ('FULL_STACK', 'INFRASTRUCTURE_ONLY') AS agent_installed, state = 'RUNNING' AS agent_running FROM hosts")
def _(spark, d):
    return monitoring.agent_status(hosts(spark, d)).drop("hostname")


@query("find_hosts", f"WITH {HOSTS} SELECT 'id' AS way, entity_id, hostname FROM hosts WHERE entity_id = 7 UNION ALL SELECT 'name', entity_id, hostname FROM hosts WHERE contains(hostname, '-1') ORDER BY lower(hostname)")
def _(spark, d):
    h = hosts(spark, d).select("entity_id", "hostname")
    return monitoring.find_hosts(h, host_id=7).select(F.lit("id").alias("way"), "*").union(monitoring.find_hosts(h, name="-1").select(F.lit("name").alias("way"), "*")).orderBy(F.lower("hostname"), "entity_id")


@query("agent_versions", f"WITH {HOSTS} SELECT coalesce(version, 'Unknown') AS version, count(*) AS hosts FROM hosts GROUP BY 1")
def _(spark, d):
    return monitoring.version_distribution(hosts(spark, d))


@query("host_properties", "SELECT s_suppkey AS entity_id, CASE WHEN s_suppkey % 2 = 0 THEN 'LINUX' ELSE '' END AS \"osType\", 'v' || s_nationkey AS \"osVersion\", round(s_suppkey * 123456789.0 / 1073741824, 2) AS memory_gib, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE '10.0.0.' || s_nationkey || ', 10.0.1.' || s_nationkey END AS ip_addresses FROM supplier")
def _(spark, d):
    n, m = F.col("s_suppkey"), F.col("s_nationkey").cast("string")
    props = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in (("osType", F.when(n % 2 == 0, "LINUX")), ("osVersion", F.concat(F.lit("v"), m)), ("memoryTotal", (n * 123456789).cast("string")))]), lambda x: x["v"].isNotNull()))
    addresses = F.when(n % 3 != 0, F.array(F.concat(F.lit("10.0.0."), m), F.concat(F.lit("10.0.1."), m)))
    return monitoring.host_properties(table(spark, d, "supplier").select(n.alias("entity_id"), props.alias("properties"), addresses.alias("addresses")))


#: Measures of the report by the remainder of an event's number, whole numbers as above.
MEASURED = "map_from_arrays(array(0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11), array(" + ", ".join(f"'{m}'" for m in monitoring.HOST_METRICS) + "))"
VERSION, MODE = "CASE WHEN s_suppkey % 4 <> 0 THEN '1.' || (s_suppkey % 3) END", "CASE s_suppkey % 5 WHEN 0 THEN 'FULL_STACK' WHEN 1 THEN 'DISCOVERY' END"
#: Column to the SQL of its property; null where a host lacks it.
PROPERTIES = {
    "agent_version": VERSION, "agent_monitoring_mode": MODE, "agent_state": "CASE WHEN s_suppkey % 3 = 0 THEN 'RUNNING' WHEN s_suppkey % 7 <> 0 THEN 'UNKNOWN' END",
    "agent_auto_update": "CASE WHEN s_suppkey % 2 = 0 THEN 'ENABLED' END", "agent_update_status": "CASE WHEN s_suppkey % 4 = 1 THEN 'OUTDATED' ELSE 'UP2DATE' END",
    "os_type": "CASE WHEN s_suppkey % 2 = 0 THEN 'LINUX' ELSE 'WINDOWS' END", "os_version": "'v' || s_nationkey", "os_architecture": "CASE WHEN s_nationkey < 20 THEN 'X86' END", "hypervisor_type": "CASE WHEN s_suppkey % 6 = 1 THEN 'KVM' END",
    "cloud_type": "CASE WHEN s_nationkey % 3 = 0 THEN 'EC2' WHEN s_nationkey % 3 = 1 THEN 'AZURE' END", "cloud_provider": "CASE WHEN s_nationkey % 3 < 2 THEN 'cloud' || (s_nationkey % 3) END",
    "aws_instance_type": "CASE WHEN s_nationkey % 3 = 0 THEN 'm5.large' END", "azure_vm_size": "CASE WHEN s_nationkey % 3 = 1 THEN 'D2' END", "cpu_cores": "CASE WHEN s_suppkey % 11 <> 0 THEN '' || (s_suppkey % 16 + 1) END",
}
MEMORY, ADDRESSES = "s_suppkey % 64 * 1073741824 + s_suppkey * 1000", ("'10.0.0.' || s_nationkey", "'10.0.1.' || s_nationkey")
REPORT = f"""WITH {PROBLEMS}, want AS (SELECT lower(h) AS k, min(h) AS hostname FROM (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'HOST-' ELSE 'host-' END || (c_custkey % 700) AS h FROM customer) GROUP BY 1),
  known AS (SELECT s_suppkey AS entity_id, 'Host-' || (s_suppkey % 500) AS display_name, {", ".join(f"coalesce({v}, '') AS {c}" for c, v in PROPERTIES.items())}, round(CASE WHEN s_suppkey % 9 <> 0 THEN {MEMORY} END / 1073741824.0, 2) AS physical_memory_gb, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE {ADDRESSES[0]} || '; ' || {ADDRESSES[1]} END AS ip_addresses FROM supplier
    QUALIFY row_number() OVER (PARTITION BY s_suppkey % 500 ORDER BY s_suppkey DESC) = 1),
  g AS (SELECT entity_id, count(*) AS n, {WORST} AS worst, bool_or(severity IN ('PERFORMANCE', 'RESOURCE_CONTENTION')) AS slow, min(severity) AS f, array_to_string(list_sort(list(DISTINCT title))[1:3], '; ') AS titles FROM pb GROUP BY 1),
  m AS (SELECT user_id AS entity_id, {", ".join(f"max_by(round(value), struct_pack(ts, v := round(value))) FILTER (event_id % 12 = {k}) AS {c}" for k, c in enumerate(monitoring.HOST_METRICS))} FROM events WHERE value IS NOT NULL GROUP BY 1),
  r AS (SELECT hostname, display_name IS NOT NULL AS found, known.entity_id, display_name, CASE WHEN display_name IS NULL THEN NULL WHEN worst IS NULL THEN 'HEALTHY' WHEN worst IN ('ERROR', 'AVAILABILITY') THEN 'CRITICAL' ELSE 'WARNING' END AS health_state, CASE WHEN display_name IS NOT NULL THEN coalesce(n, 0) END AS open_problems,
    CASE WHEN display_name IS NULL THEN NULL WHEN worst IS NULL THEN 'NONE' WHEN worst IN ('ERROR', 'AVAILABILITY') THEN 'ERROR' WHEN slow THEN 'PERFORMANCE' ELSE f END AS highest_severity, CASE WHEN display_name IS NOT NULL THEN coalesce(titles, '') END AS problem_titles,
    agent_version <> '' OR agent_monitoring_mode IN ('FULL_STACK', 'INFRASTRUCTURE_ONLY') AS agent_installed, agent_state = 'RUNNING' AS agent_running, {", ".join(PROPERTIES)}, {", ".join(monitoring.HOST_METRICS)}, physical_memory_gb, ip_addresses
    FROM want LEFT JOIN known ON lower(display_name) = k LEFT JOIN g ON g.entity_id = known.entity_id LEFT JOIN m ON m.entity_id = known.entity_id)"""


def report(spark, d):
    c, s, e = (table(spark, d, t) for t in ("customer", "supplier", "events"))
    wanted = c.select(F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'HOST-' ELSE 'host-' END || (c_custkey % 700)").alias("hostname"))
    named = {p: PROPERTIES[c] for c, p in (monitoring.AGENT | monitoring.SYSTEM).items()} | {"physicalMemory": f"CAST(CASE WHEN s_suppkey % 9 <> 0 THEN {MEMORY} END AS STRING)"}
    given = F.filter(F.array(*[F.struct(F.lit(p).alias("k"), F.expr(v).alias("v")) for p, v in named.items()]), lambda x: x["v"].isNotNull())
    addresses = F.when(F.col("s_suppkey") % 5 != 0, F.array(*[F.expr(a) for a in ADDRESSES]))
    known = s.select(F.col("s_suppkey").alias("entity_id"), F.expr("'Host-' || (s_suppkey % 500)").alias("hostname"), F.map_from_entries(given).alias("properties"), addresses.alias("addresses"))
    series = e.select(F.col("user_id").alias("entity_id"), F.expr(f"{MEASURED}[CAST(event_id % 12 AS INT)]").alias("metric"), "ts", F.round("value").alias("value"))
    return monitoring.host_report(wanted, known, series, problems(spark, d))


@query("host_report", f"{REPORT} SELECT * FROM r")
def _(spark, d):
    return report(spark, d)


COUNTED = {("hosts", "checked"): "true", ("hosts", "found"): "found", ("hosts", "not_found"): "NOT found", **{("health", h.lower()): f"health_state = '{h}'" for h in ("HEALTHY", "WARNING", "CRITICAL")}, ("agent", "installed"): "agent_installed", ("agent", "not_installed"): "found AND NOT agent_installed", ("agent", "running"): "agent_running", ("agent", "not_running"): "agent_installed AND NOT agent_running"}


@query("host_report_summary", f"{REPORT} " + " UNION ALL ".join(f"SELECT '{s}' AS section, '{m}' AS measure, CAST(count(*) FILTER ({w}) AS DOUBLE) AS value FROM r" for (s, m), w in COUNTED.items()) + "".join(f" UNION ALL SELECT 'average', '{m}', round(avg({m}), 2) FROM r" for m in ("cpu_usage", "memory_usage", "disk_usage")) + " UNION ALL SELECT 'version', agent_version, CAST(count(*) AS DOUBLE) FROM r WHERE agent_version <> '' GROUP BY 2")
def _(spark, d):
    return monitoring.host_report_summary(report(spark, d))


# Bronze records and table changes.
FIELDS = {"number": "incident_number", "u_priority": "priority", "opened": "opened_at", "resolved": "resolved_at", "cmdb_ci": "component"}


def landed(spark, d):
    i = fixture(spark, d, "incidents")
    text = lambda c: F.when(F.col("incident_number") % 2 == 0, F.date_format(c, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(c, "dd/MM/yyyy HH:mm"))
    return i.select(F.col("incident_number").cast("string").alias("number"), F.col("priority_raw").alias("u_priority"), text("opened_at").alias("opened"), text("resolved_at").alias("resolved"), F.lit("x").alias("other"))


@query("bronze_incidents", oracle(" SELECT CAST(incident_number AS VARCHAR) AS incident_number, priority, opened_at, resolved_at, CAST(NULL AS VARCHAR) AS component, priority_raw AS payload_priority FROM incidents", "incidents"))
def _(spark, d):
    named = landing.renamed(landed(spark, d), FIELDS)
    b = landing.parsed_timestamps(incidents.bronze(named), ["opened_at", "resolved_at"], ("yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm"))
    return b.select("incident_number", "priority", "opened_at", "resolved_at", "component", F.get_json_object("raw_payload", "$.priority").alias("payload_priority"))


@query("watermark_read", oracle(" SELECT incident_number, ingestion_ts FROM incidents WHERE ingestion_ts > (SELECT max(ingestion_ts) FROM incidents WHERE state = 'Closed')", "incidents"))
def _(spark, d):
    i = fixture(spark, d, "incidents").select("incident_number", "state", "ingestion_ts")
    return tables.since_watermark(i, "ingestion_ts", i.where("state = 'Closed'"), "ingestion_ts").select("incident_number", "ingestion_ts")


@query("latest_runs", oracle(" SELECT state AS status, CAST(ingestion_ts AS TIMESTAMP) AS window_end FROM incidents ORDER BY window_end DESC, status DESC LIMIT 10", "incidents"))
def _(spark, d):
    return landing.latest_runs(fixture(spark, d, "incidents").select(F.col("state").alias("status"), F.col("ingestion_ts").alias("window_end")), 10)


@query("merge_available", oracle(f""" SELECT incident_number, CASE WHEN incident_number % 3 = 0 THEN 'Merged' ELSE state END AS state, vendor, CASE WHEN incident_number % 3 = 0 THEN {AS_OF} ELSE ingestion_ts END AS _processed_at FROM incidents
  UNION ALL SELECT NULL, 'Merged', NULL, {AS_OF}""", "incidents"))
def _(spark, d):
    i = fixture(spark, d, "incidents").select("incident_number", "state", "vendor", F.col("ingestion_ts").alias("_processed_at"))
    target = i.union(i.limit(1).select(F.lit(None).cast("long"), F.lit("Old"), F.lit(None).cast("string"), "_processed_at"))
    source = i.where("incident_number % 3 = 0").select("incident_number", F.lit("Merged").alias("state")).union(i.limit(1).select(F.lit(None).cast("long"), F.lit("Merged")))
    return tables.merge_available(target, source, ["incident_number"], now())


NULLED = "CASE WHEN incident_number % 4 = 0 THEN NULL ELSE state END"


@query("state_changes_null", oracle(f" SELECT incident_number, from_state, to_state FROM (SELECT incident_number, state AS from_state, {NULLED} AS to_state FROM incidents WHERE incident_number % 3 = 0) WHERE from_state IS DISTINCT FROM to_state", "incidents"))
def _(spark, d):
    i = fixture(spark, d, "incidents").select("incident_number", "state", "ingestion_ts")
    return incidents.state_changes(i.where("incident_number % 3 = 0").withColumn("state", F.expr(NULLED)), i).select("incident_number", "from_state", "to_state")


@query("legs_with_agent", oracle(f"{P} SELECT conversation_id, participant_id, agent_id, team FROM p LEFT JOIN (SELECT s_suppkey AS agent_id, 'team' || s_nationkey AS team FROM supplier WHERE s_suppkey % 3 <> 0) USING (agent_id) WHERE agent_id IS NOT NULL", "participants"))
def _(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("agent_id"), F.concat(F.lit("team"), F.col("s_nationkey").cast("string")).alias("team"), (F.col("s_suppkey") % 3 != 0).alias("is_current"))
    old = s.withColumn("is_current", F.lit(False)).withColumn("team", F.lit("former"))
    legs = latest(spark, d).where("agent_id is not null")
    return calls.with_current_agent(legs, s.union(old), "team").select("conversation_id", "participant_id", "agent_id", "team")


# Lists and reports.
@query("rpt_agent_impacting", oracle(f"{FACTS} SELECT incident_number, priority, service, resolution_status, resolution_pct, resolution_target FROM f WHERE is_open AND is_agent_facing AND resolution_status IN ('AT_RISK', 'IN_PROGRESS')", *THREE))
def _(spark, d):
    return incidents.agent_impacting(all_facts(spark, d)).select("incident_number", "priority", "service", "resolution_status", "resolution_pct", "resolution_target")


@query("rpt_vendor_sla", oracle(f"{FACTS} SELECT vendor, CAST(sum(total) AS BIGINT) AS total, round(avg(response_compliance), 1) AS response_pct, round(avg(resolution_compliance), 1) AS resolution_pct, round(avg(avg_response_minutes), 1) AS avg_resp_min, round(avg(worst_resolution), 1) AS worst_resolution_min FROM ({sla_sql('incident_date, vendor, priority', 'service_type = ' + chr(39) + 'VENDOR' + chr(39))}) WHERE vendor IS NOT NULL AND incident_date >= DATE '2001-07-02' GROUP BY 1", *THREE))
def _(spark, d):
    daily = incidents.sla_by(all_facts(spark, d).where("service_type = 'VENDOR'"), "incident_date", "vendor", "priority")
    return incidents.vendor_report(daily, F.to_date(F.lit("2001-07-02")))


@query("rpt_open_list", oracle(f"{FACTS} SELECT incident_number, priority, risk, row_number() OVER (ORDER BY CASE priority WHEN 'P0' THEN 0 WHEN 'P1' THEN 1 WHEN 'P2' THEN 2 WHEN 'P3' THEN 3 WHEN 'P4' THEN 4 ELSE 9 END, time_open DESC, incident_number) AS place FROM ({OPEN}) ORDER BY place", *THREE))
def _(spark, d):
    top = incidents.dashboard(incidents.open_incidents(all_facts(spark, d), now()))
    rank = F.coalesce(*[F.when(F.col("priority") == p, k) for k, p in enumerate(incidents.PRIORITY_ORDER)], F.lit(9))
    return top.withColumn("place", F.row_number().over(Window.orderBy(rank, F.desc("time_open"), "incident_number")).cast("long")).select("incident_number", "priority", "risk", "place")


@query("rpt_overall_sla", oracle(f"{FACTS}, m AS (SELECT priority, count(*) AS total, count(*) FILTER (coalesce(resolution_minutes > resolution_target, false)) AS breaches FROM f GROUP BY 1) SELECT CAST(sum(total) AS BIGINT) AS total, CAST(sum(breaches) AS BIGINT) AS breaches, round(avg(round((total - breaches) * 100.0 / total, 2)), 2) AS avg_compliance FROM m", *THREE))
def _(spark, d):
    return incidents.overall(incidents.metrics_by_priority(all_facts(spark, d)))


@query("business_hours_sla", oracle(f"""{FACTS} SELECT incident_number, priority, round({{0}}, 2) AS resolution_minutes FROM f""".replace("{0}", "resolution_minutes") , *THREE).replace("round(resolution_minutes, 2)", "CASE WHEN priority IN ('P3', 'P4') THEN round(CAST((epoch(resolved_at) - epoch(opened_at)) / 60.0 AS DOUBLE) * ((540.0 / 1440) * (5.0 / 7)), 2) ELSE resolution_minutes END"))
def _(spark, d):
    targets = fixture(spark, d, "targets").withColumn("business_hours_only", F.col("priority").isin("P3", "P4"))
    return incidents.facts(fixture(spark, d, "incidents").drop("priority_raw"), targets, fixture(spark, d, "services"), now()).select("incident_number", "priority", "resolution_minutes")


@query("dq_window_counts", f"SELECT count(*) AS total, count(*) FILTER (ts >= {EST} - INTERVAL 24 HOURS AND ts < {EST}) AS recent, min(ts) AS first_time, max(ts) AS last_time FROM events")
def _(spark, d):
    return quality.window_counts(table(spark, d, "events"), "ts", F.expr(EST).cast("timestamp_ntz"))


@query("dq_sample_rows", "SELECT event_id, user_id, event_type FROM events ORDER BY ts, event_id LIMIT 5")
def _(spark, d):
    return quality.sample_rows(table(spark, d, "events"), 5, "ts", "event_id").select("event_id", "user_id", "event_type")
