"""Call quality, incidents and their correlation over the fixtures, with SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslake.functions import rules
from opslake.operators import calls, correlation, incidents, tables
from opslake.plans.fixtures import AS_OF, fixture, oracle
from opslake.plans.registry import ORACLES, query, table

def now():
    """The fixed time that stands for the present."""
    return F.expr(AS_OF).cast("timestamp_ntz")


P = """, p AS (SELECT *, CASE WHEN error_code IS NOT NULL OR mos < 2.0 THEN 'ERRORED' WHEN mos < 3.5 THEN 'DEGRADED' ELSE 'NORMAL' END AS call_status, CAST(start_ts AS DATE) AS call_date
  FROM (SELECT *, row_number() OVER (PARTITION BY conversation_id, purpose, participant_id ORDER BY ingestion_ts DESC NULLS LAST, mos ASC NULLS LAST, error_code DESC NULLS LAST, agent_id DESC NULLS LAST, vendor DESC NULLS LAST, start_ts DESC NULLS LAST) AS rn FROM participants) WHERE rn = 1)"""
MIN = lambda a, b: f"CAST((epoch({b}) - epoch({a})) / 60.0 AS DOUBLE)"


def _facts() -> str:
    cols = ""
    for w, e in (("response", "responded_at"), ("resolution", "resolved_at")):
        pct = f"CASE WHEN {w}_target > 0 THEN round(coalesce({MIN('opened_at', e)}, {MIN('opened_at', AS_OF)}) / {w}_target * 100, 2) END"
        cols += f""", round({MIN('opened_at', e)}, 2) AS {w}_minutes, {pct} AS {w}_pct, CASE WHEN {e} IS NOT NULL AND {pct} <= 100 THEN 'MET' WHEN {pct} > 100 THEN 'BREACHED' WHEN {e} IS NULL AND {pct} > 80 THEN 'AT_RISK' ELSE 'IN_PROGRESS' END AS {w}_status"""
    return f""", f AS (SELECT i.*, response_target, resolution_target, coalesce(service_type, 'OTHER') AS service_type, coalesce(is_agent_facing, false) AS is_agent_facing, platform_component, CAST(opened_at AS DATE) AS incident_date,
      coalesce(state NOT IN ('Resolved', 'Closed', 'Canceled'), true) AS is_open {cols}
      FROM (SELECT *, row_number() OVER (PARTITION BY incident_number ORDER BY ingestion_ts DESC NULLS LAST, state DESC NULLS LAST) AS rn FROM incidents) i LEFT JOIN targets USING (priority) LEFT JOIN services USING (service) WHERE rn = 1)"""


FACTS = _facts()
SHARES = ", ".join(f"round({s}_calls * 100.0 / nullif(total_calls, 0), 2) AS {s}_pct" for s in ("normal", "degraded", "errored"))
COUNTS = "count(*) AS total_calls, " + ", ".join(f"count(*) FILTER (call_status = '{s.upper()}') AS {s}_calls" for s in ("normal", "degraded", "errored"))


def by(dims: str, source: str = "p") -> str:
    return f"SELECT *, {SHARES} FROM (SELECT {dims}, {COUNTS} FROM {source} GROUP BY {dims})"


def latest(spark, d):
    return calls.participants_latest(fixture(spark, d, "participants"))


def all_facts(spark, d):
    return incidents.facts(fixture(spark, d, "incidents").drop("priority_raw"), fixture(spark, d, "targets"), fixture(spark, d, "services"), now())


@query("participants_latest", oracle(f"{P} SELECT conversation_id, participant_id, purpose, agent_id, vendor, mos, error_code, call_status, call_date FROM p", "participants"))
def _(spark, d):
    return latest(spark, d).select("conversation_id", "participant_id", "purpose", "agent_id", "vendor", "mos", "error_code", "call_status", "call_date")


@query("classify_calls", oracle(f"{P} SELECT call_status, purpose, count(*) AS n FROM p GROUP BY ALL", "participants"))
def _(spark, d):
    return latest(spark, d).groupBy("call_status", "purpose").agg(F.count("*").alias("n"))


@query("flatten_conversations", oracle(""" SELECT conversation_id, participant_id, purpose, CASE WHEN purpose = 'agent' THEN agent_id END AS agent_id, division, vendor, mos, error_code,
   CAST(epoch(max(end_ts) OVER (PARTITION BY conversation_id)) - epoch(min(start_ts) OVER (PARTITION BY conversation_id)) AS BIGINT) AS duration_seconds
   FROM (SELECT *, min(division) OVER (PARTITION BY conversation_id) AS d0 FROM participants) x""".replace("agent_id, division,", "agent_id, d0 AS division,"), "participants"))
def _(spark, d):
    p = fixture(spark, d, "participants")
    metric = F.array(F.struct(F.lit("nJitter").alias("name"), F.lit(1.0).alias("value")), F.struct(F.lit("nMos").alias("name"), F.col("mos").alias("value")))
    session = F.array(F.struct(F.col("vendor"), F.col("error_code"), metric.alias("metrics")))
    one = F.struct("participant_id", "purpose", F.col("agent_id").alias("user_id"), session.alias("sessions"))
    nested = p.groupBy("conversation_id").agg(F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"), F.sort_array(F.collect_set("division")).alias("divisions"), F.collect_list(one).alias("participants"))
    return calls.flatten_conversations(nested)


RANK = "max(CASE call_status WHEN 'ERRORED' THEN 2 WHEN 'DEGRADED' THEN 1 ELSE 0 END) FILTER (purpose = '{}')"
NAME = "CASE {} WHEN 2 THEN 'ERRORED' WHEN 1 THEN 'DEGRADED' WHEN 0 THEN 'NORMAL' END"


@query("conversation_rollup", oracle(f"""{P} SELECT conversation_id, agent_id, {NAME.format('a')} AS agent_status, {NAME.format('c')} AS customer_status, {NAME.format('greatest(a, c)')} AS overall_status, vendor, location_key, start_ts, end_ts, participant_count
  FROM (SELECT conversation_id, max(agent_id) FILTER (purpose = 'agent') AS agent_id, {RANK.format('agent')} AS a, {RANK.format('customer')} AS c, max(vendor) AS vendor, max(location_key) AS location_key, min(start_ts) AS start_ts, max(end_ts) AS end_ts, count(*) AS participant_count FROM p GROUP BY conversation_id)""", "participants"))
def _(spark, d):
    return calls.conversation_rollup(latest(spark, d))


@query("agent_legs", oracle(f"{P} SELECT conversation_id, participant_id, agent_id, n AS leg_sequence, n > 1 AS is_transfer FROM (SELECT *, CAST(row_number() OVER (PARTITION BY conversation_id ORDER BY start_ts, participant_id) AS INTEGER) AS n FROM p WHERE purpose = 'agent' AND agent_id IS NOT NULL)", "participants"))
def _(spark, d):
    return calls.agent_legs(latest(spark, d)).select("conversation_id", "participant_id", "agent_id", "leg_sequence", "is_transfer")


@query("agent_scd2", oracle(f"""{P}, prof AS (SELECT agent_id, max(division) FILTER (start_ts < TIMESTAMP '1999-01-01 00:00:00') AS d1, max(division) FILTER (start_ts >= TIMESTAMP '1999-01-01 00:00:00') AS d2 FROM p WHERE agent_id IS NOT NULL GROUP BY 1)
  SELECT agent_id, d1 AS division, DATE '1998-01-01' AS effective_from, CASE WHEN d2 IS NOT NULL AND d1 <> d2 THEN DATE '1999-01-01' ELSE DATE '9999-12-31' END AS effective_to, NOT (d2 IS NOT NULL AND d1 <> d2) AS is_current FROM prof WHERE d1 IS NOT NULL
  UNION ALL SELECT agent_id, d2, DATE '1999-01-01', DATE '9999-12-31', true FROM prof WHERE d2 IS NOT NULL AND (d1 IS NULL OR d1 <> d2)""", "participants"))
def _(spark, d):
    p = latest(spark, d).where("agent_id is not null")
    half = lambda c: p.where(c).groupBy("agent_id").agg(F.max("division").alias("division"))
    day = lambda x: F.to_date(F.lit(x))
    first = half("start_ts < TIMESTAMP '1999-01-01 00:00:00'").select("agent_id", "division", day("1998-01-01").alias("effective_from"), day("9999-12-31").alias("effective_to"), F.lit(True).alias("is_current"))
    return tables.scd2(first, half("start_ts >= TIMESTAMP '1999-01-01 00:00:00'"), "agent_id", ["division"], day("1999-01-01"))


HISTORY = "SELECT agent_id, CAST(start_ts AS DATE) AS effective_from, max({'t': start_ts, 'p': {'division': division, 'location_key': location_key}}) AS last FROM p WHERE agent_id IS NOT NULL GROUP BY 1, 2"


@query("agent_dimension", oracle(f"""{P}, d AS (SELECT agent_id, effective_from, last.p AS p, lag(last.p) OVER (PARTITION BY agent_id ORDER BY effective_from) AS b FROM ({HISTORY})),
  v AS (SELECT *, lead(effective_from) OVER (PARTITION BY agent_id ORDER BY effective_from) AS nxt FROM d WHERE b IS NULL OR p IS DISTINCT FROM b)
  SELECT agent_id, p.division AS division, p.location_key AS location_key, effective_from, coalesce(nxt, DATE '9999-12-31') AS effective_to, nxt IS NULL AS is_current FROM v""", "participants"))
def _(spark, d):
    return tables.dimension_history(latest(spark, d), "agent_id", "start_ts", ["division", "location_key"])


#: A batch with the later participants of conversations, some of which have no other ones; those without a key came first.
LATE = "coalesce(participant_id % 4 = 3, false) OR coalesce(conversation_id % 7 = 0, false)"


def incremental(spark, d, build):
    """The result of a first run without the late participants, brought up to date by the keys that they touch."""
    p = latest(spark, d)
    return tables.rebuild_touched(build(p.where(f"NOT ({LATE})")), p, p.where(LATE), "conversation_id", build)


@query("conversation_rebuild", ORACLES["conversation_rollup"])
def _(spark, d):
    return incremental(spark, d, calls.conversation_rollup)


@query("agent_legs_rebuild", ORACLES["agent_legs"])
def _(spark, d):
    return incremental(spark, d, calls.agent_legs).select("conversation_id", "participant_id", "agent_id", "leg_sequence", "is_transfer")


@query("call_quality_daily", oracle(f"{P} {by('call_date')}", "participants"))
def _(spark, d):
    return calls.quality_by(latest(spark, d), "call_date")


GEO = P + ", g AS (SELECT p.*, coalesce(country, 'Unknown') AS country, coalesce(continent, 'Unknown') AS continent FROM p LEFT JOIN locations USING (location_key))"


@query("vendor_location_daily", oracle(f"{GEO} {by('call_date, vendor, country, continent', 'g')}", "participants", "locations"))
def _(spark, d):
    return calls.quality_by(calls.with_geography(latest(spark, d), fixture(spark, d, "locations")), "call_date", "vendor", "country", "continent")


for _dim in ("country", "continent"):

    @query(f"vendor_by_{_dim}", oracle(f"{GEO} {by(f'call_date, vendor, {_dim}', 'g')}", "participants", "locations"))
    def _(spark, d, dim=_dim):
        low = calls.quality_by(calls.with_geography(latest(spark, d), fixture(spark, d, "locations")), "call_date", "vendor", "country", "continent")
        return calls.reaggregate(low, "call_date", "vendor", dim)


FLAGGED = f"SELECT *, CASE WHEN errored_pct > 10 AND degraded_pct > 20 THEN 'BOTH' WHEN errored_pct > 10 THEN 'ERRORED_HIGH' ELSE 'DEGRADED_HIGH' END AS flag_reason FROM ({by('call_date, agent_id', 'p WHERE agent_id IS NOT NULL')}) WHERE errored_pct > 10 OR degraded_pct > 20"


@query("agents_flagged", oracle(f"{P} {FLAGGED}", "participants"))
def _(spark, d):
    return calls.agents_flagged(latest(spark, d))


@query("agents_flagged_cleanup", oracle(f"{P}, q AS ({by('call_date, agent_id', 'p WHERE agent_id IS NOT NULL')}) SELECT call_date, agent_id, errored_pct, degraded_pct FROM q WHERE errored_pct > 10 OR degraded_pct > 20 OR call_date < DATE '2000-01-01'", "participants"))
def _(spark, d):
    q = calls.quality_by(latest(spark, d).where("agent_id is not null"), "call_date", "agent_id").select("call_date", "agent_id", "errored_pct", "degraded_pct")
    return tables.delete_stale(q, q.where("errored_pct > 10 or degraded_pct > 20"), ["call_date", "agent_id"], F.col("call_date") >= F.to_date(F.lit("2000-01-01")))


@query("agent_performance_detail", oracle(f"{P} SELECT call_date, agent_id, {COUNTS}, to_json(list(struct_pack(conversation_id, participant_id, call_status) ORDER BY conversation_id, participant_id, call_status)) AS legs FROM p WHERE agent_id IS NOT NULL GROUP BY 1, 2", "participants"))
def _(spark, d):
    return calls.agent_performance_detail(latest(spark, d)).withColumn("legs", F.to_json("legs"))


@query("normalize_priority", oracle(" SELECT incident_number, 'P' || priority_raw AS priority FROM incidents", "incidents"))
def _(spark, d):
    return fixture(spark, d, "incidents").select("incident_number", rules.normalize_priority(F.col("priority_raw")).alias("priority"))


@query("parse_timestamps", oracle(" SELECT incident_number, opened_at AS parsed FROM incidents", "incidents"))
def _(spark, d):
    i = fixture(spark, d, "incidents")
    text = F.when(F.col("incident_number") % 2 == 0, F.date_format("opened_at", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("opened_at", "dd/MM/yyyy HH:mm"))
    parsed = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in ("yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm")])
    return i.select("incident_number", parsed.cast("timestamp_ntz").alias("parsed"))


FACT_COLUMNS = ["incident_number", "priority", "state", "service_type", "is_agent_facing", "incident_date", "is_open", "response_minutes", "response_pct", "response_status", "resolution_minutes", "resolution_pct", "resolution_status"]


@query("incident_facts", oracle(f"{FACTS} SELECT {', '.join(FACT_COLUMNS)} FROM f", "incidents", "targets", "services"))
def _(spark, d):
    return all_facts(spark, d).select(FACT_COLUMNS)


BATCHES = "incident_number % 3 = 0", "CASE state WHEN 'New' THEN 'In Progress' ELSE state END"


@query("incident_upsert", oracle(f""" SELECT incident_number, CASE WHEN {BATCHES[0]} AND incident_number % 2 = 0 THEN {BATCHES[1]} ELSE state END AS state,
  CASE WHEN {BATCHES[0]} AND incident_number % 2 = 0 THEN ingestion_ts + INTERVAL '1' HOUR ELSE ingestion_ts END AS ingestion_ts FROM incidents
  UNION ALL SELECT -incident_number - 1, state, ingestion_ts FROM incidents WHERE incident_number % 10 = 0""", "incidents"))
def _(spark, d):
    i = fixture(spark, d, "incidents").select("incident_number", "state", "ingestion_ts")
    shift = F.when(F.col("incident_number") % 2 == 0, F.expr("ingestion_ts + INTERVAL '1' HOUR")).otherwise(F.col("ingestion_ts"))
    known = i.where(BATCHES[0]).select("incident_number", F.expr(BATCHES[1]).alias("state"), shift.alias("ingestion_ts"))
    new = i.where("incident_number % 10 = 0").select((-F.col("incident_number") - 1).alias("incident_number"), "state", "ingestion_ts")
    return tables.upsert(i, known.union(new), ["incident_number"], newer="ingestion_ts")


@query("state_changes", oracle(f" SELECT incident_number, state AS from_state, {BATCHES[1]} AS to_state, 90.0 AS minutes_in_state FROM incidents WHERE {BATCHES[0]} AND state = 'New'".replace("90.0", "CAST(90.0 AS DOUBLE)"), "incidents"))
def _(spark, d):
    i = fixture(spark, d, "incidents").select("incident_number", "state", "ingestion_ts")
    batch = i.where(BATCHES[0]).select("incident_number", F.expr(BATCHES[1]).alias("state"), F.expr("ingestion_ts + INTERVAL '90' MINUTE").alias("ingestion_ts"))
    return incidents.state_changes(batch, i)


STATES = """ SELECT l_orderkey AS incident_number, CASE WHEN l_quantity < 4 THEN NULL WHEN l_quantity < 20 THEN 'New' WHEN l_quantity < 35 THEN 'In Progress' ELSE 'Resolved' END AS state,
  l_shipdate + CAST(l_partkey % 3 AS INTEGER) * INTERVAL '5' HOUR AS ingestion_ts FROM lineitem"""


@query("state_transitions", f"""WITH h AS ({STATES}), b AS (SELECT *, lag({{'s': state}}) OVER w AS before FROM h WINDOW w AS (PARTITION BY incident_number ORDER BY ingestion_ts, state NULLS FIRST)),
  c AS (SELECT *, lag(ingestion_ts) OVER (PARTITION BY incident_number ORDER BY ingestion_ts, state NULLS FIRST) AS since FROM b WHERE before IS NULL OR state IS DISTINCT FROM before.s)
  SELECT incident_number, before.s AS from_state, state AS to_state, ingestion_ts AS "at", round({MIN('since', 'ingestion_ts')}, 2) AS minutes FROM c WHERE before IS NOT NULL""")
def _(spark, d):
    return incidents.transitions(spark.sql(STATES.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, d, "lineitem")))


BUSINESS = f""", day AS (SELECT incident_number, CAST(unnest(generate_series(CAST(opened_at AS DATE), CAST(resolved_at AS DATE), INTERVAL 1 DAY)) AS TIMESTAMP) AS d FROM outages WHERE resolved_at >= opened_at),
  m AS (SELECT incident_number, sum(greatest(0.0, epoch(least(resolved_at, d + INTERVAL 18 HOUR)) - epoch(greatest(opened_at, d + INTERVAL 9 HOUR))) / 60.0) FILTER (isodow(d) <= 5) AS minutes FROM outages JOIN day USING (incident_number) GROUP BY 1)"""


@query("business_minutes", oracle(f"{BUSINESS} SELECT incident_number, round(coalesce(minutes, 0.0), 4) AS minutes FROM m", "outages"))
def _(spark, d):
    done = fixture(spark, d, "outages").where("resolved_at >= opened_at")
    return done.select("incident_number", F.round(rules.business_minutes(F.col("opened_at"), F.col("resolved_at")), 4).alias("minutes"))


@query("calendar_sla", oracle(f"""{BUSINESS} SELECT incident_number, o.priority, round(CASE WHEN o.priority IN ('P3', 'P4') THEN coalesce(minutes, 0.0) ELSE {MIN('opened_at', 'resolved_at')} END, 2) AS resolution_minutes,
  round(CASE WHEN o.priority IN ('P3', 'P4') THEN coalesce(minutes, 0.0) ELSE {MIN('opened_at', 'resolved_at')} END / resolution_target * 100, 2) AS resolution_pct FROM outages o JOIN targets USING (priority) JOIN m USING (incident_number) WHERE resolved_at >= opened_at""", "outages", "targets"))
def _(spark, d):
    goals = fixture(spark, d, "targets").withColumn("business_hours_only", F.col("priority").isin("P3", "P4"))
    done = fixture(spark, d, "outages").where("resolved_at >= opened_at and priority <> 'P0'")
    return incidents.sla_measures(done, goals, now(), calendar=True).select("incident_number", "priority", "resolution_minutes", "resolution_pct")


def sla_sql(dims: str, where: str = "true") -> str:
    out, comp = "", ""
    for w in ("response", "resolution"):
        out += f", count(*) FILTER ({w}_status = 'MET') AS {w}_met, count(*) FILTER ({w}_status = 'BREACHED') AS {w}_breached, count(*) FILTER ({w}_status IN ('IN_PROGRESS', 'AT_RISK')) AS {w}_pending, round(avg({w}_minutes), 2) AS avg_{w}_minutes"
        comp += f", round({w}_met * 100.0 / nullif({w}_met + {w}_breached, 0), 2) AS {w}_compliance"
    return f"SELECT *{comp} FROM (SELECT {dims}, count(*) AS total{out}, count(*) FILTER (is_open) AS open_count, max(resolution_minutes) AS worst_resolution, round(avg(resolution_minutes) FILTER (NOT is_open), 2) AS mttr FROM f WHERE {where} GROUP BY {dims})"


for _name, _dims, _where in (
    ("gold_sla_summary", ["incident_date", "priority"], "true"),
    ("platform_impact_daily", ["incident_date", "service", "platform_component", "priority"], "service_type = 'PLATFORM'"),
    ("agent_impact_daily", ["incident_date", "service", "priority"], "is_agent_facing"),
    ("vendor_sla_daily", ["incident_date", "vendor", "priority"], "service_type = 'VENDOR' AND vendor IS NOT NULL"),
):

    @query(_name, oracle(f"{FACTS} {sla_sql(', '.join(_dims), _where)}", "incidents", "targets", "services"))
    def _(spark, d, dims=tuple(_dims), where=_where):
        return incidents.sla_by(all_facts(spark, d).where(where), *dims)


STATE_CODES = "CASE WHEN incident_number % 2 = 0 THEN CASE state WHEN 'New' THEN '1' WHEN 'In Progress' THEN '2' ELSE '7' END WHEN incident_number % 5 = 0 THEN 'Resolved' WHEN incident_number % 31 <> 0 THEN state END"


@query("state_counts", oracle(f" SELECT priority, count(*) AS total, count(*) FILTER (s IN ('Resolved', '6')) AS resolved_count, count(*) FILTER (s IN ('Closed', '7')) AS closed_count, count(*) FILTER (s IN ('New', 'In Progress', 'On Hold', '1', '2', '3')) AS open_count FROM (SELECT *, {STATE_CODES} AS s FROM incidents) GROUP BY 1", "incidents"))
def _(spark, d):
    return incidents.state_counts(fixture(spark, d, "incidents").withColumn("state", F.expr(STATE_CODES)), "priority")


RESPONSES = "CASE WHEN incident_number % 3 = 0 THEN NULL ELSE responded_at END AS response_time_ts, ingestion_ts AS work_start_ts"


@query("latest_incident", oracle(f""" SELECT incident_number, state, response_time_ts AS first_response_ts, round({MIN('opened_at', 'response_time_ts')}, 2) AS response_minutes, coalesce(response_time_ts, work_start_ts) AS any_response_ts
  FROM (SELECT *, {RESPONSES}, row_number() OVER (PARTITION BY incident_number % 5000 ORDER BY ingestion_ts DESC, incident_number DESC) AS k FROM incidents) WHERE k = 1""", "incidents"))
def _(spark, d):
    raw = fixture(spark, d, "incidents").selectExpr("*", *RESPONSES.split(", ")).withColumn("number", F.col("incident_number") % 5000)
    chosen = incidents.latest_incident(raw, "number", "ingestion_ts", "incident_number")
    anyway = incidents.latest_incident(raw, "number", "ingestion_ts", "incident_number", filled=True)
    return chosen.select("incident_number", "state", "first_response_ts", "response_minutes").join(anyway.select("incident_number", F.col("first_response_ts").alias("any_response_ts")), "incident_number")


OPEN = f"""SELECT incident_number, priority, service, vendor, round({MIN('opened_at', AS_OF)}, 2) AS time_open, greatest(0.0, response_target - coalesce(response_minutes, {MIN('opened_at', AS_OF)})) AS response_remaining,
  greatest(0.0, resolution_target - {MIN('opened_at', AS_OF)}) AS resolution_remaining, CASE WHEN 'BREACHED' IN (response_status, resolution_status) THEN 'BREACHED' WHEN 'AT_RISK' IN (response_status, resolution_status) THEN 'AT_RISK' ELSE 'HEALTHY' END AS risk FROM f WHERE is_open"""


@query("open_incidents", oracle(f"{FACTS} {OPEN}", "incidents", "targets", "services"))
def _(spark, d):
    return incidents.open_incidents(all_facts(spark, d), now())


@query("sla_breach_flags", oracle(f"{FACTS} SELECT incident_number, priority, response_minutes > response_target AS response_breached, round(response_target - coalesce(response_minutes, {MIN('opened_at', AS_OF)}), 2) AS response_remaining, resolution_minutes > resolution_target AS resolution_breached, round(resolution_target - coalesce(resolution_minutes, {MIN('opened_at', AS_OF)}), 2) AS resolution_remaining FROM f", "incidents", "targets", "services"))
def _(spark, d):
    return incidents.breach_flags(all_facts(spark, d), now())


@query("sla_metrics_by_priority", oracle(f"{FACTS} SELECT *, round((total - breaches) * 100.0 / total, 2) AS compliance FROM (SELECT priority, count(*) AS total, count(*) FILTER (coalesce(resolution_minutes > resolution_target, false)) AS breaches, round(avg(resolution_minutes), 2) AS avg_minutes, min(resolution_minutes) AS min_minutes, max(resolution_minutes) AS max_minutes, round(median(resolution_minutes), 2) AS median_minutes, max(resolution_target) AS target, count(*) FILTER (NOT is_open) AS closed FROM f GROUP BY priority)", "incidents", "targets", "services"))
def _(spark, d):
    return incidents.metrics_by_priority(all_facts(spark, d))


LOCATED = GEO + f""", q AS ({by('call_date, vendor, location_key, country, continent', 'g')})"""
SPANS = f"(SELECT *, upper(vendor) AS vkey, coalesce(resolved_at, {AS_OF}) AS ended_at FROM outages WHERE vendor IS NOT NULL AND opened_at <= coalesce(resolved_at, {AS_OF}))"
ACTIVE = f""", a AS (SELECT vkey, active_date, count(*) AS active_incidents, count(*) FILTER (priority IN ('P0', 'P1')) AS p0_p1_incidents, count(*) FILTER (priority = 'P2') AS p2_incidents, count(*) FILTER (priority IN ('P3', 'P4')) AS p3_p4_incidents, list_sort(list(incident_number)) AS incident_numbers
  FROM (SELECT *, CAST(unnest(generate_series(CAST(opened_at AS DATE), least(CAST(ended_at AS DATE), CAST(opened_at AS DATE) + 30), INTERVAL 1 DAY)) AS DATE) AS active_date FROM {SPANS}) GROUP BY 1, 2)"""
DAILY = f"""{LOCATED}{ACTIVE}, daily AS (SELECT q.*, coalesce(active_incidents, 0) AS active_incidents, coalesce(p0_p1_incidents, 0) AS p0_p1_incidents, coalesce(p2_incidents, 0) AS p2_incidents, coalesce(p3_p4_incidents, 0) AS p3_p4_incidents, array_to_string(coalesce(incident_numbers, []), ',') AS incident_numbers,
  coalesce(active_incidents, 0) > 0 AS has_active_incident, coalesce(p0_p1_incidents, 0) > 0 AS has_critical_incident, (errored_pct > 0 OR degraded_pct > 0) AND coalesce(active_incidents, 0) > 0 AS degradation_with_incident
  FROM q LEFT JOIN a ON upper(q.vendor) = a.vkey AND q.call_date = a.active_date)"""
CORRELATED = ("participants", "locations", "outages")


def daily(spark, d):
    located = calls.with_geography(latest(spark, d), fixture(spark, d, "locations"))
    quality = calls.quality_by(located, "call_date", "vendor", "location_key", "country", "continent")
    return correlation.call_incident_daily(quality, correlation.daily_incidents(fixture(spark, d, "outages"), now()))


@query("call_incident_daily", oracle(f"{DAILY} SELECT * FROM daily", *CORRELATED))
def _(spark, d):
    return daily(spark, d).withColumn("incident_numbers", F.concat_ws(",", F.transform("incident_numbers", lambda x: x.cast("string"))))


@query("correlation_stats", oracle(f"{DAILY} SELECT count(*) AS total_rows, count(*) FILTER (degradation_with_incident) AS degradation_with_incident_rows, count(*) FILTER (has_critical_incident) AS critical_incident_rows FROM daily", *CORRELATED))
def _(spark, d):
    return correlation.correlation_stats(daily(spark, d))


PREVIEW = "call_date, vendor, location_key, errored_pct, degraded_pct, active_incidents"


@query("correlation_preview", oracle(f"{DAILY} SELECT {PREVIEW} FROM daily WHERE degradation_with_incident ORDER BY call_date DESC, errored_pct DESC NULLS LAST, vendor, location_key LIMIT 20", *CORRELATED))
def _(spark, d):
    return correlation.correlation_preview(daily(spark, d)).select(PREVIEW.split(", "))


CONVERSATIONS = f""", c AS (SELECT conversation_id, {NAME.format('greatest(a, c)')} AS overall_status, vendor, location_key, CAST(start_ts AS DATE) AS call_date, start_ts, start_ts + participant_count * INTERVAL 7 MINUTE AS end_ts
  FROM (SELECT conversation_id, {RANK.format('agent')} AS a, {RANK.format('customer')} AS c, max(vendor) AS vendor, max(location_key) AS location_key, min(start_ts) AS start_ts, count(*) AS participant_count FROM p GROUP BY conversation_id))"""
OVERLAP = f"FROM (SELECT * FROM c WHERE overall_status IN ('DEGRADED', 'ERRORED')) c {{}} JOIN {SPANS} i ON upper(c.vendor) = i.vkey AND i.opened_at <= c.end_ts + INTERVAL 1 HOUR AND i.ended_at >= c.start_ts - INTERVAL 1 HOUR"


def conversations(spark, d):
    """The rows of a conversation lie weeks apart in the given tables; here it lasts as long as its participants one after the other."""
    # Dealt by conversation at once, rows needn't be shuffled again for the rollup.
    p = calls.participants_latest(fixture(spark, d, "participants").repartition("conversation_id"))
    return calls.conversation_rollup(p).withColumn("end_ts", F.expr("start_ts + participant_count * INTERVAL '7' MINUTE"))


DETAIL = ["conversation_id", "call_date", "overall_status", "country", "continent", "incident_number", "incident_priority", "incident_state", "service", "opened_at", "resolved_at"]


@query("call_incident_detail", oracle(f"{P}{CONVERSATIONS} SELECT conversation_id, call_date, overall_status, coalesce(country, 'Unknown') AS country, coalesce(continent, 'Unknown') AS continent, incident_number, i.priority AS incident_priority, i.state AS incident_state, service, opened_at, resolved_at {OVERLAP.format('')} LEFT JOIN locations USING (location_key)", *CORRELATED))
def _(spark, d):
    located = calls.with_geography(conversations(spark, d).withColumn("call_date", F.to_date("start_ts")), fixture(spark, d, "locations"))
    pairs = correlation.overlaps(located, fixture(spark, d, "outages"), now())
    of = lambda c: F.col(f"incident.{c}")
    return pairs.withColumns({"incident_number": of("incident_number"), "incident_priority": of("priority"), "incident_state": of("state"), "service": of("service"), "opened_at": of("opened_at"), "resolved_at": of("resolved_at")}).select(DETAIL)


def share(part: str) -> str:
    return f"round({part} * 100.0 / nullif(total_degraded_calls, 0), 2)"


EXPLAINED = f"total_degraded_calls, calls_with_incident, calls_with_critical_incident, total_degraded_calls - calls_with_incident AS calls_without_incident, {share('calls_with_incident')} AS pct_explained_by_incident, {share('calls_with_critical_incident')} AS pct_explained_by_critical"
CAUSES = f"""{P}{CONVERSATIONS}, r AS (SELECT call_date, vendor, overall_status, count(*) AS total_degraded_calls, count(*) FILTER ("any") AS calls_with_incident, count(*) FILTER (critical) AS calls_with_critical_incident
  FROM (SELECT conversation_id, call_date, c.vendor, overall_status, bool_or(incident_number IS NOT NULL) AS "any", bool_or(coalesce(i.priority IN ('P0', 'P1'), false)) AS critical {OVERLAP.format('LEFT')} GROUP BY ALL) GROUP BY ALL)"""


def root_causes(spark, d):
    return correlation.root_cause_summary(conversations(spark, d), fixture(spark, d, "outages"), now())


@query("root_cause_summary", oracle(f"{CAUSES} SELECT call_date, vendor, overall_status, {EXPLAINED} FROM r", "participants", "outages"))
def _(spark, d):
    return root_causes(spark, d)


@query("rpt_correlation", oracle(f"{CAUSES} SELECT vendor, {EXPLAINED} FROM (SELECT vendor, CAST(sum(total_degraded_calls) AS BIGINT) AS total_degraded_calls, CAST(sum(calls_with_incident) AS BIGINT) AS calls_with_incident, CAST(sum(calls_with_critical_incident) AS BIGINT) AS calls_with_critical_incident FROM r GROUP BY 1)", "participants", "outages"))
def _(spark, d):
    return correlation.report(root_causes(spark, d))
