"""Application discovery over the fixture of raw events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from opslake.functions.rules import EXCLUDED
from opslake.operators import discovery
from opslake.plans.fixtures import fixture, oracle
from opslake.plans.registry import query
from opslake.sources import landing

EVENTS = "raw_events"
quoted = lambda values: ", ".join("'" + v.replace("'", "''") + "'" for v in values)
VALID = f"length(app) >= 3 AND lower(app) NOT IN ({quoted(EXCLUDED)}) AND regexp_matches(app, '[A-Za-z]') AND NOT regexp_matches(lower(app), '^[a-z]?\\d+$')"
NORMAL = r"trim(lower(regexp_replace(regexp_replace({}, '[-_]?(service|app|api|server|client|agent|daemon)$', '', 'i'), '[-_]?v?\d+(\.\d+)*$', '', 'i')))"


def matches(text: str, patterns) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({text}, {quoted([p])}, 1), '')" for p in patterns) + ")"


def _named(method: str, dim: str, app: str, groups: str, having: str) -> str:
    return f"SELECT app, '{method}' AS method, event_count, '[{method}] ' || {dim} AS evidence FROM (SELECT {dim}, {NORMAL.replace('{}', app)} AS app, event_count FROM ({groups}) WHERE {having}) WHERE app IS NOT NULL AND {VALID}"


def _counted(expr: str, dims: str, where: str = "true") -> str:
    return f"SELECT {expr}, {dims}, count(*) AS event_count FROM raw_events WHERE {where} GROUP BY ALL"


SHORT = r"regexp_replace(lower(host), '\.(com|net|org|local|internal|corp).*$', '')"


def content(text: str) -> str:
    return f"list_last(string_split({matches(text, discovery.CONTENT_PATTERNS[::-1])}, '.'))"


CLUSTERS = r"SELECT regexp_replace(regexp_replace(message, '\b[0-9a-fA-F]{8,}\b', '<hex>', 'g'), '\d+', '<n>', 'g') AS template, count(*) AS event_count, min(message) AS example FROM raw_events GROUP BY 1 HAVING count(*) > 50 ORDER BY event_count DESC, template LIMIT 100"
PART = f"list_filter(regexp_split_to_array(sourcetype, '[_:\\-]'), lambda x: length(x) > 3 AND lower(x) NOT IN ({quoted(EXCLUDED)}) AND regexp_matches(x, '[A-Za-z]') AND NOT regexp_matches(lower(x), '^[a-z]?\\d+$'))[1]"
DISCOVERED = {
    "discover_sources": _named("source", "source", matches("source", discovery.any_case(discovery.SOURCE_PATTERNS)), _counted("1", "source"), "event_count >= 100"),
    "discover_hosts": _named("host", "host", "name", f"SELECT *, {matches('short', discovery.any_case(discovery.HOST_PATTERNS))} AS name FROM ({_counted(SHORT + ' AS short', 'host')})", f"name NOT IN ({quoted(discovery.ENVIRONMENTS)})"),
    "discover_sourcetypes": _named("sourcetype", "sourcetype", PART, _counted("1", "sourcetype"), "event_count >= 100 AND NOT regexp_matches(sourcetype, '(?i)^(syslog|access|error|audit|security|generic|stash)$|^_|^splunk')"),
    "discover_json": _named("json", "types", "name", "SELECT coalesce(" + ", ".join(f"json_extract_string(props, '$.{f}')" for f in discovery.JSON_FIELDS) + ") AS name, array_to_string(list_sort(list(DISTINCT sourcetype)), ', ') AS types, count(*) AS event_count FROM raw_events WHERE sourcetype LIKE '%json%' GROUP BY 1", "event_count > 10"),
    "discover_content": _named("content", "sourcetype", "name", _counted(content("message") + " AS name", "sourcetype"), "event_count > 10"),
    "discover_cluster_apps": _named("cluster", "sourcetype", "name", f"SELECT event_count, 'cluster' AS sourcetype, {matches('example', discovery.any_case(discovery.CONTENT_PATTERNS))} AS name FROM ({CLUSTERS})", "true"),
}


def tallied(spark, d):
    return discovery.tally(fixture(spark, d, EVENTS), "message")


def clusters(spark, d):
    return discovery.clusters(fixture(spark, d, EVENTS), "message")


def found(spark, d, name):
    return discovery.from_clusters(clusters(spark, d)) if name == "discover_cluster_apps" else discovery.discover(tallied(spark, d), (WAYS[name],))


WAYS = {"discover_sources": "source", "discover_hosts": "host", "discover_sourcetypes": "sourcetype", "discover_json": "json", "discover_content": "content"}


for _name in DISCOVERED:

    @query(_name, oracle(" " + DISCOVERED[_name], EVENTS))
    def _(spark, d, name=_name):
        return found(spark, d, name).withColumn("evidence", F.element_at("evidence", 1)).select("app", "method", "event_count", "evidence")


@query("discover_clusters", oracle(" " + CLUSTERS, EVENTS))
def _(spark, d):
    return clusters(spark, d)


SIMILAR = f""", s AS (SELECT template, n, text, list_distinct(list_filter(regexp_split_to_array(lower(template), '[^\\p{{L}}\\p{{N}}<>]+'), lambda w: w <> '')) AS words FROM ({CLUSTERS.split(' HAVING')[0].replace('event_count', 'n').replace('AS example', 'AS text')})),
  l AS (SELECT a.template AS a, b.template AS b FROM s a JOIN s b ON len(list_intersect(a.words, b.words)) >= 0.7 * len(list_distinct(list_concat(a.words, b.words)))),
  r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a), c AS (SELECT a AS template, min(b) AS component FROM r GROUP BY 1)"""


@query("discover_similar_clusters", oracle(f"{SIMILAR} SELECT arg_max(template, (n, template)) AS template, CAST(sum(n) AS BIGINT) AS event_count, arg_max(text, (n, template)) AS example, count(*) AS shapes FROM s JOIN c USING (template) GROUP BY component HAVING sum(n) > 50 ORDER BY event_count DESC, template LIMIT 100", EVENTS).replace("WITH ", "WITH RECURSIVE ", 1))
def _(spark, d):
    return discovery.similar_clusters(fixture(spark, d, EVENTS), "message")


@query("metadata_hosts", oracle(" SELECT host, count(*) AS event_count, min(ts) AS first_time, max(ts) AS last_time FROM raw_events GROUP BY 1", EVENTS))
def _(spark, d):
    return discovery.metadata(tallied(spark, d), "host").withColumn("event_count", F.col("event_count").cast("long"))


@query("index_filter", oracle(" SELECT 'included' AS mode, idx, count(*) AS n FROM raw_events WHERE idx IN ('idx1', 'idx2') GROUP BY 2 UNION ALL SELECT 'all but excluded', idx, count(*) FROM raw_events WHERE idx NOT IN ('idx0') GROUP BY 2", EVENTS))
def _(spark, d):
    e = fixture(spark, d, EVENTS)
    some, rest = discovery.indexed(e, "idx", ["idx1", "idx2"]), discovery.indexed(e, "idx", None, ("idx0",))
    count = lambda x, mode: x.groupBy(F.lit(mode).alias("mode"), "idx").agg(F.count("*").alias("n"))
    return count(some, "included").union(count(rest, "all but excluded"))


def apps(spark, d):
    return discovery.merge(discovery.discover(tallied(spark, d)), discovery.from_clusters(clusters(spark, d)))


POINTS = lambda c, *x: "CASE " + " ".join(f"WHEN {c} >= {a} THEN {p}" for a, p in x) + " ELSE 0 END"
DETAIL = "split_part(evidence, '] ', 2)"
MERGED = f""", found AS ({' UNION ALL '.join(f'({x})' for x in DISCOVERED.values())}),
  m AS (SELECT app, CAST(sum(event_count) AS BIGINT) AS event_count, list_sort(list(DISTINCT method)) AS methods, coalesce(list_sort(list(DISTINCT {DETAIL}) FILTER (method = 'source')), []) AS sources, coalesce(list_sort(list(DISTINCT {DETAIL}) FILTER (method = 'host')), []) AS hosts,
    coalesce(len(list_distinct(flatten(list(string_split({DETAIL}, ', ')) FILTER (method NOT IN ('source', 'host'))))), 0) AS n_types, list_sort(list(DISTINCT evidence)) AS evidence FROM found GROUP BY app),
  apps AS (SELECT *, CAST(least(100, least(8 * len(methods), 25) + {POINTS('event_count', (100000, 30), (10000, 25), (1000, 20), (100, 10), (1, 5))} + {POINTS('len(sources)', (5, 15), (2, 10), (1, 5))} + {POINTS('len(hosts)', (10, 15), (5, 10), (1, 5))} + {POINTS('n_types', (3, 15), (2, 10), (1, 5))}) AS INTEGER) AS confidence FROM m)"""
BASIC = "app, event_count, array_to_string(methods, ', ') AS methods, confidence"


def basic(df):
    return df.select("app", "event_count", F.array_join("methods", ", ").alias("methods"), "confidence")


@query("merged_scored_apps", oracle(f"{MERGED} SELECT {BASIC} FROM apps", EVENTS))
def _(spark, d):
    return basic(apps(spark, d))


@query("ranked_apps", oracle(f"{MERGED} SELECT {BASIC}, row_number() OVER (ORDER BY confidence DESC, event_count DESC, app) AS place FROM apps WHERE confidence >= 30 ORDER BY place", EVENTS))
def _(spark, d):
    return basic(discovery.ranked(apps(spark, d))).withColumn("place", F.row_number().over(Window.orderBy(F.desc("confidence"), F.desc("event_count"), "app")).cast("long"))


@query("app_summary", oracle(f"{MERGED} SELECT count(*) AS apps, count(*) FILTER (confidence >= 70) AS high, count(*) FILTER (confidence >= 40 AND confidence < 70) AS medium, count(*) FILTER (confidence < 40) AS low, CAST(coalesce(sum(event_count), 0) AS BIGINT) AS events FROM apps", EVENTS))
def _(spark, d):
    return discovery.summarize(apps(spark, d))


@query("report_summary", oracle(f"{MERGED} SELECT count(*) AS total_applications, count(*) FILTER (confidence >= 70) AS high_confidence, count(*) FILTER (confidence >= 40 AND confidence < 70) AS medium_confidence, count(*) FILTER (confidence < 40) AS low_confidence, 30 AS confidence_threshold FROM apps WHERE confidence >= 30", EVENTS))
def _(spark, d):
    return landing.report_summary(discovery.ranked(apps(spark, d)))


@query("app_search", oracle(f"{MERGED} SELECT app, confidence FROM apps WHERE app LIKE '%pay%'", EVENTS))
def _(spark, d):
    return discovery.search(apps(spark, d), "PAY").select("app", "confidence")


@query("app_lookup", oracle(f"{MERGED} SELECT {BASIC} FROM apps WHERE app = 'mailer'", EVENTS))
def _(spark, d):
    return basic(discovery.lookup(apps(spark, d), "Mailer"))


@query("app_report_rows", oracle(f"{MERGED} SELECT app, confidence, event_count, array_to_string(methods, ', ') AS methods, CAST(len(sources) AS INTEGER) AS source_count, CAST(len(hosts) AS INTEGER) AS host_count, array_to_string(sources[1:3], '; ') AS sample_sources, array_to_string(hosts[1:3], '; ') AS sample_hosts FROM apps", EVENTS))
def _(spark, d):
    return discovery.report_rows(apps(spark, d))


@query("app_evidence_rows", oracle(f"{MERGED} SELECT app, unnest(evidence[1:5]) AS evidence FROM apps", EVENTS))
def _(spark, d):
    return discovery.evidence_rows(apps(spark, d))


@query("app_source_rows", oracle(f"{MERGED} SELECT app, unnest(sources[1:10]) AS source FROM apps", EVENTS))
def _(spark, d):
    return discovery.source_rows(apps(spark, d))


@query("app_evidence_text", oracle(f"{MERGED} SELECT app, CASE WHEN length(x) > 50 THEN x[1:50] || '...' ELSE x END AS evidence FROM (SELECT app, array_to_string(evidence, ', ') AS x FROM apps)", EVENTS))
def _(spark, d):
    return apps(spark, d).select("app", discovery.shortened(F.col("evidence")).alias("evidence"))
