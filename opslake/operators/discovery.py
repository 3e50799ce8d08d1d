"""Application discovery from log metadata and content, merged, scored and reported."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.functions.rules import confidence, normalize_app, valid_app
from opslake.operators.components import components
from opslake.sources.scratch import written

RESULT = ["app", "method", "event_count", "sources", "hosts", "sourcetypes", "evidence"]
# Ordered patterns, of which the first that matches names the application, and host name parts that name none.
SOURCE_PATTERNS = (
    r"[/\\]([a-zA-Z][\w-]+)(?:\.log|\.txt|_\d)",
    r"[/\\]logs?[/\\]([a-zA-Z][\w-]+)",
    r"Program Files[/\\]([^/\\]+)",
    r"/opt/([^/]+)",
    r"/var/log/([^/]+)",
    r"([a-zA-Z][\w-]+)-\d+\.\d+",
    r"/home/[^/]+/([^/]+)",
    r"/srv/([^/]+)",
    r"/app/([^/]+)",
)
HOST_PATTERNS = (r"^([a-zA-Z]+)-", r"-([a-zA-Z]+)\d*$", r"^[a-z]+\d*([a-z]{3,})")
ENVIRONMENTS = ("prd", "prod", "dev", "uat", "stg", "web", "api", "srv")
# Patterns of message texts, of which the last that matches counts.
CONTENT_PATTERNS = (
    r"""(?i)(?:application|app|service|component|module)[=:\s"']+([a-zA-Z][\w-]{2,30})""",
    r"\[([A-Z][a-zA-Z]{2,20})\]",
    r"([a-z]+\.[a-z]+\.[A-Z][a-zA-Z]+)",
    r"""(?i)logger[=:\s"']+([^\s"']+)""",
)
# JSON fields that may name an application.
JSON_FIELDS = ("application", "app", "appName", "app_name", "service", "serviceName", "service_name", "component", "module", "logger", "logger_name", "project", "system", "program", "process_name")


def first_match(text: Column, patterns: tuple[str, ...]) -> Column:
    """The first group of the first pattern that matches."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in patterns])


def any_case(patterns: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(f"(?i){p}" for p in patterns)


def content_name(text: Column) -> Column:
    """The application that a message names; of a dotted name the last part."""
    return F.element_at(F.split(first_match(text, CONTENT_PATTERNS[::-1]), r"\."), -1)


def json_name(text: Column) -> Column:
    """The first of the JSON fields that is there."""
    return F.coalesce(*[F.get_json_object(text, f"$.{f}") for f in JSON_FIELDS])


def indexed(events: DataFrame, index: str, include: list[str] | None = None, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Events of the included indexes, or of all but the excluded ones."""
    return events.where(F.col(index).isin(include)) if include else events.where(~F.coalesce(F.col(index).isin(*exclude), F.lit(False)))


def tally(events: DataFrame, text: str | None = None) -> DataFrame:
    """Distinct (source, host, sourcetype, json_app, content_app) with their events: one shuffle that every way of discovery reads."""
    content = content_name(F.col(text)) if text else F.lit(None).cast("string")
    named = events.select("source", "host", "sourcetype", "ts", json_name(F.col("props")).alias("json_app"), content.alias("content_app"))
    return named.groupBy("source", "host", "sourcetype", "json_app", "content_app").agg(F.count("*").alias("n"), F.min("ts").alias("first_time"), F.max("ts").alias("last_time"))


def metadata(tallied: DataFrame, dim: str) -> DataFrame:
    """Events and first and last time of each source, host or source type."""
    return tallied.groupBy(dim).agg(F.sum("n").alias("event_count"), F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"))


#: Ways of discovery from the tally, and those whose names are counted as they stand in events.
METHODS = ("source", "host", "sourcetype", "json", "content")
FIELDS = ("json", "content")
# Generic source types that name no application.
GENERIC = "(?i)^(syslog|access|error|audit|security|generic|stash)$|^_|^splunk"


def host_name(host: Column) -> Column:
    """What a host name says without its domain name; names of environments say nothing, and no later pattern is tried for them."""
    found = first_match(F.regexp_replace(F.lower(host), r"\.(com|net|org|local|internal|corp).*$", ""), any_case(HOST_PATTERNS))
    return F.get(F.filter(F.array(found), lambda x: ~x.isin(*ENVIRONMENTS)), F.lit(0))


def sourcetype_name(sourcetype: Column) -> Column:
    """The first part of a source type that is a valid name of over three letters."""
    return F.get(F.filter(F.split(sourcetype, r"[_:\-]"), lambda p: (F.length(p) > 3) & valid_app(p)), F.lit(0))


def discover(tallied: DataFrame, methods: tuple[str, ...] = METHODS, least: int = 100, least_fields: int = 10) -> DataFrame:
    """Applications that sources, hosts, source types, JSON fields and message texts name, by one pass over the tally.

    Sources and source types need `least` events, hosts none; names in JSON fields (counted over all source types with json in their name) and names
    in texts (counted by source type) need more than least_fields. A name is found once for each counted value, not for each event.
    """
    none, kind, key = F.lit(None).cast("string"), F.col("method"), F.col("key")
    keys = {"json": (F.when(F.col("sourcetype").like("%json%"), F.col("json_app")), none), "content": (F.col("content_app"), F.col("sourcetype"))}
    ways = [F.struct(F.lit(m).alias("method"), (c := keys.get(m, (F.col(m), none)))[0].alias("key"), c[1].alias("part")) for m in methods] if methods else []
    seen = tallied.select("n", "sourcetype", F.explode(F.array(*ways)).alias("w")).select("n", "sourcetype", "w.*").where("key is not null")
    counted = seen.groupBy("method", "key", "part").agg(F.sum("n").alias("event_count"), F.sort_array(F.collect_set(F.when(kind.isin(*FIELDS), F.col("sourcetype")))).alias("types"))
    enough = F.when(kind.isin(*FIELDS), F.col("event_count") > least_fields).when(kind == "host", True).otherwise(F.col("event_count") >= least)
    names = {"source": lambda: first_match(key, any_case(SOURCE_PATTERNS)), "host": lambda: host_name(key), "sourcetype": lambda: F.when(~key.rlike(GENERIC), sourcetype_name(key))}
    name = F.lit(None).cast("string")
    for m in methods:
        name = F.when(kind == m, names.get(m, lambda: key)()).otherwise(name)
    # The generator evaluates a name once; the checks below read its result.
    named = counted.where(enough).withColumn("app", F.explode(F.array(normalize_app(name)))).where(F.col("app").isNotNull() & valid_app(F.col("app")))
    return _shaped(named, kind, F.col("types"))


def _shaped(named: DataFrame, kind: Column, types: Column) -> DataFrame:
    """(app, method, event_count, key, ...) in the form of all results."""
    none, key = F.array().cast("array<string>"), F.col("key")
    fields = kind.isin(*FIELDS)
    return named.select(
        "app", kind.alias("method"), "event_count", F.when(kind == "source", F.array(key)).otherwise(none).alias("sources"), F.when(kind == "host", F.array(key)).otherwise(none).alias("hosts"),
        F.when(fields, types).when(kind.isin("sourcetype", "cluster"), F.array(key)).otherwise(none).alias("sourcetypes"),
        F.array(F.concat(F.lit("["), kind, F.lit("] "), F.when(fields, F.array_join(types, ", ")).otherwise(key))).alias("evidence"),
    )


def template(text: Column) -> Column:
    """Text with numbers and hex values masked: messages of one shape are equal."""
    return F.regexp_replace(F.regexp_replace(text, r"\b[0-9a-fA-F]{8,}\b", "<hex>"), r"\d+", "<n>")


def clusters(events: DataFrame, text: str, least: int = 50, top: int = 100) -> DataFrame:
    """Groups of messages of one shape, the largest ones of over `least` events."""
    g = events.groupBy(template(F.col(text)).alias("template")).agg(F.count("*").alias("event_count"), F.min(text).alias("example"))
    return g.where(F.col("event_count") > least).orderBy(F.desc("event_count"), "template").limit(top)


#: Least similarity of messages of one cluster; bands of so many hashes that find 99.9 % of the pairs at that similarity.
SIMILARITY, BANDS, ROWS = 0.7, 20, 3


def tokens(text: Column) -> Column:
    """The distinct words of a message."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}<>]+"), lambda w: w != ""))


def similar(shapes: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(a, b): shapes of messages, given as (template), whose words are similar, found by bands of minimum hashes and then checked.

    Shapes that share a band are compared with its first and its last one, not with each other, so a band of very many costs each of them the same.
    """
    t = shapes.select("template", tokens(F.col("template")).alias("words")).where(F.size("words") > 0)
    least_hash = lambda seed: F.array_min(F.transform("words", lambda w: F.xxhash64(w, seed)))
    signed = t.withColumn("signature", F.transform(F.sequence(F.lit(0), F.lit(BANDS * ROWS - 1)), least_hash))
    banded = signed.select("template", "words", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(F.slice("signature", k * ROWS + 1, ROWS)))).alias("band", "hash"))
    me = F.struct("template", "words")
    ends = banded.groupBy("band", "hash").agg(F.min(me).alias("first"), F.max(me).alias("last")).where("first <> last")
    met = banded.join(ends, ["band", "hash"]).select("template", "words", F.explode(F.array("first", "last")).alias("other")).where("template <> other.template")
    common, whole = F.size(F.array_intersect("words", "other.words")), F.size(F.array_union("words", "other.words"))
    return met.where(common >= least * whole).select(F.least("template", "other.template").alias("a"), F.greatest("template", "other.template").alias("b")).distinct()


def similar_clusters(events: DataFrame, text: str, least: int = 50, top: int = 100) -> DataFrame:
    """Clusters of messages whose shapes are linked by similarity: the shape of most events stands for all. The largest ones of over `least` events."""
    g = events.groupBy(template(F.col(text)).alias("template")).agg(F.count("*").alias("n"), F.min(text).alias("text")).where("template is not null")
    shapes = written(g, "shapes")
    label = components(shapes.select(F.col("template").alias("id")), similar(shapes))
    whole = shapes.join(label, shapes["template"] == label["id"]).groupBy("component").agg(F.sum("n").alias("event_count"), F.count("*").alias("shapes"), F.max_by(F.struct("template", "text"), F.struct("n", "template")).alias("main"))
    return whole.where(F.col("event_count") > least).select("main.template", "event_count", F.col("main.text").alias("example"), "shapes").orderBy(F.desc("event_count"), "template").limit(top)


def from_clusters(grouped: DataFrame) -> DataFrame:
    """Applications that the example of a group of messages names, by the first pattern that matches in any case. grouped: as from clusters()."""
    g = grouped.select("event_count", F.lit("cluster").alias("key"), F.explode(F.array(normalize_app(first_match(F.col("example"), any_case(CONTENT_PATTERNS))))).alias("app"))
    return _shaped(g.where(F.col("app").isNotNull() & valid_app(F.col("app"))), F.lit("cluster"), F.array().cast("array<string>"))


def merge(*found: DataFrame) -> DataFrame:
    """One row for each application: sets joined, counts added, evidence gathered, with its confidence."""
    union = reduce(lambda a, b: a.unionByName(b), [f.select(RESULT) for f in found])
    sets = {c: F.sort_array(F.array_distinct(F.flatten(F.collect_set(c)))) for c in ("sources", "hosts", "sourcetypes", "evidence")}
    g = union.groupBy("app").agg(F.sum("event_count").alias("event_count"), F.sort_array(F.collect_set("method")).alias("methods"), *[v.alias(k) for k, v in sets.items()])
    return g.withColumn("confidence", confidence(F.size("methods"), F.col("event_count"), F.size("sources"), F.size("hosts"), F.size("sourcetypes")))


def report_rows(apps: DataFrame) -> DataFrame:
    """Flat rows with counts, joined methods and three samples."""
    three = lambda c: F.array_join(F.slice(c, 1, 3), "; ")
    return apps.select("app", "confidence", "event_count", F.array_join("methods", ", ").alias("methods"), F.size("sources").alias("source_count"), F.size("hosts").alias("host_count"), three("sources").alias("sample_sources"), three("hosts").alias("sample_hosts"))


def evidence_rows(apps: DataFrame, most: int = 5) -> DataFrame:
    """Long form with at most so many pieces of evidence for each application, as the report shows them."""
    return apps.select("app", F.explode(F.slice("evidence", 1, most)).alias("evidence"))


def summarize(apps: DataFrame) -> DataFrame:
    c = F.col("confidence")
    return apps.agg(F.count("*").alias("apps"), F.count_if(c >= 70).alias("high"), F.count_if((c >= 40) & (c < 70)).alias("medium"), F.count_if(c < 40).alias("low"), F.coalesce(F.sum("event_count"), F.lit(0)).alias("events"))


def search(apps: DataFrame, text: str) -> DataFrame:
    """Applications whose name holds the text."""
    return apps.where(F.lower("app").contains(text.lower()))


def lookup(apps: DataFrame, name: str) -> DataFrame:
    """The application of that name."""
    return apps.where(F.col("app") == name.lower())


def ranked(apps: DataFrame, least: int = 30) -> DataFrame:
    """Applications of enough confidence, the surest first."""
    return apps.where(F.col("confidence") >= least).orderBy(F.desc("confidence"), F.desc("event_count"), "app")


def source_rows(apps: DataFrame, most: int = 10) -> DataFrame:
    """Long form with at most so many sources of each application, as the report shows them."""
    return apps.select("app", F.explode(F.slice("sources", 1, most)).alias("source"))


def shortened(values: Column, most: int = 50) -> Column:
    """A list as text, cut after so many characters."""
    joined = F.array_join(values, ", ")
    return F.when(F.length(joined) > most, F.concat(F.substring(joined, 1, most), F.lit("..."))).otherwise(joined)
