"""Call quality: participants, conversations, agents and their daily aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslake.functions.rules import classify_call, percent, severity, status_of
from opslake.operators.tables import latest


def flatten_conversations(docs: DataFrame) -> DataFrame:
    """One row for each participant and session of nested conversation documents."""
    p = docs.select("conversation_id", "start_ts", "end_ts", F.get("divisions", F.lit(0)).alias("division"), F.explode("participants").alias("p"))
    s = p.select("conversation_id", "start_ts", "end_ts", "division", "p.participant_id", "p.purpose", F.when(F.col("p.purpose") == "agent", F.col("p.user_id")).alias("agent_id"), F.explode("p.sessions").alias("s"))
    mos = F.get(F.filter("s.metrics", lambda m: m["name"] == "nMos"), F.lit(0))["value"]
    return s.select("conversation_id", "participant_id", "purpose", "agent_id", "division", F.col("s.vendor").alias("vendor"), mos.alias("mos"), F.col("s.error_code").alias("error_code"), (F.unix_timestamp(F.col("end_ts").cast("timestamp")) - F.unix_timestamp(F.col("start_ts").cast("timestamp"))).alias("duration_seconds"))


def participants_latest(raw: DataFrame) -> DataFrame:
    """The latest row of each participant with its call status and date."""
    # Of several sessions that came in together the worst one counts.
    order = [F.desc_nulls_last("ingestion_ts"), F.asc_nulls_last("mos"), *[F.col(c).desc_nulls_last() for c in ("error_code", "agent_id", "vendor", "start_ts")]]
    # Rows that are equal in all of that may still lie in different places: what else they hold decides, so that the result doesn't change from run to run.
    order += [F.col(c).desc_nulls_last() for c in raw.columns if c in ("location_key", "division", "end_ts")]
    rows = latest(raw, ["conversation_id", "purpose", "participant_id"], *order)
    return rows.withColumn("call_status", classify_call(F.col("error_code"), F.col("mos"))).withColumn("call_date", F.to_date("start_ts"))


def conversation_rollup(p: DataFrame) -> DataFrame:
    """One row for each conversation: worst status of both sides and overall, shared attributes, span and size."""
    rank = severity(F.col("call_status"))
    side = lambda who: F.max(F.when(F.col("purpose") == who, rank))
    g = p.groupBy("conversation_id").agg(
        side("agent").alias("a"), side("customer").alias("c"), F.max(F.when(F.col("purpose") == "agent", F.col("agent_id"))).alias("agent_id"),
        F.max("vendor").alias("vendor"), F.max("location_key").alias("location_key"), F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"), F.count("*").alias("participant_count"),
    )
    return g.select("conversation_id", "agent_id", status_of(F.col("a")).alias("agent_status"), status_of(F.col("c")).alias("customer_status"), status_of(F.greatest("a", "c")).alias("overall_status"), "vendor", "location_key", "start_ts", "end_ts", "participant_count")


def agent_legs(p: DataFrame) -> DataFrame:
    """The agents' legs, numbered in each conversation; all but the first are transfers."""
    legs = p.where("purpose = 'agent' and agent_id is not null")
    n = F.row_number().over(Window.partitionBy("conversation_id").orderBy("start_ts", "participant_id"))
    return legs.withColumn("leg_sequence", n).withColumn("is_transfer", F.col("leg_sequence") > 1)


def _counts() -> list[Column]:
    return [F.count("*").alias("total_calls"), *[F.count_if(F.col("call_status") == s).alias(f"{s.lower()}_calls") for s in ("NORMAL", "DEGRADED", "ERRORED")]]


def _shares() -> list[Column]:
    return [percent(F.col(f"{s}_calls"), F.col("total_calls")).alias(f"{s}_pct") for s in ("normal", "degraded", "errored")]


def quality_by(p: DataFrame, *dims: str) -> DataFrame:
    """Counts and shares of each status by the given columns."""
    g = p.groupBy(*dims).agg(*_counts())
    return g.select(*dims, "total_calls", "normal_calls", "degraded_calls", "errored_calls", *_shares())


def with_geography(p: DataFrame, locations: DataFrame) -> DataFrame:
    """Country and continent of each location, Unknown where it is not listed. locations is a dimension of a few hundred rows."""
    j = p.join(locations, "location_key", "left")
    return j.withColumns({c: F.coalesce(F.col(c), F.lit("Unknown")) for c in ("country", "continent")})


def reaggregate(vendor_location: DataFrame, *dims: str) -> DataFrame:
    """Upper levels from sums, with shares computed again."""
    g = vendor_location.groupBy(*dims).agg(*[F.sum(c).alias(c) for c in ("total_calls", "normal_calls", "degraded_calls", "errored_calls")])
    return g.select(*dims, "total_calls", "normal_calls", "degraded_calls", "errored_calls", *_shares())


def agents_flagged(p: DataFrame, errored: float = 10, degraded: float = 20) -> DataFrame:
    """Agents' days with more errored or degraded calls than the limits, and which of them."""
    q = quality_by(p.where("agent_id is not null"), "call_date", "agent_id")
    e, d = F.col("errored_pct") > errored, F.col("degraded_pct") > degraded
    return q.where(e | d).withColumn("flag_reason", F.when(e & d, "BOTH").when(e, "ERRORED_HIGH").otherwise("DEGRADED_HIGH"))


def agent_performance_detail(p: DataFrame) -> DataFrame:
    """Agents' days with their counts and their legs as a sorted list."""
    leg = F.struct("conversation_id", "participant_id", "call_status")
    return p.where("agent_id is not null").groupBy("call_date", "agent_id").agg(*_counts(), F.sort_array(F.collect_list(leg)).alias("legs"))


def with_current_agent(legs: DataFrame, agents: DataFrame, *attributes: str) -> DataFrame:
    """Legs with attributes of their agent's current row in the slowly changing dimension; unknown agents keep nulls."""
    return legs.join(agents.where("is_current").select("agent_id", *attributes), "agent_id", "left")
