"""Incidents: SLA measures, status, daily aggregates, open work, state changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslake.functions.rules import CLOSED_STATES, business_minutes, elapsed_minutes, normalize_priority, percent, sla_status
from opslake.operators.tables import latest

BUSINESS_FACTOR = (540 / 1440) * (5 / 7)


def bronze(raw: DataFrame) -> DataFrame:
    """Typed incidents with a normalised priority and the raw record as JSON."""
    return raw.withColumn("raw_payload", F.to_json(F.struct(*raw.columns))).withColumn("priority", normalize_priority(F.col("priority")))


def sla_measures(i: DataFrame, targets: DataFrame, as_of: Column, calendar: bool = False) -> DataFrame:
    """Minutes, shares of the target and statuses for response and resolution.

    targets: (priority, response_target, resolution_target), one row for each priority, and optionally business_hours_only:
    then known times count by the share of business hours, or with calendar exactly by the business hours between both times; those of what
    is still open stay as they are.
    """
    limited = F.coalesce(F.col("business_hours_only"), F.lit(False)) if "business_hours_only" in targets.columns else F.lit(False)
    j = i.join(targets, "priority", "left")
    for what, end in (("response", "responded_at"), ("resolution", "resolved_at")):
        elapsed = elapsed_minutes(F.col("opened_at"), F.col(end))
        in_hours = business_minutes(F.col("opened_at"), F.col(end)) if calendar else elapsed * BUSINESS_FACTOR
        raw = F.when(F.col(end).isNotNull(), F.when(limited, in_hours).otherwise(elapsed))
        now = elapsed_minutes(F.col("opened_at"), as_of)
        target = F.col(f"{what}_target")
        pct = F.when(target > 0, F.round(F.coalesce(raw, now) / target * 100, 2))
        j = j.withColumn(f"{what}_minutes", F.round(raw, 2)).withColumn(f"{what}_pct", pct).withColumn(f"{what}_status", sla_status(F.col(end).isNotNull(), pct))
    return j


def facts(raw: DataFrame, targets: DataFrame, services: DataFrame, as_of: Column, calendar: bool = False) -> DataFrame:
    """The latest record of each incident with SLA measures, its service's type, date and openness."""
    new = latest(raw, ["incident_number"], F.col("ingestion_ts").desc_nulls_last(), F.col("state").desc_nulls_last())
    j = sla_measures(new, targets, as_of, calendar).join(services, "service", "left")
    j = j.withColumn("service_type", F.coalesce("service_type", F.lit("OTHER"))).withColumn("is_agent_facing", F.coalesce("is_agent_facing", F.lit(False)))
    return j.withColumn("incident_date", F.to_date("opened_at")).withColumn("is_open", F.coalesce(~F.col("state").isin(*CLOSED_STATES), F.lit(True)))


def sla_by(f: DataFrame, *dims: str) -> DataFrame:
    """Counts of statuses, compliance of both measures, and averages by the given columns."""
    out = [F.count("*").alias("total")]
    for what in ("response", "resolution"):
        s = F.col(f"{what}_status")
        out += [F.count_if(s == "MET").alias(f"{what}_met"), F.count_if(s == "BREACHED").alias(f"{what}_breached"), F.count_if(s.isin("IN_PROGRESS", "AT_RISK")).alias(f"{what}_pending"), F.round(F.avg(f"{what}_minutes"), 2).alias(f"avg_{what}_minutes")]
    g = f.groupBy(*dims).agg(*out, F.count_if("is_open").alias("open_count"), F.max("resolution_minutes").alias("worst_resolution"), F.round(F.avg(F.when(~F.col("is_open"), F.col("resolution_minutes"))), 2).alias("mttr"))
    return g.withColumns({f"{what}_compliance": percent(F.col(f"{what}_met"), F.col(f"{what}_met") + F.col(f"{what}_breached")) for what in ("response", "resolution")})


def open_incidents(f: DataFrame, as_of: Column) -> DataFrame:
    """Open incidents with what is left of both targets (0 at least, also where unknown) and their risk."""
    elapsed = elapsed_minutes(F.col("opened_at"), as_of)
    worst = lambda s: (F.col("response_status") == s) | (F.col("resolution_status") == s)
    return f.where("is_open").select(
        "incident_number", "priority", "service", "vendor", F.round(elapsed, 2).alias("time_open"),
        F.greatest(F.lit(0.0), F.col("response_target") - F.coalesce(F.col("response_minutes"), elapsed)).alias("response_remaining"),
        F.greatest(F.lit(0.0), F.col("resolution_target") - elapsed).alias("resolution_remaining"),
        F.when(worst("BREACHED"), "BREACHED").when(worst("AT_RISK"), "AT_RISK").otherwise("HEALTHY").alias("risk"),
    )


def state_changes(batch: DataFrame, current: DataFrame) -> DataFrame:
    """Incidents whose state in a new batch differs from the current one (null is a state), with minutes in the previous state."""
    new = latest(batch, ["incident_number"], F.col("ingestion_ts").desc_nulls_last(), F.col("state").desc_nulls_last())
    old = current.select("incident_number", F.col("state").alias("from_state"), F.col("ingestion_ts").alias("since"))
    j = new.join(old, "incident_number").where(~F.col("state").eqNullSafe(F.col("from_state")))
    return j.select("incident_number", "from_state", F.col("state").alias("to_state"), F.round(elapsed_minutes(F.col("since"), F.col("ingestion_ts")), 2).alias("minutes_in_state"))


def transitions(history: DataFrame, key: str = "incident_number", state: str = "state", ts: str = "ingestion_ts") -> DataFrame:
    """(key, from_state, to_state, at, minutes): every change of state in the whole ingestion history, also several of one batch.

    Rows of a key are taken by time, those of one time by state (null first). Null is a state; a key's first state is no change. minutes: how long the state before lasted.
    Rows without a key are passed over.
    """
    rows = history.where(F.col(key).isNotNull()).select(key, F.col(state).alias("to_state"), F.col(ts).alias("at"))
    w = Window.partitionBy(key).orderBy("at", F.col("to_state").asc_nulls_first())
    rows = rows.withColumn("_before", F.lag(F.struct("to_state")).over(w))
    begun = rows.where(F.col("_before").isNull() | ~F.col("to_state").eqNullSafe(F.col("_before.to_state"))).withColumn("_since", F.lag("at").over(w))
    return begun.where(F.col("_before").isNotNull()).select(key, F.col("_before.to_state").alias("from_state"), "to_state", "at", F.round(elapsed_minutes(F.col("_since"), F.col("at")), 2).alias("minutes"))


def breach_flags(f: DataFrame, as_of: Column) -> DataFrame:
    """Breach of both targets (null while unknown), and what remains of them, which can be negative."""
    elapsed = elapsed_minutes(F.col("opened_at"), as_of)
    return f.select("incident_number", "priority", *[x for what in ("response", "resolution") for x in (
        (F.col(f"{what}_minutes") > F.col(f"{what}_target")).alias(f"{what}_breached"),
        F.round(F.col(f"{what}_target") - F.coalesce(F.col(f"{what}_minutes"), elapsed), 2).alias(f"{what}_remaining"),
    )])


def metrics_by_priority(f: DataFrame) -> DataFrame:
    """Totals, breaches, averages by priority; incidents that are not known to breach count as compliant."""
    breach = F.coalesce(F.col("resolution_minutes") > F.col("resolution_target"), F.lit(False))
    g = f.groupBy("priority").agg(F.count("*").alias("total"), F.count_if(breach).alias("breaches"), F.round(F.avg("resolution_minutes"), 2).alias("avg_minutes"), F.min("resolution_minutes").alias("min_minutes"), F.max("resolution_minutes").alias("max_minutes"), F.round(F.median("resolution_minutes"), 2).alias("median_minutes"), F.max("resolution_target").alias("target"), F.count_if(~F.col("is_open")).alias("closed"))
    return g.withColumn("compliance", percent(F.col("total") - F.col("breaches"), F.col("total")))


# States as texts and as codes.
RESOLVED, CLOSED, OPEN = ("Resolved", "6"), ("Closed", "7"), ("New", "In Progress", "On Hold", "1", "2", "3")


def state_counts(i: DataFrame, *dims: str) -> DataFrame:
    """Incidents, and resolved, closed and open ones, by the given columns; states may be texts or codes, others (and null) count in the total only."""
    among = lambda states: F.count_if(F.coalesce(F.col("state").isin(*states), F.lit(False)))
    return i.groupBy(*dims).agg(F.count("*").alias("total"), among(RESOLVED).alias("resolved_count"), among(CLOSED).alias("closed_count"), among(OPEN).alias("open_count"))


#: Columns that may tell the first response, the best one first.
RESPONSES = ("first_response_time_ts", "response_time_ts", "work_start_ts")


def latest_incident(raw: DataFrame, key: str, extracted: str, *ties: str, columns: tuple[str, ...] = RESPONSES, filled: bool = False) -> DataFrame:
    """The latest record of each incident with first_response_ts and response_minutes.

    The response is the first of the columns that the table has, also where it is null; with `filled` the first of them that has a value in the row.
    A table with none of them has null responses. Of records extracted together the one with the largest ties counts.
    """
    there = [F.col(c) for c in columns if c in raw.columns]
    response = F.coalesce(*there) if filled and there else there[0] if there else F.lit(None).cast("timestamp_ntz")
    new = latest(raw, [key], *[F.col(c).desc_nulls_last() for c in (extracted, *ties)]).withColumn("first_response_ts", response)
    return new.withColumn("response_minutes", F.round(elapsed_minutes(F.col("opened_at"), F.col("first_response_ts")), 2))


# The order of priorities in lists.
PRIORITY_ORDER = ("P0", "P1", "P2", "P3", "P4")


def dashboard(open_: DataFrame) -> DataFrame:
    """Open incidents, the most important first, older ones before newer ones."""
    rank = F.coalesce(*[F.when(F.col("priority") == p, k) for k, p in enumerate(PRIORITY_ORDER)], F.lit(9))
    return open_.orderBy(rank, F.desc("time_open"), "incident_number")


def agent_impacting(f: DataFrame) -> DataFrame:
    """Open incidents of agent-facing services that are at risk or in progress, the share of the target highest first."""
    return f.where(F.col("is_open") & F.col("is_agent_facing") & F.col("resolution_status").isin("AT_RISK", "IN_PROGRESS")).orderBy(F.desc_nulls_last("resolution_pct"), "incident_number")


def vendor_report(daily: DataFrame, since: Column) -> DataFrame:
    """Daily vendor compliance rolled up from a day on, the worst first."""
    one = lambda f, c, a: F.round(f(c), 1).alias(a)
    g = daily.where(F.col("vendor").isNotNull() & (F.col("incident_date") >= since)).groupBy("vendor").agg(
        F.sum("total").alias("total"), one(F.avg, "response_compliance", "response_pct"), one(F.avg, "resolution_compliance", "resolution_pct"),
        one(F.avg, "avg_response_minutes", "avg_resp_min"), one(F.avg, "worst_resolution", "worst_resolution_min"),
    )
    return g.orderBy(F.asc_nulls_first("resolution_pct"), "vendor")


def overall(metrics: DataFrame) -> DataFrame:
    """One row over metrics_by_priority(): totals and the mean of the compliances."""
    return metrics.agg(F.sum("total").alias("total"), F.sum("breaches").alias("breaches"), F.round(F.avg("compliance"), 2).alias("avg_compliance"))
