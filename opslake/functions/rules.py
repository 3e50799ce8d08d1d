"""Classification rules and scalar idioms as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Severity order of call statuses.
STATUSES = ("NORMAL", "DEGRADED", "ERRORED")
CLOSED_STATES = ("Resolved", "Closed", "Canceled")


def classify_call(error_code: Column, mos: Column) -> Column:
    """ERRORED with an error or a MOS below 2, DEGRADED below 3.5, else NORMAL (also without a MOS)."""
    return F.when(error_code.isNotNull() | (mos < 2.0), "ERRORED").when(mos < 3.5, "DEGRADED").otherwise("NORMAL")


def severity(status: Column) -> Column:
    return F.when(status == "ERRORED", 2).when(status == "DEGRADED", 1).when(status == "NORMAL", 0)


def status_of(rank: Column) -> Column:
    return F.when(rank == 2, "ERRORED").when(rank == 1, "DEGRADED").when(rank == 0, "NORMAL")


def normalize_priority(p: Column) -> Column:
    """'P' and the first character of values that don't start with P; blank ones stay."""
    return F.when(~p.startswith("P") & (F.length(F.trim(p)) > 0), F.concat(F.lit("P"), F.substring(F.trim(p), 1, 1))).otherwise(p)


def elapsed_minutes(start: Column, end: Column) -> Column:
    return ((F.unix_timestamp(end.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))) / 60.0).cast("double")


# Business hours from Monday to Friday, in minutes of the day.
OPENS, CLOSES, BUSINESS_DAYS = 9 * 60, 18 * 60, 5


def business_minutes(start: Column, end: Column) -> Column:
    """Minutes of business hours between two times, exactly and without a row for each day; negative if end comes first.

    Both are turned into the business minutes since a Monday: whole weeks, whole days of the week, and what of the day's hours is over.
    """

    def since_monday(t: Column) -> Column:
        days = F.datediff(F.to_date(t), F.lit("1970-01-05"))
        week, weekday = F.floor(days / 7), F.pmod(days, F.lit(7))
        minute = F.hour(t) * 60.0 + F.minute(t) + F.second(t) / 60.0
        today = F.when(weekday < BUSINESS_DAYS, F.greatest(F.lit(0.0), F.least(minute - OPENS, F.lit(float(CLOSES - OPENS))))).otherwise(0.0)
        return (week * BUSINESS_DAYS + F.least(weekday, F.lit(BUSINESS_DAYS))) * float(CLOSES - OPENS) + today

    return since_monday(end) - since_monday(start)


def percent(part: Column, whole: Column) -> Column:
    """Rounded to two digits; null for an empty whole."""
    return F.round(part.cast("double") * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0)), 2)


def sla_status(known_end: Column, pct: Column) -> Column:
    """MET or BREACHED when the end is known, else BREACHED over 100 %, AT_RISK over 80 %, IN_PROGRESS otherwise."""
    return (
        F.when(known_end & (pct <= 100), "MET").when(pct > 100, "BREACHED").when(~known_end & (pct > 80), "AT_RISK").otherwise("IN_PROGRESS")
    )


def steps(value: Column, *limits: tuple[float, int]) -> Column:
    """Points of the first limit that the value reaches; 0 below all."""
    out = F.lit(0)
    for least, points in reversed(limits):
        out = F.when(value >= least, points).otherwise(out)
    return out


def confidence(methods: Column, events: Column, sources: Column, hosts: Column, types: Column) -> Column:
    """Points for methods, events, sources, hosts and source types, 100 at most."""
    return F.least(
        F.lit(100),
        F.least(methods * 8, F.lit(25)) + steps(events, (100_000, 30), (10_000, 25), (1_000, 20), (100, 10), (1, 5))
        + steps(sources, (5, 15), (2, 10), (1, 5)) + steps(hosts, (10, 15), (5, 10), (1, 5)) + steps(types, (3, 15), (2, 10), (1, 5)),
    ).cast("int")


# Names that are no applications.
EXCLUDED = (
    "log", "logs", "tmp", "temp", "var", "etc", "opt", "usr", "debug", "info", "warn", "error", "fatal", "trace", "null", "true", "false", "none",
    "undefined", "server", "client", "host", "node", "pod", "container", "test", "dev", "prod", "uat", "staging", "syslog", "access", "audit", "security", "windows",
)


def normalize_app(name: Column) -> Column:
    """Without a role suffix and a version at the end, lower-case and trimmed."""
    x = F.regexp_replace(name, r"(?i)[-_]?(service|app|api|server|client|agent|daemon)$", "")
    return F.trim(F.lower(F.regexp_replace(x, r"(?i)[-_]?v?\d+(\.\d+)*$", "")))


def valid_app(name: Column, excluded: tuple[str, ...] = EXCLUDED) -> Column:
    """Three letters or more, not excluded, with a letter, and not a number with at most one letter before it."""
    return (F.length(name) >= 3) & ~F.lower(name).isin(*excluded) & name.rlike("[A-Za-z]") & ~F.lower(name).rlike(r"^[a-z]?\d+$")


def health(severity_: Column, cpu: Column, memory: Column, failure: Column) -> Column:
    return (
        F.when(severity_.isin("AVAILABILITY", "ERROR"), "CRITICAL")
        .when(severity_.isin("PERFORMANCE", "RESOURCE_CONTENTION", "CUSTOM_ALERT"), "WARNING")
        .when((cpu > 90) | (memory > 90) | (failure > 5), "WARNING")
        .when(severity_.isNull() & cpu.isNull() & memory.isNull() & failure.isNull(), "UNKNOWN").otherwise("HEALTHY")
    )


def coverage_class(hosts: Column, services: Column, others: Column) -> Column:
    h, s, o = (F.coalesce(x, F.lit(0)) > 0 for x in (hosts, services, others))
    return F.when(h & s, "FULL").when(h & ~o, "HOSTS_ONLY").when(h | s | o, "PARTIAL").otherwise("NOT_MONITORED")
