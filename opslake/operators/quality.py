"""Data-quality probes over any table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.functions.rules import percent


def field_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, distinct values and numeric values of each field, from one scan."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("v")) for c in columns])).alias("x")).select("x.*")
    return long.groupBy("field").agg(F.count("v").alias("present"), F.count_distinct("v").alias("distinct_values"), F.count_if(F.col("v").rlike(r"^-?\d+(\.\d+)?$")).alias("numeric"))


def populated(df: DataFrame, **least: float) -> DataFrame:
    """Share of rows with a value in each field, and whether it reaches the wanted share."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).isNotNull().alias("has"), F.lit(float(p)).alias("wanted")) for c, p in least.items()])).alias("x")).select("x.*")
    g = long.groupBy("field", "wanted").agg(percent(F.count_if("has"), F.count("*")).alias("populated_pct"))
    return g.select("field", "populated_pct", F.when(F.col("populated_pct") >= F.col("wanted"), "PASS").otherwise("FAIL").alias("verdict"))


def top_k(df: DataFrame, k: int, *dims: str) -> DataFrame:
    return df.groupBy(*dims).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *dims).limit(k)


def distribution(df: DataFrame, dim: str) -> DataFrame:
    """Counts of each value and their share; the values are counted before the total is taken."""
    g = df.groupBy(dim).agg(F.count("*").alias("n"))
    total = g.agg(F.sum("n").alias("total"))
    return g.join(F.broadcast(total)).select(dim, "n", percent(F.col("n"), F.col("total")).alias("pct"))


def missing_fields(df: DataFrame, required: list[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def required_fields(df: DataFrame, required: list[str]) -> DataFrame:
    """(field, present, filled, distinct_values): each required field, whether the table has it, and its values, from one scan."""
    there = [c for c in required if c in df.columns]
    gone = df.sparkSession.createDataFrame([(c,) for c in missing_fields(df, required)], "field string")
    gone = gone.select("field", F.lit(False).alias("present"), F.lit(0).cast("long").alias("filled"), F.lit(0).cast("long").alias("distinct_values"))
    if not there:
        return gone
    # A row without a value stands for each field, so that fields of an empty table are present too.
    one = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("v")) for c in there]))
    rows = df.select(one.alias("x")).select("x.*").unionByName(df.sparkSession.createDataFrame([(c, None) for c in there], "field string, v string"))
    return rows.groupBy("field").agg(F.lit(True).alias("present"), F.count("v").alias("filled"), F.count_distinct("v").alias("distinct_values")).unionByName(gone)


def ingestion_lag(df: DataFrame, event: Column, ingested: Column, batch: Column) -> DataFrame:
    """Records, batches and average delay by hour of ingestion."""
    lag = (F.unix_timestamp(ingested.cast("timestamp")) - F.unix_timestamp(event.cast("timestamp"))) / 60.0
    return df.groupBy(F.date_trunc("hour", ingested).alias("hour")).agg(F.count("*").alias("records"), F.count_distinct(batch).alias("batches"), F.round(F.avg(lag), 2).alias("avg_lag_minutes"))


def window_counts(df: DataFrame, ts: str, as_of: Column, hours: int = 24) -> DataFrame:
    """All rows, those of the last hours, and the first and last time."""
    recent = (F.col(ts) >= as_of - F.expr(f"INTERVAL {hours} HOURS")) & (F.col(ts) < as_of)
    return df.agg(F.count("*").alias("total"), F.count_if(recent).alias("recent"), F.min(ts).alias("first_time"), F.max(ts).alias("last_time"))


def sample_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first rows in an order, as a sample to look at."""
    return df.orderBy(*order).limit(n)
