"""Landed files: JSON lines with all columns as strings, incremental windows, run logs."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def json_lines(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Records with the given columns as strings; others are ignored, absent ones null."""
    return spark.read.schema(StructType([StructField(c, StringType()) for c in columns])).json(path)


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of the field map by their new names; those that the source lacks are null texts."""
    return df.select(*[(F.col(old) if old in df.columns else F.lit(None).cast("string")).alias(new) for old, new in names.items()])


def parsed_timestamps(df: DataFrame, columns: list[str], formats: tuple[str, ...] = ()) -> DataFrame:
    """Text columns as timestamps by the first format that fits, and by the standard one; others become null."""
    parse = lambda c: F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats], F.try_to_timestamp(c)).cast("timestamp_ntz")
    return df.withColumns({c: parse(F.col(c)) for c in columns})


def concatenated(parts: list[DataFrame]) -> DataFrame:
    """Results of several chunks as one; columns that a part lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def in_window(df: DataFrame, ts: str, start: Column, end: Column) -> DataFrame:
    """Rows of the half-open window; the comparison reaches the scan."""
    return df.where((F.col(ts) >= start) & (F.col(ts) < end))


def incremental_window(runs: DataFrame, overlap_minutes: int = 3, epoch: str = "1970-01-01") -> DataFrame:
    """One row with the start of the next window: the end of the last successful run less an overlap, or the epoch."""
    last = F.max(F.when(F.col("status") == "SUCCESS", F.col("window_end")))
    return runs.agg(F.coalesce(last - F.lit(timedelta(minutes=overlap_minutes)), F.lit(epoch).cast("timestamp_ntz")).alias("next_start"))


def with_metadata(df: DataFrame, batch: str, start: Column, end: Column, system: str, now: Column) -> DataFrame:
    return df.withColumns({"_ingestion_ts": now, "_batch_id": F.lit(batch), "_window_start": start, "_window_end": end, "_source_system": F.lit(system)})


def append(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Appends rows, in folders by the given columns if any."""
    w = df.write.mode("append")
    (w.partitionBy(*by) if by else w).parquet(path)


def refresh(df: DataFrame, path: str) -> str:
    """A full refresh: the rows go to a folder of their own beside the old ones, and the path of the new folder is returned to be put in its place.

    Readers of the old folder aren't disturbed, and a refresh that fails leaves it as it was.
    """
    staged = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    return staged


def log_run(runs_path: str, spark: SparkSession, job: str, status: str, start: datetime, end: datetime, rows: int) -> None:
    """One row of the run log; to be called after the data are written, so that a failed run is read again."""
    schema = "job string, status string, window_start timestamp_ntz, window_end timestamp_ntz, row_count long"
    spark.createDataFrame([(job, status, start, end, rows)], schema).coalesce(1).write.mode("append").parquet(runs_path)


def latest_runs(runs: DataFrame, n: int) -> DataFrame:
    """The last runs, newest first."""
    return runs.orderBy(F.desc("window_end"), F.desc("status")).limit(n)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def report_summary(apps: DataFrame, least: int = 30) -> DataFrame:
    """One row: the applications of the report, those of high, medium and low confidence, and the threshold."""
    c = F.col("confidence")
    counts = apps.agg(F.count("*").alias("total_applications"), F.count_if(c >= 70).alias("high_confidence"), F.count_if((c >= 40) & (c < 70)).alias("medium_confidence"), F.count_if(c < 40).alias("low_confidence"))
    return counts.withColumn("confidence_threshold", F.lit(least))


def write_report(apps: DataFrame, path: str, summary_path: str | None = None, least: int = 30) -> None:
    """JSON lines with at most 100 sources, 50 hosts and 10 pieces of evidence each, as the report shows them; and the summary block of one line."""
    apps.select("app", "confidence", "event_count", "methods", F.slice("sources", 1, 100).alias("sources"), F.slice("hosts", 1, 50).alias("hosts"), F.slice("evidence", 1, 10).alias("evidence")).write.mode("overwrite").json(path)
    if summary_path:
        report_summary(apps, least).coalesce(1).write.mode("overwrite").json(summary_path)
