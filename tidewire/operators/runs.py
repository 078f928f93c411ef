"""Run log: summary, recent and failed runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_duration(runs: DataFrame) -> DataFrame:
    micros = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("completed_at"))
    return runs.withColumn("duration_ms", micros / 1000)


def summary(runs: DataFrame, *group: str) -> DataFrame:
    """Totals and success rate; every run that did not fail counts as successful."""
    total = F.count("*")
    failed = F.count_if(F.col("status") == "failed")
    return runs.groupBy(*group).agg(
        total.alias("total_runs"),
        (total - failed).alias("successful"),
        failed.alias("failed"),
        F.coalesce((total - failed) / F.nullif(total, F.lit(0)) * 100, F.lit(0.0)).alias("success_rate"),
        F.avg("duration_ms").alias("avg_duration_ms"),
    )


def recent(runs: DataFrame, n: int = 10) -> DataFrame:
    return runs.orderBy(F.col("started_at").desc(), "run_id").limit(n)


def failures(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("status") == "failed")
