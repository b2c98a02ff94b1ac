"""Monitoring views over the execution log, aggregated in Spark.

The audit table grows with every run; only these small aggregates (one
row per step, one per pipeline × status) ever need to leave the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_durations(logs: DataFrame) -> DataFrame:
    """``(step, time_elapsed)``: mean duration per step over all runs, slowest first."""
    return (
        logs.groupBy("step")
        .agg(F.avg("time_elapsed").alias("time_elapsed"))
        .orderBy(F.col("time_elapsed").desc_nulls_last(), F.col("step").asc_nulls_last())
    )


def run_status(logs: DataFrame) -> DataFrame:
    """``(pipeline_name, status, runs)``: stage runs per pipeline and outcome."""
    return logs.groupBy("pipeline_name", "status").agg(F.count(F.lit(1)).alias("runs"))


def latest_runs(logs: DataFrame, pipeline_name: str, step: str | None = None, like: bool = False) -> DataFrame:
    """Execution-log rows of one pipeline (optionally one step), newest first; rows of
    one instant in order of their other columns.

    ``like=True`` matches the name as a SQL LIKE pattern instead of exactly.
    """
    name = F.col("pipeline_name")
    cond = name.like(pipeline_name) if like else name == F.lit(pipeline_name)
    if step is not None:
        cond = cond & (F.col("step") == step)
    others = [F.col(c).asc_nulls_last() for c in logs.columns if c != "execution_time"]
    return logs.filter(cond).orderBy(F.col("execution_time").desc_nulls_last(), *others)
