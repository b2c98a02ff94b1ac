"""Data-quality rules and the all-or-nothing gate.

All rules are computed in **one** aggregation (``count(1)`` and one
``count(col)`` per checked column) instead of one job per rule.  The same
expressions can ride along a write through ``DataFrame.observe``
(see ``tidelog.plans.pipeline``) so parsing, checking and writing share a
single pass over the input.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.schemas import QUALITY_SCHEMA

# --- fixed values: rule names and the columns they check ---------------------
NOT_NULL_RULES = (
    ("not_null_client_ip", "client_ip"),
    ("not_null_endpoint", "endpoint"),
    ("not_null_status_code", "status_code"),
    ("not_null_timestamp", "timestamp"),
)
NOT_ZERO_COUNT = "not_zero_count"
STATUS_OK, STATUS_FAIL = "OK", "FAIL"
# ---------------------------------------------------------------------------


class QualityGateError(ValueError):
    """Raised after the rule rows are stored when any rule failed."""


@dataclass(frozen=True)
class RuleResult:
    rule: str
    status: str
    percentage_ok: float


def count_exprs(is_log: bool) -> list[Column]:
    """The aggregate expressions behind the rules: ``total`` and one
    ``valid_<column>`` count per not-null rule (logs only)."""
    exprs = [F.count(F.lit(1)).alias("total")]
    if is_log:
        exprs += [F.count(F.col(c)).alias(f"valid_{c}") for _, c in NOT_NULL_RULES]
    return exprs


def quality_counts(df: DataFrame, is_log: bool = True) -> DataFrame:
    """One row of counts, computed in a single pass."""
    return df.agg(*count_exprs(is_log))


def quality_rows(df: DataFrame, pipeline_name: str, step: str, verified_table: str,
                 checked_at: dt.datetime, is_log: bool = True) -> DataFrame:
    """The rule rows (quality-table schema) for ``df``: one aggregation, whose
    row of counts the same rules judge as in the pipeline's gate.

    Logs get four not-null rules plus ``not_zero_count``; other data only
    ``not_zero_count``.  A not-null rule passes only when every row has the
    column (so an empty input fails all rules with 0.0).
    """
    counts = quality_counts(df, is_log).first().asDict()
    return results_frame(df.sparkSession, evaluate_rules(counts, is_log), pipeline_name, step, verified_table, checked_at)


def evaluate_rules(counts: dict, is_log: bool) -> list[RuleResult]:
    """Rule results from the count row (a dict), on the driver: five numbers in,
    at most five rows out.  Percentages are rounded to two places (exact ties
    to even); the pass test is on the exact counts."""
    total = int(counts.get("total") or 0)
    results = []
    if is_log:
        for rule, column in NOT_NULL_RULES:
            valid = int(counts.get(f"valid_{column}") or 0)
            pct = round((valid / total) * 100, 2) if total > 0 else 0.0
            ok = total > 0 and valid == total
            results.append(RuleResult(rule, STATUS_OK if ok else STATUS_FAIL, float(pct)))
    results.append(RuleResult(NOT_ZERO_COUNT, STATUS_OK if total > 0 else STATUS_FAIL,
                              100.0 if total > 0 else 0.0))
    return results


def results_frame(spark: SparkSession, results: list[RuleResult], pipeline_name: str, step: str,
                  verified_table: str, checked_at: dt.datetime) -> DataFrame:
    rows = [(pipeline_name, step, checked_at, r.status, r.rule, r.percentage_ok, verified_table)
            for r in results]
    return spark.createDataFrame(rows, QUALITY_SCHEMA)


def failed(results: list[RuleResult]) -> list[RuleResult]:
    return [r for r in results if r.status != STATUS_OK]
