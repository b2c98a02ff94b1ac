"""tidelog — web-server access-log analytics on Spark.

Landing files → bronze (raw lines) → silver (parsed, quality-gated) → gold
(report or any SQL), with an execution log and a quality log.  Every data
step is a DataFrame / Spark SQL plan; see README.md for the map of
operators and their scale behaviour.
"""

from tidelog.functions.http import is_page, response_category, weekday_name
from tidelog.functions.logparse import clean_endpoint, parse_access_log, parse_log_time
from tidelog.operators.metrics import (
    client_errors_by_weekday,
    daily_rollup,
    distinct_counts,
    top_client_ips,
    top_endpoints,
    volume_stats,
    worst_error_weekday,
)
from tidelog.operators.monitoring import latest_runs, run_durations, run_status
from tidelog.operators.quality import QualityGateError, quality_counts, quality_rows
from tidelog.operators.report import access_report, access_report_sql, report_frames
from tidelog.plans.pipeline import (
    bronze_to_silver,
    check_landing,
    landing_to_bronze,
    log_analysis,
    monitoring_analysis,
    run,
    silver_to_gold,
)
from tidelog.plans.spec import PipelineSpec
from tidelog.plans.tables import compact_table, ensure_environment, purge_rows, read_layer, write_layer
from tidelog.sources.landing import read_landing
from tidelog.sources.ledger import read_unseen, unseen_files

__all__ = [
    "PipelineSpec", "QualityGateError", "access_report", "access_report_sql", "bronze_to_silver",
    "check_landing", "clean_endpoint", "compact_table", "client_errors_by_weekday", "daily_rollup", "distinct_counts",
    "ensure_environment", "is_page", "landing_to_bronze", "latest_runs", "log_analysis",
    "monitoring_analysis", "parse_access_log", "parse_log_time", "purge_rows", "quality_counts",
    "quality_rows", "read_landing", "read_layer", "read_unseen", "report_frames", "response_category",
    "run", "run_durations", "run_status", "silver_to_gold", "top_client_ips", "top_endpoints",
    "unseen_files", "volume_stats", "weekday_name", "worst_error_weekday", "write_layer",
]
