"""Registered checks: every operator run over the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose work
grows with the tables: access-log lines are derived from *all* of
``events`` (``sources.events_log``), endpoints also come from all of
``pages``, audit rows from all of ``events``, SQL-defined silver from
all of ``orders``.  Entries that exercise writers (landing files, layer
tables, the audit table) write to a fresh folder under the shared
checkpoint dir on every call, so re-running is safe.

Time-valued outputs are returned as ``timestamp_ntz`` in UTC so they
compare equal to the DuckDB oracles in ``tidelog.oracles``.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.http import response_category
from tidelog.functions.logparse import SILVER_LOG_COLUMNS, clean_endpoint, parse_access_log
from tidelog.operators import metrics as M
from tidelog.operators.heavy import top_clients_by_sketch, top_pages_by_sketch
from tidelog.operators.monitoring import latest_runs, run_durations, run_status
from tidelog.operators.quality import QualityGateError, quality_rows
from tidelog.operators.report import access_report, access_report_sql, report_frames
from tidelog.plans.audit import insert_execution_log, save_execution_log
from tidelog.plans.pipeline import log_analysis, monitoring_analysis
from tidelog.plans.pipeline import run as run_pipeline
from tidelog.plans.report_state import ReportState, incremental_report
from tidelog.plans.spec import QUALITY_TABLE, PipelineSpec
from tidelog.plans.tables import (
    append_rows,
    compact_table,
    ensure_environment,
    new_version_path,
    purge_rows,
    read_layer,
    with_control_columns,
    write_layer,
    write_version,
)
from tidelog.schemas import EXECUTION_LOG_SCHEMA, ddl
from tidelog.session import scratch_path
from tidelog.sources.events_log import access_lines, execution_rows
from tidelog.sources.landing import read_landing, read_ragged
from tidelog.sources.ledger import landing_files, read_unseen, record_files
from tidelog.streaming.ingest import ingest_available, read_stream_silver, silver_available

# fixed run instant for the control columns of the checks
RUN_TS = dt.datetime(2024, 2, 1, 12, 30, 0, tzinfo=dt.timezone.utc)
SILVER_SQL = (
    "SELECT o_orderstatus, o_orderpriority, count(*) AS order_count, "
    "min(o_totalprice) AS min_price, max(o_totalprice) AS max_price, "
    "round(sum(o_totalprice), 2) AS total_price "
    "FROM orders GROUP BY o_orderstatus, o_orderpriority"
)
PURGED_PIPELINE = "pipeline_0"
WATCHED_PIPELINE, WATCHED_STEP = "pipeline_1", "gold"
SCALARS = ("distinct_ip_count", "distinct_day_count", "day_with_most_client_errors",
           "total_volume", "max_volume", "min_volume", "avg_volume")

Query = Callable[[SparkSession, str], DataFrame]


def _utc(spark: SparkSession) -> None:
    # the derived lines carry +0000; day and weekday are then UTC days
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, noisy: bool = True) -> DataFrame:
    _utc(spark)
    return access_lines(_table(spark, sf_dir, "events"), noisy=noisy)


def derived_silver(spark: SparkSession, sf_dir: str, noisy: bool = True) -> DataFrame:
    """Silver (parsed) access log over lines derived from all of ``events``."""
    return parse_access_log(_lines(spark, sf_dir, noisy))


_STORED: dict[tuple, str] = {}


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived silver log as production reads it: written once per session, then scanned."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        path = scratch_path(spark, "silver")
        derived_silver(spark, sf_dir).write.parquet(path)
        _STORED[key] = path
    _utc(spark)
    return spark.read.parquet(_STORED[key])


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# --- landing sources -----------------------------------------------------------

def landing_text_scan(spark, sf_dir):
    path = scratch_path(spark, "landing-text")
    _lines(spark, sf_dir).write.text(path)
    return read_landing(spark, path, "text")


def landing_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "landing-csv")
    _lines(spark, sf_dir).write.text(path)
    return read_landing(spark, path, "csv")


def ragged_csv(spark, sf_dir):
    """All events in a delivery of two columns and in one of four, read together."""
    base = scratch_path(spark, "landing-ragged")
    events = _table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"), F.coalesce(F.col("user_id").cast("string"), F.lit("x")).alias("u"),
        F.coalesce("event_type", F.lit("x")).alias("t"))
    events.select(F.concat_ws(",", "id", "u").alias("value")).write.text(f"{base}/narrow")
    quoted = F.concat(F.lit('"'), F.col("t"), F.lit(","), F.col("u"), F.lit('"'))
    events.select(F.concat_ws(",", "id", "u", "t", quoted).alias("value")).write.text(f"{base}/wide")
    return read_ragged(spark, [f"{base}/narrow", f"{base}/wide"], misfits="_misfit")


def unseen_files(spark, sf_dir):
    """Two deliveries of the same lines into one folder; the first is in the
    ledger, so only the second one's rows come back (once, not twice)."""
    base = scratch_path(spark, "ledger")
    landing, ledger = f"{base}/landing", f"{base}/ingested"
    lines = _lines(spark, sf_dir)
    lines.write.mode("append").text(landing)
    first = landing_files(spark, landing)
    record_files(first, ledger, "check", RUN_TS)
    lines.write.mode("append").text(landing)
    rows, _ = read_unseen(spark, landing, ledger, "text")
    return rows


# --- parse and derived columns ---------------------------------------------------

def parse_access_log_q(spark, sf_dir):
    return _ntz(derived_silver(spark, sf_dir), "timestamp")


def control_columns(spark, sf_dir):
    return _ntz(with_control_columns(_lines(spark, sf_dir), RUN_TS), "processed_timestamp")


def endpoint_clean(spark, sf_dir):
    logs = derived_silver(spark, sf_dir).select("endpoint", "endpoint_clean")
    urls = _table(spark, sf_dir, "pages").select(
        F.col("url").alias("endpoint"), clean_endpoint(F.col("url")).alias("endpoint_clean")
    )
    return logs.unionByName(urls)


def response_category_q(spark, sf_dir):
    return derived_silver(spark, sf_dir).select(
        "status_code", response_category(F.col("status_code")).alias("response_category")
    )


# --- report metrics ---------------------------------------------------------------

def top_client_ips(spark, sf_dir):
    return M.top_client_ips(stored_silver(spark, sf_dir))


def top_endpoints(spark, sf_dir):
    return M.top_endpoints(stored_silver(spark, sf_dir))


def volume_stats(spark, sf_dir):
    return M.volume_stats(stored_silver(spark, sf_dir))


def distinct_counts(spark, sf_dir):
    return M.distinct_counts(stored_silver(spark, sf_dir))


def client_errors_by_weekday(spark, sf_dir):
    return M.client_errors_by_weekday(stored_silver(spark, sf_dir))


def worst_error_weekday(spark, sf_dir):
    return M.worst_error_weekday(stored_silver(spark, sf_dir))


def daily_rollup(spark, sf_dir):
    return M.daily_rollup(stored_silver(spark, sf_dir))


def report_scalars(spark, sf_dir):
    return access_report(stored_silver(spark, sf_dir)).select(*SCALARS)


def report_top_ips(spark, sf_dir):
    return report_frames(access_report(stored_silver(spark, sf_dir)))["top_ips"]


def report_top_endpoints(spark, sf_dir):
    return report_frames(access_report(stored_silver(spark, sf_dir)))["top_endpoints"]


def report_sql_scalars(spark, sf_dir):
    """The report as SQL text over a temp view (the SQL-driven gold step)."""
    view = f"silver_lines_{uuid.uuid4().hex[:8]}"
    stored_silver(spark, sf_dir).createOrReplaceTempView(view)
    return spark.sql(access_report_sql(view)).select(*SCALARS)


def top_clients_sketched(spark, sf_dir):
    return top_clients_by_sketch(stored_silver(spark, sf_dir))


def top_pages_sketched(spark, sf_dir):
    return top_pages_by_sketch(stored_silver(spark, sf_dir))


# --- the report kept up by deliveries ---------------------------------------------------

DELIVERIES = 3


def _report_state(spark, sf_dir) -> ReportState:
    """All lines in deliveries that share days; one of them is delivered twice.  As in
    production, the state is written once (per session) and read by all that need it."""
    silver = stored_silver(spark, sf_dir)
    key = ("state", spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        path = scratch_path(spark, "report-state")
        part = F.pmod(F.xxhash64(*SILVER_LOG_COLUMNS), F.lit(DELIVERIES))
        for i in [*range(DELIVERIES), 1]:
            ReportState(spark, path).add(silver.filter(part == i), f"d{i}")
        _STORED[key] = path
    return ReportState(spark, _STORED[key])


def incremental_scalars(spark, sf_dir):
    return _report_state(spark, sf_dir).report().select(*SCALARS)


def incremental_lists(spark, sf_dir):
    return _ranked_lists(_report_state(spark, sf_dir).report())


def incremental_gold(spark, sf_dir):
    """Two pipeline runs that load one delivery each; gold covers both of them."""
    base = scratch_path(spark, "pipeline-incremental")
    lines = _lines(spark, sf_dir, noisy=False)
    part = F.pmod(F.xxhash64("value"), F.lit(2))
    spec = _spec(spark, base, lines.filter(part == 0), gold_builder=incremental_report(f"{base}/state"), once_only=True)
    run_pipeline(spark, spec, 4, RUN_TS)
    lines.filter(part == 1).write.mode("append").text(f"{base}/landing")
    run_pipeline(spark, spec, 4, RUN_TS + dt.timedelta(hours=1))
    return spark.table(spec.gold_table).select(*SCALARS)


def range_distincts(spark, sf_dir):
    """Distinct clients and days of all lines and of three ranges of days, from the state."""
    state = _report_state(spark, sf_dir)
    low, high = state.daily().agg(F.min("date"), F.max("date")).first()
    middle = low + (high - low) // 2
    ranges = {"all": (None, None), "first_half": (None, middle), "from_middle": (middle, None),
              "week": (middle, middle + dt.timedelta(days=6))}
    out = [state.distinct_counts(*r).withColumn("days", F.lit(name)) for name, r in ranges.items()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def rolling_clients(spark, sf_dir):
    """Distinct clients of the seven days up to each day, from the state."""
    return _report_state(spark, sf_dir).rolling_clients(7)


# --- quality ------------------------------------------------------------------------

def quality_rows_clean(spark, sf_dir):
    df = derived_silver(spark, sf_dir, noisy=False)
    return _ntz(quality_rows(df, "access_log", "bronze_to_silver", "silver.s_access_logs", RUN_TS), "timestamp")


def quality_rows_noisy(spark, sf_dir):
    df = derived_silver(spark, sf_dir, noisy=True)
    return _ntz(quality_rows(df, "access_log", "bronze_to_silver", "silver.s_access_logs", RUN_TS), "timestamp")


def quality_rows_table(spark, sf_dir):
    _utc(spark)
    df = _table(spark, sf_dir, "orders")
    return _ntz(quality_rows(df, "orders", "bronze_to_silver", "silver.s_orders", RUN_TS, is_log=False),
                "timestamp")


# --- SQL-defined silver, layer tables, whole pipeline ------------------------------

def sql_silver(spark, sf_dir):
    _utc(spark)
    _table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    df = with_control_columns(spark.sql(SILVER_SQL), RUN_TS)
    return _ntz(df, "processed_timestamp")


def layer_roundtrip(spark, sf_dir):
    base = scratch_path(spark, "lake")
    ensure_environment(spark, base)
    table = f"bronze.roundtrip_{uuid.uuid4().hex[:8]}"
    bronze = with_control_columns(_lines(spark, sf_dir), RUN_TS)
    write_layer(bronze, table, f"{base}/bronze/check/roundtrip", optimize_write=True)
    return read_layer(spark, table).select("value", "processed_date")


def _spec(spark, base: str, lines: DataFrame, extension: str = "txt", **kw) -> PipelineSpec:
    """A pipeline over ``lines`` delivered as landing files, with tables of its own."""
    tag = uuid.uuid4().hex[:8]
    if extension == "txt":
        lines.write.mode("overwrite").text(f"{base}/landing")
    else:
        lines.write.mode("overwrite").csv(f"{base}/landing")
    return PipelineSpec(
        pipeline_name=f"check_{tag}", file_name=f"*.{extension}", landing_path=f"{base}/landing",
        base_path=f"{base}/lake", table_name_bronze=f"b_{tag}", table_name_silver=f"s_{tag}",
        table_name_gold=f"g_{tag}", **kw)


def pipeline_gold(spark, sf_dir):
    """Landing file → bronze → silver (gated) → gold report, then the report's scalars."""
    base = scratch_path(spark, "pipeline")
    spec = _spec(spark, base, _lines(spark, sf_dir, noisy=False), gold_builder=access_report)
    run_pipeline(spark, spec, 4, RUN_TS)
    return spark.table(spec.gold_table).select(*SCALARS)


def pipeline_sql_gold(spark, sf_dir):
    """Gold as SQL text, its nested lists taken apart again, with the rank of each entry."""
    base = scratch_path(spark, "pipeline-sql")
    spec = _spec(spark, base, _lines(spark, sf_dir, noisy=False))
    spec = replace(spec, sql_gold=access_report_sql(spec.silver_table))
    run_pipeline(spark, spec, 4, RUN_TS)
    return _ranked_lists(spark.table(spec.gold_table))


def _ranked_lists(gold: DataFrame) -> DataFrame:
    """The nested lists of a report taken apart again, with the rank of each entry."""
    lists = [gold.select(F.lit(name).alias("list"), F.posexplode(name).alias("rank", "e"))
             .select("list", F.col("rank").cast("long").alias("rank"), F.col(f"e.{key}").alias("entry"),
                     F.col("e.access_count").alias("access_count"))
             for name, key in (("top_ips", "client_ip"), ("top_endpoints", "endpoint"))]
    return lists[0].unionByName(lists[1])


def pipeline_kpis(spark, sf_dir):
    """The first report row's figures, read back by the analysis step."""
    base = scratch_path(spark, "pipeline-kpis")
    spec = _spec(spark, base, _lines(spark, sf_dir, noisy=False), gold_builder=access_report)
    run_pipeline(spark, spec, 4, RUN_TS)
    return log_analysis(spark, spec)["kpis"]


def pipeline_csv_log(spark, sf_dir):
    """A log delivered as CSV: its first column is the line; silver as the pipeline stored it."""
    base = scratch_path(spark, "pipeline-csv")
    spec = _spec(spark, base, _lines(spark, sf_dir, noisy=False), "csv")
    run_pipeline(spark, spec, 3, RUN_TS)
    return _ntz(spark.table(spec.silver_table).select(*SILVER_LOG_COLUMNS), "timestamp")


def pipeline_audit(spark, sf_dir):
    """The audit rows of a whole run and of one that its gate refuses, and the mean stage
    runs by status that the monitoring step makes of them."""
    base = scratch_path(spark, "pipeline-audit")
    spec = _spec(spark, base, _lines(spark, sf_dir, noisy=False), gold_builder=access_report)
    run_pipeline(spark, spec, 4, RUN_TS)
    _lines(spark, sf_dir, noisy=True).write.mode("overwrite").text(f"{base}/landing")
    with contextlib.suppress(QualityGateError):
        run_pipeline(spark, spec, 4, RUN_TS)
    logs = monitoring_analysis(spark)["logs"].filter(F.col("pipeline_name") == spec.pipeline_name)
    return logs.groupBy("step", "status").agg(
        F.count("*").alias("runs"), F.min(F.col("time_elapsed") >= 0).alias("timed"),
        F.max(F.length("error_message") > 0).alias("told"),
        _ntz_col(F.max("execution_time")).alias("execution_time"))


def _ntz_col(c):
    return c.cast("timestamp_ntz")


def pipeline_refused(spark, sf_dir):
    """A bad delivery after a good one: its rule rows, and silver as the good one left it."""
    base = scratch_path(spark, "pipeline-refused")
    spec = _spec(spark, base, _lines(spark, sf_dir, noisy=False), once_only=True)
    run_pipeline(spark, spec, 3, RUN_TS)
    _lines(spark, sf_dir, noisy=True).write.mode("overwrite").text(f"{base}/landing")
    refused_at = RUN_TS + dt.timedelta(hours=1)
    with contextlib.suppress(QualityGateError):
        run_pipeline(spark, spec, 3, refused_at)
    rows = spark.table(QUALITY_TABLE).filter(
        (F.col("verified_table") == spec.table_name_silver) & (F.col("timestamp") == F.lit(refused_at)))
    silver = spark.table(spec.silver_table)
    return rows.select("rule", "status", "percentage_ok").unionByName(
        silver.agg(F.lit("silver_rows").alias("rule"), F.lit("").alias("status"),
                   F.count("*").cast("double").alias("percentage_ok")))


def layer_fallback(spark, sf_dir):
    """A layer whose catalog entry is gone, read by its path past an unpublished version."""
    base = scratch_path(spark, "lake")
    ensure_environment(spark, base)
    table, path = f"bronze.fallback_{uuid.uuid4().hex[:8]}", f"{base}/bronze/check/fallback"
    lines = with_control_columns(_lines(spark, sf_dir), RUN_TS)
    write_layer(lines, table, path)
    write_version(lines.filter("value = ''"), new_version_path(path))
    spark.sql(f"DROP TABLE {table}")
    return read_layer(spark, table, path).select("value", "processed_date")


def audit_appends(spark, sf_dir):
    """One audit row per pipeline and step, appended as a frame or by parameterised SQL."""
    table = _audit_table(spark, sf_dir, appended=False)
    runs = execution_rows(_table(spark, sf_dir, "events")).groupBy("pipeline_name", "step").agg(
        F.max("execution_time").alias("at"), F.count("*").cast("double").alias("n"))
    for i, r in enumerate(sorted(runs.collect())):  # pipelines times steps
        row = (r["at"], r["pipeline_name"], r["step"], "OK", "it's ok; --", "/lake/x", r["n"])
        if i % 2:
            insert_execution_log(spark, *row, table=table)
        else:
            save_execution_log(spark, *row, table=table)
    return _ntz(spark.table(table), "execution_time")


def run_durations_ranked(spark, sf_dir):
    """Mean stage durations, slowest first: the order of the rows as a column."""
    _utc(spark)
    out = run_durations(execution_rows(_table(spark, sf_dir, "events")))
    return out.coalesce(1).withColumn("rank", F.monotonically_increasing_id())


def stream_ingest(spark, sf_dir):
    """Landing folder consumed as a file stream (available-now) into bronze."""
    base = scratch_path(spark, "stream")
    _lines(spark, sf_dir).write.text(f"{base}/landing")
    ingest_available(spark, f"{base}/landing", f"{base}/bronze", f"{base}/_checkpoint",
                     archive_dir=f"{base}/processed")
    return spark.read.parquet(f"{base}/bronze").select("value")


def stream_silver(spark, sf_dir):
    """Landing folder → gated silver, micro-batch by micro-batch (available-now)."""
    base = scratch_path(spark, "stream-silver")
    _lines(spark, sf_dir, noisy=False).write.text(f"{base}/landing")
    silver_available(spark, f"{base}/landing", f"{base}/silver", f"{base}/_checkpoint", "check_stream")
    return _ntz(read_stream_silver(spark, f"{base}/silver").select(*SILVER_LOG_COLUMNS), "timestamp")


# --- monitoring ------------------------------------------------------------------------

def _audit_table(spark, sf_dir, appended: bool = True) -> str:
    _utc(spark)
    base = scratch_path(spark, "audit")
    ensure_environment(spark, base)
    table = f"monitoring.execution_logs_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE TABLE {table} ({ddl(EXECUTION_LOG_SCHEMA)}) USING parquet LOCATION '{base}/logs'")
    if appended:
        append_rows(execution_rows(_table(spark, sf_dir, "events")), table)
    return table


def run_durations_q(spark, sf_dir):
    _utc(spark)
    return run_durations(execution_rows(_table(spark, sf_dir, "events")))


def run_status_q(spark, sf_dir):
    _utc(spark)
    return run_status(execution_rows(_table(spark, sf_dir, "events")))


def latest_runs_q(spark, sf_dir):
    table = _audit_table(spark, sf_dir)
    out = latest_runs(spark.table(table), WATCHED_PIPELINE, WATCHED_STEP, like=True)
    # the order of the rows as a column
    return _ntz(out.coalesce(1).withColumn("rank", F.monotonically_increasing_id()), "execution_time")


def purge_runs(spark, sf_dir):
    table = _audit_table(spark, sf_dir)
    purge_rows(spark, table, F.col("pipeline_name") == F.lit(PURGED_PIPELINE))
    return _ntz(spark.table(table), "execution_time")


def compact_runs(spark, sf_dir):
    """Audit rows appended step by step (one small file set per append), then compacted."""
    table = _audit_table(spark, sf_dir, appended=False)
    rows = execution_rows(_table(spark, sf_dir, "events"))
    for step in ("landing", "bronze", "silver", "gold"):
        append_rows(rows.filter(F.col("step") == step), table)
    compact_table(spark, table)
    return _ntz(spark.table(table), "execution_time")


QUERIES: dict[str, Query] = {
    "landing_text_scan": landing_text_scan,
    "landing_csv_scan": landing_csv_scan,
    "ragged_csv": ragged_csv,
    "unseen_files": unseen_files,
    "parse_access_log": parse_access_log_q,
    "control_columns": control_columns,
    "endpoint_clean": endpoint_clean,
    "response_category": response_category_q,
    "top_client_ips": top_client_ips,
    "top_endpoints": top_endpoints,
    "volume_stats": volume_stats,
    "distinct_counts": distinct_counts,
    "client_errors_by_weekday": client_errors_by_weekday,
    "worst_error_weekday": worst_error_weekday,
    "daily_rollup": daily_rollup,
    "report_scalars": report_scalars,
    "report_top_ips": report_top_ips,
    "report_top_endpoints": report_top_endpoints,
    "report_sql_scalars": report_sql_scalars,
    "top_clients_sketched": top_clients_sketched,
    "top_pages_sketched": top_pages_sketched,
    "incremental_scalars": incremental_scalars,
    "incremental_lists": incremental_lists,
    "incremental_gold": incremental_gold,
    "range_distincts": range_distincts,
    "rolling_clients": rolling_clients,
    "quality_rows": quality_rows_clean,
    "quality_rows_noisy": quality_rows_noisy,
    "quality_rows_table": quality_rows_table,
    "sql_silver": sql_silver,
    "layer_roundtrip": layer_roundtrip,
    "pipeline_gold": pipeline_gold,
    "pipeline_sql_gold": pipeline_sql_gold,
    "pipeline_kpis": pipeline_kpis,
    "pipeline_csv_log": pipeline_csv_log,
    "pipeline_audit": pipeline_audit,
    "pipeline_refused": pipeline_refused,
    "layer_fallback": layer_fallback,
    "audit_appends": audit_appends,
    "run_durations_ranked": run_durations_ranked,
    "stream_ingest": stream_ingest,
    "stream_silver": stream_silver,
    "run_durations": run_durations_q,
    "run_status": run_status_q,
    "latest_runs": latest_runs_q,
    "purge_runs": purge_runs,
    "compact_runs": compact_runs,
}
