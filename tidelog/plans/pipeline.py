"""The medallion pipeline: landing → bronze → silver (quality-gated) → gold.

Each stage is audited (one execution-log row per stage run).  The silver
stage parses, checks and writes in **one pass** over bronze: the rule
counts ride along the write through ``DataFrame.observe`` (they are
collected in the write's result stage, whose accumulator updates Spark
applies exactly once even when tasks are retried), the new silver data
lands in its own folder, the rule rows are stored, and only if every rule
passed is the silver table pointed at the new folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession

from tidelog.functions.logparse import parse_access_log
from tidelog.operators.monitoring import run_durations, run_status
from tidelog.operators.quality import (
    QualityGateError,
    count_exprs,
    evaluate_rules,
    failed,
    results_frame,
)
from tidelog.operators.report import report_frames
from tidelog.plans.audit import audited_stage
from tidelog.plans.spec import EXECUTION_LOG_TABLE, QUALITY_TABLE, PipelineSpec, require_sql
from tidelog.plans.tables import (
    append_rows,
    ensure_environment,
    new_version_path,
    publish_layer,
    read_layer,
    remove_path,
    sized_for_write,
    with_control_columns,
    write_layer,
    write_version,
)
from tidelog.sources.landing import landing_format, log_column, read_landing, read_ragged
from tidelog.sources.ledger import accept_files, note_loaded, read_unseen

CONTROL_COLUMNS = ("processed_timestamp", "processed_date")
SILVER_STEP = "bronze_to_silver"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def check_landing(spark: SparkSession, spec: PipelineSpec, run_ts: dt.datetime | None = None) -> None:
    """Stage 1: the delivered file must be in the landing folder.

    Planning the read lists the path on the driver and fails when nothing
    matches; text needs no job for it, CSV reads the first line.
    """
    run_ts = run_ts or _now()
    with audited_stage(spark, spec.pipeline_name, "landing", spec.landing_dir, run_ts):
        read_landing(spark, spec.landing_file, landing_format(spec.file_name))


def landing_to_bronze(spark: SparkSession, spec: PipelineSpec, run_ts: dt.datetime | None = None) -> None:
    """Stage 2: landing file(s) → ``bronze.<table>`` (raw rows + control columns).

    With ``once_only`` the files count as ingested when silver accepts them,
    so a run after a refused one delivers them again.
    """
    run_ts = run_ts or _now()
    with audited_stage(spark, spec.pipeline_name, "bronze", spec.bronze_path, run_ts):
        fmt = landing_format(spec.file_name)
        files = None
        if spec.once_only:
            raw, files = read_unseen(spark, spec.landing_dir, spec.ledger_path, fmt, glob=spec.file_name)
        elif fmt == "csv":
            raw = read_ragged(spark, spec.landing_file)
        else:
            raw = read_landing(spark, spec.landing_file, fmt)
        write_layer(with_control_columns(raw, run_ts), spec.bronze_table, spec.bronze_path,
                    spec.table_format, spec.optimize_write)
        if files is not None:
            note_loaded(files, spec.ledger_path)


def build_silver(spark: SparkSession, spec: PipelineSpec, run_ts: dt.datetime) -> DataFrame:
    """The silver frame (lazy): parsed log lines, or the result of ``sql_silver``."""
    if spec.is_log:
        bronze = read_layer(spark, spec.bronze_table, spec.bronze_path, spec.table_format)
        silver = parse_access_log(bronze, log_column(spec.file_name))
    else:
        silver = spark.sql(require_sql(spec.sql_silver, "silver"))
    return with_control_columns(silver.drop(*CONTROL_COLUMNS), run_ts)


def bronze_to_silver(spark: SparkSession, spec: PipelineSpec, run_ts: dt.datetime | None = None) -> None:
    """Stage 3: parse (or run ``sql_silver``), gate on quality, publish silver."""
    run_ts = run_ts or _now()
    with audited_stage(spark, spec.pipeline_name, "silver", spec.silver_path, run_ts):
        silver = build_silver(spark, spec, run_ts)
        observation = Observation("silver_quality")
        version = new_version_path(spec.silver_path)
        # observe after the optional rebalance: the counts then live in the
        # write's result stage (exactly-once accumulator updates)
        staged = sized_for_write(silver, spec.optimize_write).observe(observation, *count_exprs(spec.is_log))
        try:
            write_version(staged, version, spec.table_format, optimize_write=False)
            results = evaluate_rules(observation.get, spec.is_log)
            append_rows(
                results_frame(spark, results, spec.pipeline_name, SILVER_STEP, spec.table_name_silver, run_ts),
                QUALITY_TABLE,
            )
            bad = failed(results)
            if bad:
                names = ", ".join(f"{r.rule} ({r.percentage_ok})" for r in bad)
                raise QualityGateError(f"quality check failed at step {SILVER_STEP}: {names}")
        except BaseException:
            remove_path(spark, version)  # never published: drop the partial or rejected version
            raise
        publish_layer(spark, spec.silver_table, version, spec.table_format, schema=silver.schema)
        if spec.once_only:
            accept_files(spark, spec.ledger_path, spec.pipeline_name, run_ts)


def silver_to_gold(spark: SparkSession, spec: PipelineSpec, run_ts: dt.datetime | None = None) -> None:
    """Stage 4: ``gold_builder(silver)`` or ``sql_gold`` → ``gold.<table>``."""
    run_ts = run_ts or _now()
    with audited_stage(spark, spec.pipeline_name, "gold", spec.gold_path, run_ts):
        if spec.gold_builder is not None:
            gold = spec.gold_builder(read_layer(spark, spec.silver_table, spec.silver_path, spec.table_format))
        else:
            gold = spark.sql(require_sql(spec.sql_gold, "gold"))
        gold = with_control_columns(gold.drop(*CONTROL_COLUMNS), run_ts)
        write_layer(gold, spec.gold_table, spec.gold_path, spec.table_format, spec.optimize_write)


STAGES = (check_landing, landing_to_bronze, bronze_to_silver, silver_to_gold)


def run(spark: SparkSession, spec: PipelineSpec, until: int = 4, run_ts: dt.datetime | None = None) -> None:
    """Run stages 1..``until`` (1 landing, 2 bronze, 3 silver, 4 gold) in order;
    the first failing stage stops the run."""
    if until not in (1, 2, 3, 4):
        raise ValueError(f"invalid step {until}: expected 1, 2, 3 or 4")
    ensure_environment(spark, spec.base_path, spec.table_format)
    for stage in STAGES[:until]:
        stage(spark, spec, run_ts)


def log_analysis(spark: SparkSession, spec: PipelineSpec) -> dict[str, DataFrame]:
    """Chart data of the gold report: ``report`` (the table), exploded
    ``top_ips`` and ``top_endpoints``, and the first row's ``kpis``."""
    gold = read_layer(spark, spec.gold_table, spec.gold_path, spec.table_format)
    return {"report": gold, **report_frames(gold)}


def monitoring_analysis(spark: SparkSession, table: str = EXECUTION_LOG_TABLE) -> dict[str, DataFrame]:
    """Chart data of the execution log, aggregated in Spark: mean duration
    per step (slowest first) and stage runs per pipeline and status."""
    logs = spark.table(table)
    return {"logs": logs, "durations": run_durations(logs), "status": run_status(logs)}
