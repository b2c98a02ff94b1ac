"""Execution log: one row per stage run (OK, or NOTOK with the error text)."""

from __future__ import annotations

import datetime as dt
import logging
import time
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tidelog.plans.spec import EXECUTION_LOG_TABLE, STATUS_NOTOK, STATUS_OK
from tidelog.plans.tables import append_rows
from tidelog.schemas import EXECUTION_LOG_SCHEMA

log = logging.getLogger(__name__)

INSERT_EXECUTION_LOG_SQL = (
    f"INSERT INTO {EXECUTION_LOG_TABLE} VALUES "
    "(:execution_time, :pipeline_name, :step, :status, :error_message, :processed_file_path, :time_elapsed)"
)


def save_execution_log(spark: SparkSession, execution_time: dt.datetime, pipeline_name: str, step: str,
                       status: str, error_message: str, processed_file_path: str, time_elapsed: float,
                       table: str = EXECUTION_LOG_TABLE) -> bool:
    """Append one execution-log row; returns whether it was stored.

    The row is appended as a one-row DataFrame; if that fails, through a
    parameterised ``INSERT`` (no quoting issues with error texts).  A
    failure of both is logged and swallowed, so auditing can never hide
    the error of the stage being audited.
    """
    row = (execution_time, pipeline_name, step, status, error_message, processed_file_path, float(time_elapsed))
    try:
        append_rows(spark.createDataFrame([row], EXECUTION_LOG_SCHEMA), table)
        return True
    except Exception as first:  # noqa: BLE001
        try:
            insert_execution_log(spark, *row, table=table)
            return True
        except Exception as second:  # noqa: BLE001
            log.warning("could not store execution log row (%s; %s)", first, second)
            return False


def insert_execution_log(spark: SparkSession, execution_time, pipeline_name, step, status, error_message,
                         processed_file_path, time_elapsed, table: str = EXECUTION_LOG_TABLE) -> None:
    """The SQL form of the append, with named parameters."""
    sql = INSERT_EXECUTION_LOG_SQL.replace(EXECUTION_LOG_TABLE, table)
    spark.sql(
        sql,
        args={
            "execution_time": execution_time,
            "pipeline_name": pipeline_name,
            "step": step,
            "status": status,
            "error_message": error_message,
            "processed_file_path": processed_file_path,
            "time_elapsed": float(time_elapsed),
        },
    )


@contextmanager
def audited_stage(spark: SparkSession, pipeline_name: str, step: str, path: str,
                  execution_time: dt.datetime | None = None, table: str = EXECUTION_LOG_TABLE):
    """Time a stage and store exactly one row for it: OK on success, NOTOK
    with the error text on failure (the error is re-raised)."""
    started = execution_time or dt.datetime.now(dt.timezone.utc)
    t0 = time.monotonic()
    try:
        yield
    except BaseException as exc:
        save_execution_log(spark, started, pipeline_name, step, STATUS_NOTOK, f"{exc}", path,
                           time.monotonic() - t0, table)
        raise
    save_execution_log(spark, started, pipeline_name, step, STATUS_OK, "", path, time.monotonic() - t0, table)
