"""Pipeline configuration: what to load, where the layers live, how to build them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

# --- fixed values: layer namespaces and audit tables -------------------------
BRONZE_DB, SILVER_DB, GOLD_DB = "bronze", "silver", "gold"
MONITORING_DB, QUALITY_DB = "monitoring", "quality"
DATABASES = (MONITORING_DB, BRONZE_DB, SILVER_DB, GOLD_DB, QUALITY_DB)
EXECUTION_LOG_TABLE = f"{MONITORING_DB}.execution_logs"
QUALITY_TABLE = f"{QUALITY_DB}.quality_checks"
STEPS = ("landing", "bronze", "silver", "gold")
STATUS_OK, STATUS_NOTOK = "OK", "NOTOK"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class PipelineSpec:
    """One pipeline.  Layer tables are ``bronze.<table_name_bronze>`` etc.,
    stored as external tables under ``base_path`` (shared storage).

    ``landing_path`` is the folder files are delivered to; ``file_name`` the
    delivered file (``.txt`` → text lines, ``.csv`` → headerless CSV).
    ``is_log`` parses access-log lines into silver; otherwise ``sql_silver``
    defines silver.  Gold is ``gold_builder(silver)`` when given, else
    ``sql_gold``.  ``once_only`` skips landing files already ingested
    (same path, modification time and size).  ``optimize_write`` adds a
    rebalance before layer writes (fewer, larger files for small inputs; a
    full shuffle, so off by default: at scale one file per input split is
    already well sized).
    """

    pipeline_name: str
    file_name: str
    landing_path: str
    base_path: str
    table_name_bronze: str
    table_name_silver: str
    table_name_gold: str
    is_log: bool = True
    sql_silver: str | None = ""
    sql_gold: str | None = ""
    gold_builder: Callable[[DataFrame], DataFrame] | None = None
    table_format: str = "parquet"
    once_only: bool = False
    optimize_write: bool = False

    @property
    def bronze_table(self) -> str:
        return f"{BRONZE_DB}.{self.table_name_bronze}"

    @property
    def silver_table(self) -> str:
        return f"{SILVER_DB}.{self.table_name_silver}"

    @property
    def gold_table(self) -> str:
        return f"{GOLD_DB}.{self.table_name_gold}"

    @property
    def landing_dir(self) -> str:
        return self.landing_path.rstrip("/")

    @property
    def landing_file(self) -> str:
        return f"{self.landing_dir}/{self.file_name}"

    def layer_path(self, layer: str, table: str) -> str:
        return f"{self.base_path.rstrip('/')}/{layer}/{self.pipeline_name}/{table}"

    @property
    def bronze_path(self) -> str:
        return self.layer_path(BRONZE_DB, self.table_name_bronze)

    @property
    def silver_path(self) -> str:
        return self.layer_path(SILVER_DB, self.table_name_silver)

    @property
    def gold_path(self) -> str:
        return self.layer_path(GOLD_DB, self.table_name_gold)

    @property
    def ledger_path(self) -> str:
        return f"{self.base_path.rstrip('/')}/landing/{self.pipeline_name}/_ingested_files"


def require_sql(sql: str | None, what: str) -> str:
    """The SQL text, or ``ValueError`` when it is missing or blank."""
    if sql is None or not sql.strip():
        raise ValueError(f"{what} SQL is null or blank")
    return sql
