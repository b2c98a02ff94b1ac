"""Landing folder as a file stream (Structured Streaming).

For landing zones that receive files continuously.  The file source keeps
the set of consumed files in its checkpoint (each file is read once), and
``cleanSource=archive`` moves every consumed file to an archive folder,
as the batch pipeline's "processed" folder does (a batch's files move once
the stream plans its next batch, so with available-now runs the last
batch's files move during the next run that finds new data).
``trigger(availableNow)`` turns it into an incremental batch job: consume
what has landed, stop.

``gated_silver_writer`` is the streaming form of the silver stage: every
micro-batch is parsed and checked with the same rules (counts observed during
the write) in a staging folder beside silver, and only an accepted batch is
moved into silver, as one folder named after the query and the batch.  Readers
never see rows that were refused.  A batch that is replayed finds its folder and
its rule rows in place and adds nothing; a new checkpoint is a new query, whose
batches cannot replace those of another.  A batch that fails a rule stops the
stream and leaves only its rule rows.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.logparse import parse_access_log
from tidelog.operators.quality import QualityGateError, count_exprs, evaluate_rules, failed, results_frame
from tidelog.plans.tables import move_path, path_exists, remove_path
from tidelog.schemas import SILVER_LOG_SCHEMA

BATCH_COLUMN = "batch"


def bronze_stream(spark: SparkSession, landing_dir: str, archive_dir: str | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``DataFrame[value, processed_timestamp, processed_date]`` of landing lines."""
    reader = spark.readStream.format("text")
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    ts = F.current_timestamp()
    return reader.load(landing_dir).withColumn("processed_timestamp", ts).withColumn("processed_date", F.to_date(ts))


def ingest_available(spark: SparkSession, landing_dir: str, bronze_path: str, checkpoint: str,
                     archive_dir: str | None = None) -> None:
    """Append every not-yet-consumed landing file to bronze (parquet file sink,
    exactly-once through its commit log), then stop."""
    query = (
        bronze_stream(spark, landing_dir, archive_dir)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("processed_date")
        .trigger(availableNow=True)
        .start(bronze_path)
    )
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def stored_once(rows: DataFrame, table: str) -> None:
    """Append the rule rows of one check unless they are there (same pipeline, step,
    table and time: a replayed batch has the time of its first attempt)."""
    spark = rows.sparkSession
    spark.catalog.refreshTable(table)
    keys = ["pipeline_name", "step", "verified_table", "timestamp"]
    key = rows.select(*keys).first()
    same = spark.table(table).filter(F.col("timestamp") == F.lit(key.timestamp))
    for k in keys[:-1]:
        same = same.filter(F.col(k) == F.lit(key[k]))
    if same.isEmpty():
        rows.write.mode("append").insertInto(table)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gives its query."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value
    return json.loads(text)["id"]


def gated_silver_writer(silver_path: str, checkpoint: str, pipeline_name: str, quality_table: str | None = None,
                        log_column: str = "value") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler: parse → observe rule counts while writing a staging
    folder → store rule rows → raise on failure, else move the folder into silver."""
    silver_path = silver_path.rstrip("/")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{BATCH_COLUMN}={query_id(spark, checkpoint)}-{batch_id}"
        staging, target = f"{silver_path}.staging/{name}", f"{silver_path}/{name}"
        if path_exists(spark, target):  # a replay of an accepted batch
            return
        parsed = parse_access_log(batch, log_column, keep=("processed_timestamp", "processed_date"))
        observation = Observation(f"silver_batch_{batch_id}")
        counts = [*count_exprs(True), F.max("processed_timestamp").alias("checked_at")]
        parsed.observe(observation, *counts).write.mode("overwrite").partitionBy("processed_date").parquet(staging)
        observed = observation.get
        results = evaluate_rules(observed, True)
        if quality_table:
            table_name = silver_path.rsplit("/", 1)[-1]  # bare name, as the batch gate stores it
            # the batch's own time, the same on every replay
            checked_at = observed["checked_at"] or dt.datetime.now(dt.timezone.utc)
            stored_once(results_frame(spark, results, pipeline_name, "bronze_to_silver", table_name, checked_at),
                        quality_table)
        if failed(results):
            remove_path(spark, staging)
            raise QualityGateError(f"quality check failed for micro-batch {batch_id}")
        move_path(spark, staging, target)

    return handle


def read_stream_silver(spark: SparkSession, silver_path: str) -> DataFrame:
    """The rows of all accepted batches, with the columns of the batch pipeline's silver."""
    return spark.read.parquet(silver_path).select(*SILVER_LOG_SCHEMA.names)


def silver_available(spark: SparkSession, landing_dir: str, silver_path: str, checkpoint: str,
                     pipeline_name: str, quality_table: str | None = None, archive_dir: str | None = None,
                     log_column: str = "value", max_files_per_trigger: int | None = None,
                     silver_view: str | None = None) -> None:
    """Landing lines → gated silver, micro-batch by micro-batch, then stop.

    ``max_files_per_trigger`` bounds a batch (so also the first run over a full
    landing folder); ``silver_view`` names a view over the accepted batches to
    create in the catalog.
    """
    stream = bronze_stream(spark, landing_dir, archive_dir, max_files_per_trigger)
    if log_column != "value":
        stream = stream.withColumnRenamed("value", log_column)
    query = (
        stream.writeStream.foreachBatch(
            gated_silver_writer(silver_path, checkpoint, pipeline_name, quality_table, log_column))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    finally:
        # batches run in a session of their own, with a file list of its own
        spark.catalog.refreshByPath(silver_path)
        if quality_table:
            spark.catalog.refreshTable(quality_table)
    if silver_view and path_exists(spark, silver_path):
        columns = ", ".join(f"`{c}`" for c in SILVER_LOG_SCHEMA.names)
        spark.sql(f"CREATE OR REPLACE VIEW {silver_view} AS SELECT {columns} FROM parquet.`{silver_path}`")
