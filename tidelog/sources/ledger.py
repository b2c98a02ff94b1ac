"""Once-only ingest: a ledger of landing files already loaded.

A file is identified by path, modification time and size, so an
unchanged file is skipped while a new delivery under the same name loads
again.  The unseen files are found from the file listing alone (the
``binaryFile`` source without its ``content`` column reads no data) and
stored; the reader takes the whole folder and keeps the rows whose file is one
of them, so no list of paths is made on the driver, however many files landed.
Files modified before the oldest or after the newest unseen one are pruned by
their listing and not opened.

A run takes all unseen files, unless ``max_files`` asks for the oldest ones only.
The files a run has loaded are noted beside the ledger and entered into it only
when the data they gave is accepted (``accept_files``), so a run after a failed
quality gate loads them again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.plans.tables import path_exists
from tidelog.session import scratch_path
from tidelog.sources.landing import csv_schema, read_landing

FILE_KEYS = ("file_path", "file_modification_time", "file_size")

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("file_modification_time", T.TimestampType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)


def landing_files(spark: SparkSession, landing_path: str, glob: str | None = None) -> DataFrame:
    """One row per file under ``landing_path``: path, modification time, size."""
    return _listing(spark, landing_path, glob).select(*FILE_KEYS)


def _listing(spark: SparkSession, landing_path: str, glob: str | None) -> DataFrame:
    """``landing_files`` with ``read_path``, the path as the rows' metadata have it (encoded)."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(landing_path).select(
        F.col("path").alias("file_path"),
        F.col("modificationTime").alias("file_modification_time"),
        F.col("length").alias("file_size"),
        F.col("_metadata.file_path").alias("read_path"),
    )


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The ledger's rows; only a ledger that does not exist yet counts as empty."""
    if not path_exists(spark, ledger_path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)


def unseen_files(spark: SparkSession, landing_path: str, ledger_path: str, glob: str | None = None) -> DataFrame:
    """Files under ``landing_path`` whose (path, mtime, size) is not in the ledger."""
    return _unseen(spark, landing_path, ledger_path, glob).select(*FILE_KEYS)


def _unseen(spark: SparkSession, landing_path: str, ledger_path: str, glob: str | None) -> DataFrame:
    seen = read_ledger(spark, ledger_path).select(*FILE_KEYS)
    return _listing(spark, landing_path, glob).join(seen, list(FILE_KEYS), "left_anti")


def read_unseen(spark: SparkSession, landing_path: str, ledger_path: str, fmt: str,
                glob: str | None = None, max_files: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows of the unseen files, those files) for one ingest run.

    All unseen files are taken, or the oldest ``max_files`` (by modification
    time, then path).  The listing is stored, so what is read and what is
    recorded are the same snapshot of the folder.  A file rewritten between
    listing and reading gives no rows and is recorded under its listed identity,
    so the next run sees a new identity and loads it.  The columns of CSV files
    are those of the widest line of all files taken.  Raises ``FileNotFoundError`` when nothing
    new landed.
    """
    unseen = _unseen(spark, landing_path, ledger_path, glob)
    if max_files is not None:
        unseen = unseen.orderBy("file_modification_time", "file_path").limit(max_files)
    path = scratch_path(spark, "unseen-files")
    unseen.write.parquet(path)
    listed = spark.read.schema(unseen.schema).parquet(path)
    first, last = listed.agg(F.min("file_modification_time"), F.max("file_modification_time")).first()
    if first is None:
        raise FileNotFoundError(f"no unseen landing file under {landing_path}")
    files = listed.select("read_path", "file_modification_time", "file_size")

    def own(rows: DataFrame, columns: list[str]) -> DataFrame:
        """The rows that come from one of the files."""
        modified = F.col("_metadata.file_modification_time")
        # literals on the metadata prune files before they are opened
        rows = rows.filter((modified >= F.lit(first)) & (modified <= F.lit(last)))
        rows = rows.select(*columns, F.col("_metadata.file_path").alias("path__"), modified.alias("modified__"),
                           F.col("_metadata.file_size").alias("size__"))
        met = ((F.col("path__") == F.col("read_path")) & (F.col("modified__") == F.col("file_modification_time"))
               & (F.col("size__") == F.col("file_size")))
        # one short row a file, stored: Spark knows the size, sends a short list to the lines and
        # shuffles by file where the list is longer than its limit for that
        return rows.join(files, met, "left_semi").select(*columns)

    schema = None
    if fmt == "csv":
        schema = csv_schema(own(read_landing(spark, landing_path, "text", glob), ["value"]))
    rows = read_landing(spark, landing_path, fmt, glob, schema)
    return own(rows, rows.columns), listed.select(*FILE_KEYS)


def record_files(files: DataFrame, ledger_path: str, pipeline_name: str,
                 ingested_at: dt.datetime) -> None:
    """Append the ingested files to the ledger (one row per file)."""
    files.select(
        *FILE_KEYS,
        F.lit(pipeline_name).alias("pipeline_name"),
        F.lit(ingested_at).cast("timestamp").alias("ingested_at"),
    ).write.mode("append").parquet(ledger_path)


def loaded_path(ledger_path: str) -> str:
    return f"{ledger_path.rstrip('/')}_loaded"


def note_loaded(files: DataFrame, ledger_path: str) -> None:
    """Note the files that the raw layer holds now, until they are accepted or loaded anew."""
    files.select(*FILE_KEYS).write.mode("overwrite").parquet(loaded_path(ledger_path))


def accept_files(spark: SparkSession, ledger_path: str, pipeline_name: str, ingested_at: dt.datetime) -> None:
    """Enter the noted files into the ledger (those that are not in it yet)."""
    if path_exists(spark, loaded_path(ledger_path)):
        noted = spark.read.schema(T.StructType(LEDGER_SCHEMA[:3])).parquet(loaded_path(ledger_path))
        new = noted.join(read_ledger(spark, ledger_path).select(*FILE_KEYS), list(FILE_KEYS), "left_anti")
        record_files(new, ledger_path, pipeline_name, ingested_at)
