"""Catalog tables: namespaces, audit DDL, layer writes, appends, purge.

Layer tables are *external* tables (explicit location on shared storage).
A layer that is replaced as a whole (silver behind its quality gate) is
written to a fresh version folder first; once it is accepted the folder is
marked and the catalog entry is pointed at it (``publish_layer``).  Readers
never see a half-written version, a failed job leaves the previous one
intact, and the previous one is kept until the next publish, so readers that
planned before it can finish.  The catalog entry changes its location in one
step; only where the columns differ it is dropped and created again, and for a
moment a lookup by name can miss (``read_layer`` then falls back to the newest
marked version).

Append-only tables (the audit tables) are purged in place: of the files listed
when the purge begins, those with a row to remove are rewritten and removed;
other files, and those that other runs append meanwhile, are not touched.
Compaction sorts a table by its key columns and writes bloom filters for them, so
that reads and purges of one pipeline skip the files of the others.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.plans.spec import DATABASES, EXECUTION_LOG_TABLE, QUALITY_TABLE
from tidelog.schemas import EXECUTION_LOG_SCHEMA, QUALITY_SCHEMA, ddl

PARTITION_COLUMN = "processed_date"
REGISTER_PARTITIONS = "spark.sql.hive.manageFilesourcePartitions"


def ensure_environment(spark: SparkSession, base_path: str, table_format: str = "parquet") -> None:
    """Create the five namespaces and the two audit tables if missing (idempotent)."""
    base = base_path.rstrip("/")
    for db in DATABASES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{base}/{db}.db'")
    for table, schema in ((EXECUTION_LOG_TABLE, EXECUTION_LOG_SCHEMA), (QUALITY_TABLE, QUALITY_SCHEMA)):
        location = f"{base}/{table.replace('.', '/')}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({ddl(schema)}) USING {table_format} LOCATION '{location}'"
        )


def with_control_columns(df: DataFrame, run_ts) -> DataFrame:
    """Stamp the run instant and its (session-zone) date on every row."""
    ts = F.lit(run_ts).cast("timestamp")
    return df.withColumn("processed_timestamp", ts).withColumn(PARTITION_COLUMN, F.to_date(ts))


def sized_for_write(df: DataFrame, optimize_write: bool) -> DataFrame:
    # one date per run: AQE splits the rebalance into advisory-size files
    return df.hint("rebalance", PARTITION_COLUMN) if optimize_write else df


VERSION_PREFIX = "v="
PUBLISHED_MARK = "_PUBLISHED"


def new_version_path(path: str) -> str:
    """A fresh, name-sortable version folder under a layer path."""
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{path.rstrip('/')}/{VERSION_PREFIX}{stamp}-{uuid.uuid4().hex[:8]}"


def write_version(df: DataFrame, path: str, table_format: str = "parquet", optimize_write: bool = False) -> None:
    """Write a new, not yet published version of a layer to its own folder."""
    sized_for_write(df, optimize_write).write.format(table_format).mode("errorifexists").partitionBy(
        PARTITION_COLUMN
    ).save(path)


def write_layer(df: DataFrame, table: str, path: str, table_format: str = "parquet",
                optimize_write: bool = False) -> str:
    """Full overwrite of a layer table, partitioned by ``processed_date``, with
    the schema replaced by the frame's.

    The data goes to a new version folder under ``path``; only after the
    write job has committed is the table pointed there, so a failed or
    interrupted job leaves the previous table whole.  Returns the published
    version folder.
    """
    version = new_version_path(path)
    try:
        write_version(df, version, table_format, optimize_write)
    except BaseException:
        remove_path(df.sparkSession, version)
        raise
    publish_layer(df.sparkSession, table, version, table_format, schema=df.schema)
    return version


def table_location(spark: SparkSession, table: str) -> str | None:
    return table_details(spark, table).get("Location")


def columns_ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE (names quoted, nested types kept as written)."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def table_details(spark: SparkSession, table: str) -> dict[str, str]:
    """The detail rows of DESCRIBE TABLE EXTENDED by name (none if there is no table)."""
    if not spark.catalog.tableExists(table):
        return {}
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    start = next((i for i, r in enumerate(rows) if r.col_name.startswith("# Detailed")), len(rows))
    return {r.col_name: r.data_type for r in rows[start + 1 :]}


def can_repoint(spark: SparkSession, table: str, table_format: str, schema: T.StructType | None) -> bool:
    """Is a new location all that differs?  Same format and columns, and partitions
    found from the folder layout, not kept one by one in the catalog."""
    details = table_details(spark, table)
    if schema is None or details.get("Provider", "").lower() != table_format.lower():
        return False
    if details.get("Partition Provider") == "Catalog":
        return False

    def shape(fields):  # partition columns come last in a table
        columns = [(f.name, f.dataType.simpleString()) for f in fields]
        return sorted(columns, key=lambda c: c[0] == PARTITION_COLUMN)

    return shape(spark.table(table).schema.fields) == shape(schema.fields)


def publish_version(spark: SparkSession, table: str, location: str, table_format: str = "parquet",
                    partitioned: bool = True, schema: T.StructType | None = None) -> None:
    """Point ``table`` at the data in ``location``.

    A table of the same format and columns gets its new location in one catalog
    step, so a reader finds the version before or this one at any time.  For that
    the partitions are not registered in the catalog: a version is one run's folder,
    and Spark finds its partitions when it lists the files.  The first publish,
    one with other columns and that of a table with registered partitions create
    the entry anew (it is external, so every file is kept).  ``schema`` (that of
    the written frame) is declared, so that an empty version, which has no data
    file to infer it from, still publishes.
    """
    if can_repoint(spark, table, table_format, schema):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        return
    columns = f"({columns_ddl(schema)}) " if schema is not None else ""
    partitioning = f"PARTITIONED BY ({PARTITION_COLUMN}) " if partitioned and schema is not None else ""
    before = spark.conf.get(REGISTER_PARTITIONS)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.conf.set(REGISTER_PARTITIONS, "false")
    try:
        spark.sql(f"CREATE TABLE {table} {columns}USING {table_format} {partitioning}LOCATION '{location}'")
    finally:
        spark.conf.set(REGISTER_PARTITIONS, before)


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path of any scheme."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _hadoop(spark, path)
    return fs.exists(hpath)


def published_versions(spark: SparkSession, path: str) -> list[str]:
    """The ``v=…`` folders under a layer path that were accepted, oldest first
    (names sort by time).  Folders of failed or refused runs carry no mark."""
    if not path_exists(spark, path):
        return []
    fs, hpath = _hadoop(spark, path)
    names = sorted(st.getPath().getName() for st in fs.listStatus(hpath) if st.isDirectory())
    found = [f"{path.rstrip('/')}/{n}" for n in names if n.startswith(VERSION_PREFIX)]
    return [v for v in found if path_exists(spark, f"{v}/{PUBLISHED_MARK}")]


def publish_layer(spark: SparkSession, table: str, version: str, table_format: str = "parquet",
                  schema: T.StructType | None = None) -> None:
    """Mark an accepted version folder, point ``table`` at it and remove the
    published versions before the one it replaces (that one stays, so that
    running readers keep their files)."""
    path = version.rstrip("/").rsplit("/", 1)[0]
    before = published_versions(spark, path)
    fs, mark = _hadoop(spark, f"{version}/{PUBLISHED_MARK}")
    fs.create(mark, True).close()
    publish_version(spark, table, version, table_format, schema=schema)
    for old in before[:-1]:
        remove_path(spark, old)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of an unpublished or superseded version (any scheme)."""
    fs, hpath = _hadoop(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder (its parent is made); fails if the target is there."""
    fs, src = _hadoop(spark, source)
    dst = _hadoop(spark, target)[1]
    fs.mkdirs(dst.getParent())
    if fs.exists(dst) or not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")


def read_layer(spark: SparkSession, table: str, path: str | None = None, table_format: str = "parquet") -> DataFrame:
    """A layer by catalog name, falling back to the newest published version under its path."""
    try:
        return spark.read.table(table)
    except AnalysisException:
        versions = published_versions(spark, path) if path else []
        if not versions:
            raise
        return spark.read.format(table_format).load(versions[-1])


def append_rows(df: DataFrame, table: str) -> None:
    """Append to a catalog table: by position into an existing table, or
    creating it (columns by name) when a stage runs before the environment
    was prepared."""
    if df.sparkSession.catalog.tableExists(table):
        df.write.mode("append").insertInto(table)
    else:
        df.write.mode("append").saveAsTable(table)


def data_files(fs, folder) -> list:
    """Paths of the data files directly in a folder."""
    return [st.getPath() for st in fs.listStatus(folder)
            if st.isFile() and not st.getPath().getName().startswith(("_", "."))]


def purge_rows(spark: SparkSession, table: str, condition: Column | str, table_format: str = "parquet") -> int:
    """``DELETE FROM table WHERE condition`` for unpartitioned tables without
    DELETE support.  Returns the number of rows kept of those in the files it found.

    A first scan, of the condition's columns and with the condition pushed down,
    finds the files with a row to remove; only these are rewritten.  Where a table
    has been compacted by the columns of the condition, these are few and the
    others are skipped by their statistics.
    """
    cond = F.expr(condition) if isinstance(condition, str) else condition
    location, listed = listed_files(spark, table)
    if not listed:
        return 0
    rows = read_files(spark, table, listed, table_format)
    hit = {r[0] for r in rows.filter(cond).select("_metadata.file_name").distinct().collect()}
    hit_files = [p for p in listed if hit & {p.getName(), encoded_name(p)}]
    others = [p for p in listed if p not in hit_files]
    kept = read_files(spark, table, others, table_format).count() if others else 0  # from the footers
    if hit_files:
        left = read_files(spark, table, hit_files, table_format).filter(~F.coalesce(cond, F.lit(False)))
        kept += replace_files(spark, table, location, hit_files, left.hint("rebalance"), table_format)
    return kept


def listed_files(spark: SparkSession, table: str) -> tuple[str, list]:
    """A table's location and the data files that it has now."""
    location = table_location(spark, table)
    if location is None:
        raise ValueError(f"table {table} does not exist")
    spark.catalog.refreshTable(table)
    return location, data_files(*_hadoop(spark, location))


def encoded_name(path) -> str:
    """A file's name as it stands in a URI."""
    return path.toUri().getRawPath().rsplit("/", 1)[-1]


def read_files(spark: SparkSession, table: str, files: list, table_format: str) -> DataFrame:
    schema = spark.table(table).schema
    return spark.read.schema(schema).format(table_format).load([glob_literal(p.toString()) for p in files])


def replace_files(spark: SparkSession, table: str, location: str, files: list, rows: DataFrame,
                  table_format: str, **options: str) -> int:
    """Put ``rows`` in place of some of a table's files; returns their number.

    The rows go to a hidden folder inside the table's, whose files then move into
    place before the replaced ones are removed: a run that dies in between leaves
    rows twice, never too few.
    """
    seen = Observation("kept")
    base = location.rstrip("/")
    staging = f"{base}/_purge-{uuid.uuid4().hex[:12]}"
    written = rows.observe(seen, F.count(F.lit(1)).alias("n"))
    written.write.format(table_format).options(**options).save(staging)
    fs, folder = _hadoop(spark, staging)
    for path in data_files(fs, folder):
        fs.rename(path, _hadoop(spark, f"{base}/{path.getName()}")[1])
    for path in files:
        fs.delete(path, False)
    remove_path(spark, staging)
    spark.catalog.refreshTable(table)
    return int(seen.get["n"])


def glob_literal(path: str) -> str:
    """A path as a pattern that matches only itself (readers take paths as patterns)."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def compact_table(spark: SparkSession, table: str, table_format: str = "parquet",
                  by: tuple[str, ...] = ("pipeline_name",)) -> int:
    """Rewrite the files that an append-only table (one small file per appended
    audit row) has now into few, in the order of the columns ``by`` (those that the
    table has), and return the number of rows.

    A file then holds a range of them, and Parquet files have bloom filters for
    them: a read by equality or prefix skips the row groups of other values.  A
    value with very many rows is spread over several files by the other columns.
    """
    location, listed = listed_files(spark, table)
    if not listed:
        return 0
    rows = read_files(spark, table, listed, table_format)
    keys = [c for c in by if c in rows.columns]
    order = keys + [c for c, kind in rows.dtypes if c not in keys and not kind.startswith("map")]
    options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in keys} if table_format == "parquet" else {}
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order) if keys else rows.hint("rebalance")
    return replace_files(spark, table, location, listed, sorted_rows, table_format, **options)
