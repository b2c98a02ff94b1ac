"""Landing-zone reads (text or headerless CSV), chosen by file extension."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: supported landing files and the column holding the raw line
READERS = {".txt": "text", ".csv": "csv"}
LOG_COLUMNS = {".txt": "value", ".csv": "_c0"}
# ---------------------------------------------------------------------------

MOST_COLUMNS = 20480  # of Spark's CSV reader


class UnsupportedFileType(ValueError):
    pass


def landing_format(file_name: str) -> str:
    """``text`` or ``csv`` by extension, case-insensitively (``.TXT`` is text)."""
    if not file_name or not file_name.strip():
        raise ValueError("file_name is empty")
    lowered = file_name.lower()
    for ext, fmt in READERS.items():
        if lowered.endswith(ext):
            return fmt
    raise UnsupportedFileType(f"unsupported file type: {file_name}")


def log_column(file_name: str) -> str:
    """Column holding the raw log line in bronze: ``value`` for ``.txt``,
    ``_c0`` for ``.csv``.  Case-sensitive, as the silver stage always was:
    ``.TXT`` loads into bronze and then fails here."""
    for ext, column in LOG_COLUMNS.items():
        if file_name.endswith(ext):
            return column
    raise UnsupportedFileType(f"unsupported file type for a log: {file_name} (use .txt or .csv)")


def csv_width(line: Column) -> Column:
    """Number of fields of a CSV line: one more than its commas outside quotes, where
    a quote opens only at the start of a field and a backslash escapes (a backslash
    right behind a closing quote may count a comma too many, never one too few)."""
    closed = F.regexp_replace(line, r'(^|,)"(?:[^"\\]|\\.)*+"', "$1q")
    bare = F.when(F.contains(line, F.lit('"')), F.regexp_replace(closed, r'(^|,)".*$', "$1")).otherwise(line)
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1


def csv_schema(lines: DataFrame, misfits: str | None = None) -> T.StructType:
    """String columns ``_c0.._cN`` for the widest of all lines (column ``value``), found
    in one aggregation, and ``misfits`` if named."""
    width = lines.filter("trim(value) <> ''").agg(F.max(csv_width(F.col("value"))).alias("n")).first()["n"] or 1
    names = [f"_c{i}" for i in range(min(width, MOST_COLUMNS))] + ([misfits] if misfits else [])
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_ragged(spark: SparkSession, path, glob: str | None = None, misfits: str | None = None) -> DataFrame:
    """CSV files whose lines differ in width, with the columns of the widest line: no field
    is lost, whichever file has it; shorter lines end in nulls.

    ``misfits`` names a column that holds the whole line where it has another number of
    fields than the widest one, else null.
    """
    schema = csv_schema(read_landing(spark, path, "text", glob), misfits)
    return read_landing(spark, path, "csv", glob, schema, misfits)


def read_landing(spark: SparkSession, path: str, fmt: str, glob: str | None = None,
                 schema: T.StructType | None = None, misfits: str | None = None) -> DataFrame:
    """Read landing data lazily and splittably.

    ``text``: one row per line (empty lines kept), column ``value``.
    ``csv``: no header, no inference, all-string ``_c0.._cN``; blank lines
    are dropped and a comma inside a line starts a new column.
    ``glob`` selects files of a folder by name; a ``schema`` gives the columns of
    CSV, instead of the first line (``read_ragged`` takes the widest one), and
    ``misfits`` its column for lines of another width.
    A missing path raises ``FileNotFoundError`` naming the path.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if misfits:
        reader = reader.option("columnNameOfCorruptRecord", misfits)
    try:
        if fmt == "text":
            return reader.text(path)
        if fmt == "csv":
            return (reader.schema(schema) if schema else reader).csv(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(f"landing file not found: {path}") from exc
        raise
    raise UnsupportedFileType(f"unsupported landing format: {fmt}")
