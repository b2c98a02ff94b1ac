"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import remove, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and read
    back: later steps neither recompute it nor depend on an executor's disk."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stored_for(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` as in ``stored`` for the steps inside, which store what they make of it;
    then its files go."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def stored_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """The first row of each key, written once as in ``stored`` but dealt by key into as
    many buckets as a shuffle has partitions: joins on the key send the other side only.
    Buckets need a table; its name is dropped at once, the files stay."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table_name = f"{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(n, key).dropDuplicates([key])
    dealt.write.bucketBy(n, key).option("path", scratch_path(spark, name)).saveAsTable(table_name, format="parquet")
    out = spark.table(table_name)
    spark.sql(f"DROP TABLE {table_name}")
    return out


def whole_text(col: str = "text"):
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def byte_chunks(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts as UTF-8 bytes, ``limit`` bytes at a time (a longer text
    comes alone); yields (index of the first text, texts).  Null reads as empty."""
    start, size, chunk = 0, 0, []
    for i, value in enumerate(texts.cast(pa.large_binary())):
        data = value.as_py() or b""
        if chunk and size + len(data) > limit:
            yield start, chunk
            start, size, chunk = i, 0, []
        chunk.append(data)
        size += len(data)
    if chunk:
        yield start, chunk
