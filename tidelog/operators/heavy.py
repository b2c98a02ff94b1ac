"""Exact top-k of a key with a shuffle that does not grow with the number of keys.

Counting every key shuffles one row per key and task.  Here a count sketch comes
first: ``ROWS`` hash functions deal the keys to ``WIDTH`` buckets each, and lines are
counted per bucket (at most ``ROWS * WIDTH`` rows a task, whatever the keys).  A bucket
bounds each of its keys from above.  The keys of the largest buckets are counted
exactly; the k-th of their counts is a floor that every key of the true top k reaches.
Only keys whose buckets reach the floor under every hash function are candidates, and
they are counted exactly over all lines.

The sketch adds up: sketches of parts of the lines sum to that of all.  Where the
bound is loose (many keys of about equal counts, so that candidates hold more than
``LOOSE`` of the buckets), every key is counted instead; the result is the same.

Broadcast are lists of buckets, at most ``WIDTH`` numbers for each hash function.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.http import is_page
from tidelog.operators.metrics import TOP_CLIENT_IPS, TOP_ENDPOINTS, hits_by, top_k
from tidelog.session import scratch_path

ROWS, WIDTH = 2, 1 << 16
PROBED = 4  # buckets counted exactly for the floor, for each of the k
LOOSE = 0.25


def bucket(key: str, row: int, width: int = WIDTH) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), F.col(key)), F.lit(width)).cast("int")


def count_sketch(lines: DataFrame, key: str, width: int = WIDTH) -> DataFrame:
    """``(row, bucket, hits)``: lines per bucket of each hash function (null keys count)."""
    both = F.posexplode(F.array(*[bucket(key, r, width) for r in range(ROWS)])).alias("row", "bucket")
    return lines.select(both).groupBy("row", "bucket").agg(F.count(F.lit(1)).alias("hits"))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("row", "bucket").agg(F.sum("hits").alias("hits"))


def _in_buckets(lines: DataFrame, key: str, row: int, buckets: DataFrame, width: int) -> DataFrame:
    """The lines whose key is dealt to one of the buckets (at most ``width`` of them)."""
    own = F.broadcast(buckets.filter(F.col("row") == row).select(F.col("bucket").alias("bucket_")))
    return lines.join(own, bucket(key, row, width) == F.col("bucket_"), "left_semi")


def top_by_sketch(lines: DataFrame, key: str, k: int, sketch: DataFrame | None = None, width: int = WIDTH,
                  loose: float = LOOSE) -> DataFrame:
    """``(key, access_count)`` of the k most frequent keys, ties by key, as ``top_k`` of
    ``hits_by`` gives them.  ``sketch`` is a merged sketch of exactly these lines."""
    spark, lines = lines.sparkSession, lines.select(key)
    path = scratch_path(spark, "count-sketch")
    (count_sketch(lines, key, width) if sketch is None else sketch).write.parquet(path)
    sketch = spark.read.schema("row int, bucket int, hits long").parquet(path)
    largest = sketch.filter("row = 0").orderBy(F.desc("hits"), "bucket").limit(PROBED * k)
    probed = top_k(hits_by(_in_buckets(lines, key, 0, largest, width), key), key, k)
    floor = probed.agg(F.count("*").alias("n"), F.min("access_count").alias("least")).first()
    if floor["n"] < k:  # fewer keys than that in the largest buckets
        return top_k(hits_by(lines, key), key, k)
    reach = sketch.filter(F.col("hits") >= floor["least"])
    most = reach.groupBy("row").count().agg(F.max("count")).first()[0]
    if most > loose * width:
        return top_k(hits_by(lines, key), key, k)
    candidates = reduce(lambda found, row: _in_buckets(found, key, row, reach, width), range(ROWS), lines)
    return top_k(hits_by(candidates, key), key, k)


def top_clients_by_sketch(silver: DataFrame, k: int = TOP_CLIENT_IPS) -> DataFrame:
    return top_by_sketch(silver, "client_ip", k)


def top_pages_by_sketch(silver: DataFrame, k: int = TOP_ENDPOINTS) -> DataFrame:
    pages = silver.filter(is_page(F.col("endpoint_clean"))).select(F.col("endpoint_clean").alias("endpoint"))
    return top_by_sketch(pages, "endpoint", k)
