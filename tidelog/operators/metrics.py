"""Report metrics over a parsed access log (silver schema).

Scale notes
-----------
* Every count is a ``groupBy``/``agg`` whose partial aggregation runs on
  the map side, so a hot key (one client sending a third of all lines)
  collapses to one row per map task before the shuffle; no hot group is
  ever collected into one task.
* Top-k is ``orderBy(...).limit(k)``, planned as ``TakeOrderedAndProject``:
  each task keeps k rows, the driver merges k × tasks rows.  No global sort.
* The day/volume/weekday metrics share one scan grouped by *day*: after
  partial aggregation a map task emits at most one row per distinct day,
  so the shuffle is tiny however large the log is.
* Ties in top-k are broken on the key (ascending, nulls last) so results
  are deterministic; the original order among ties was undefined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.http import event_day, is_client_error, is_page, response_category, weekday_name

# --- fixed values: report sizes ---------------------------------------------
TOP_CLIENT_IPS = 10
TOP_ENDPOINTS = 6
# ---------------------------------------------------------------------------


def _size(df: DataFrame) -> Column:
    # the report treats sizes as doubles (TRY_CAST(response_size AS DOUBLE))
    return F.col("response_size").try_cast("double")


def hits_by(df: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    """``(key, access_count)``: lines per key (map-side combined)."""
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias("access_count"))
    return out.withColumnRenamed(key, alias) if alias and alias != key else out


def top_k(counts: DataFrame, key: str, k: int) -> DataFrame:
    """The k largest ``access_count`` rows; ties by key ascending."""
    return counts.orderBy(F.col("access_count").desc(), F.col(key).asc_nulls_last()).limit(k)


def hits_by_client_ip(silver: DataFrame) -> DataFrame:
    return hits_by(silver.select("client_ip"), "client_ip")


def page_hits(silver: DataFrame) -> DataFrame:
    """Hits per cleaned endpoint, static assets and robots.txt excluded.

    The page test comes before the grouping: over stored silver it reaches the
    scan, and asset keys are never shuffled.
    """
    pages = silver.select("endpoint_clean").filter(is_page(F.col("endpoint_clean")))
    return hits_by(pages, "endpoint_clean", "endpoint")


def top_client_ips(silver: DataFrame, k: int = TOP_CLIENT_IPS) -> DataFrame:
    """``(client_ip, access_count)`` for the k busiest clients."""
    return top_k(hits_by_client_ip(silver), "client_ip", k)


def top_endpoints(silver: DataFrame, k: int = TOP_ENDPOINTS) -> DataFrame:
    """``(endpoint, access_count)`` for the k most requested pages."""
    return top_k(page_hits(silver), "endpoint", k)


def daily_rollup(silver: DataFrame) -> DataFrame:
    """One row per event day (null day for unparsable times).

    Columns: ``date``, ``client_errors`` (4xx lines), ``size_sum``,
    ``size_max``, ``size_min``, ``size_n`` (non-null sizes).  Everything
    the report needs from the time, status and size columns, in one scan.
    """
    size = _size(silver)
    return silver.groupBy(event_day(F.col("timestamp")).alias("date")).agg(
        F.count_if(F.coalesce(is_client_error(F.col("status_code")), F.lit(False))).alias("client_errors"),
        F.sum(size).alias("size_sum"),
        F.max(size).alias("size_max"),
        F.min(size).alias("size_min"),
        F.count(size).alias("size_n"),
    )


def volume_stats(silver: DataFrame) -> DataFrame:
    """One row: ``total_volume, max_volume, min_volume, avg_volume`` (nulls ignored)."""
    size = _size(silver)
    return silver.agg(
        F.sum(size).alias("total_volume"),
        F.max(size).alias("max_volume"),
        F.min(size).alias("min_volume"),
        F.avg(size).alias("avg_volume"),
    )


def distinct_counts(silver: DataFrame, approx_rsd: float | None = None) -> DataFrame:
    """One row: ``distinct_ip_count``, ``distinct_day_count``.

    Exact by default (every distinct client is shuffled once, after a
    map-side dedupe).  ``approx_rsd`` (e.g. ``0.01``) switches to HyperLogLog++
    sketches, which shuffle a fixed-size sketch per task instead.
    """
    day = event_day(F.col("timestamp"))
    if approx_rsd is not None:
        return silver.agg(
            F.approx_count_distinct("client_ip", approx_rsd).alias("distinct_ip_count"),
            F.approx_count_distinct(day, approx_rsd).alias("distinct_day_count"),
        )
    return silver.agg(
        F.count_distinct("client_ip").alias("distinct_ip_count"),
        F.count_distinct(day).alias("distinct_day_count"),
    )


def client_errors_by_weekday(silver: DataFrame) -> DataFrame:
    """``(day_of_week, client_error_count)`` over 4xx lines; null time → null weekday."""
    errors = silver.filter(is_client_error(F.col("status_code")))
    return errors.groupBy(weekday_name(F.col("timestamp")).alias("day_of_week")).agg(
        F.count(F.lit(1)).alias("client_error_count")
    )


def worst_error_weekday(silver: DataFrame) -> DataFrame:
    """The weekday with most client errors (0 or 1 row); ties by name."""
    by_day = client_errors_by_weekday(silver)
    return by_day.orderBy(F.col("client_error_count").desc(), F.col("day_of_week").asc_nulls_last()).limit(1)


def response_categories(silver: DataFrame) -> DataFrame:
    """Adds ``response_category`` (Informational … Server Error, Unknown)."""
    return silver.withColumn("response_category", response_category(F.col("status_code")))
