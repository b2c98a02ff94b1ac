"""The gold access report (one row) and the frames derived from it.

``access_report`` reads three column-disjoint slices of silver, so each
column is scanned once and each slice is shuffled once:

1. ``client_ip``       → hits per client → top 10 *and* distinct-client count
   (one plan over the same aggregate, so its shuffle is reused);
2. ``endpoint_clean``  → hits per page → top 6;
3. ``timestamp, status_code, response_size`` → one row per day → one row
   per weekday → distinct days, volume statistics, worst weekday.

The pieces are combined as uncorrelated scalar subqueries beside the
one-row result of (3) — no join, no cross product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.http import ROBOTS_PATH, STATIC_ASSET_RE, WEEKDAY_PATTERN
from tidelog.operators.metrics import (
    TOP_CLIENT_IPS,
    TOP_ENDPOINTS,
    daily_rollup,
    hits_by_client_ip,
    page_hits,
    top_k,
)

REPORT_COLUMNS = (
    "top_ips",
    "top_endpoints",
    "distinct_ip_count",
    "distinct_day_count",
    "day_with_most_client_errors",
    "total_volume",
    "max_volume",
    "min_volume",
    "avg_volume",
)


def _by_count_then_key(key: str):
    """array_sort comparator: access_count descending, then key ascending, nulls last."""

    def cmp(left: Column, right: Column) -> Column:
        lc, rc, lk, rk = left["access_count"], right["access_count"], left[key], right[key]
        return (
            F.when(lc > rc, F.lit(-1))
            .when(lc < rc, F.lit(1))
            .when(lk.isNull() & rk.isNull(), F.lit(0))
            .when(lk.isNull(), F.lit(1))
            .when(rk.isNull(), F.lit(-1))
            .when(lk < rk, F.lit(-1))
            .when(lk > rk, F.lit(1))
            .otherwise(F.lit(0))
        )

    return cmp


def ranked_list(top: DataFrame, key: str, field: str) -> DataFrame:
    """One row, one column: the top rows as ``array<struct<field, access_count>>``
    in rank order (``[]`` when there are none)."""
    items = F.collect_list(F.struct(F.col(key).alias(field), F.col("access_count")))
    return top.agg(F.array_sort(items, _by_count_then_key(field)).alias("items"))


def time_and_volume(silver: DataFrame) -> DataFrame:
    """One row: ``distinct_day_count``, ``day_with_most_client_errors`` and the
    four volume statistics, from a single scan of time, status and size.

    Lines → one row per day → one row per weekday → one row.  After the
    first (map-side combined) aggregation everything is tiny.  The worst
    weekday is the one with most client errors, ties by name, nulls last.
    """
    return totals_of_days(daily_rollup(silver))


def totals_of_days(daily: DataFrame) -> DataFrame:
    """``time_and_volume`` from the rows of ``daily_rollup``."""
    weekly = daily.groupBy(
        F.date_format(F.col("date"), WEEKDAY_PATTERN).alias("day_of_week")
    ).agg(
        F.sum("client_errors").alias("client_errors"),
        F.count("date").alias("days"),
        F.sum("size_sum").alias("size_sum"),
        F.max("size_max").alias("size_max"),
        F.min("size_min").alias("size_min"),
        F.sum("size_n").alias("size_n"),
    )
    dow = F.col("day_of_week")
    rank = F.when(F.col("client_errors") > 0, F.struct(-F.col("client_errors"), dow.isNull(), dow))
    return weekly.agg(
        F.coalesce(F.sum("days"), F.lit(0)).alias("distinct_day_count"),
        F.min_by(dow, rank).alias("day_with_most_client_errors"),
        F.sum("size_sum").alias("total_volume"),
        F.max("size_max").alias("max_volume"),
        F.min("size_min").alias("min_volume"),
        F.try_divide(F.sum("size_sum"), F.sum("size_n").cast("double")).alias("avg_volume"),
    )


def clients(silver: DataFrame, k: int = TOP_CLIENT_IPS) -> DataFrame:
    """One row: ``top_ips`` (ranked list) and ``distinct_ip_count``.

    Both come from the same per-client aggregate; they are combined by a
    union of two one-row results and a two-row aggregate, inside one plan,
    so Spark shuffles the per-client counts once (``ReusedExchange``).
    """
    return clients_of_hits(hits_by_client_ip(silver), k)


def clients_of_hits(per_ip: DataFrame, k: int = TOP_CLIENT_IPS) -> DataFrame:
    """``clients`` from the hits per client."""
    top = ranked_list(top_k(per_ip, "client_ip", k), "client_ip", "client_ip")
    # every group has access_count >= 1; reading it keeps the per-client
    # aggregate identical in both branches (otherwise pruning turns this one
    # into a bare DISTINCT and the shuffle can no longer be shared)
    count = per_ip.agg(F.count(F.when(F.col("access_count") > 0, F.col("client_ip"))).alias("n"))
    both = top.select(F.col("items"), F.lit(None).cast("bigint").alias("n")).unionByName(
        count.select(F.lit(None).cast(top.schema["items"].dataType).alias("items"), F.col("n"))
    )
    return both.agg(
        F.first("items", ignorenulls=True).alias("top_ips"),
        F.max("n").alias("distinct_ip_count"),
    )


def access_report(silver: DataFrame, top_ips: int = TOP_CLIENT_IPS, top_endpoints: int = TOP_ENDPOINTS) -> DataFrame:
    """The one-row gold report over a silver access log (schema in README)."""
    return report_of(hits_by_client_ip(silver), page_hits(silver), daily_rollup(silver), top_ips, top_endpoints)


def report_of(per_ip: DataFrame, per_page: DataFrame, daily: DataFrame, top_ips: int = TOP_CLIENT_IPS,
              top_endpoints: int = TOP_ENDPOINTS) -> DataFrame:
    """The report from hits per client, hits per page and the daily rollup."""
    who = clients_of_hits(per_ip, top_ips).select(F.struct("top_ips", "distinct_ip_count").alias("c"))
    pages = ranked_list(top_k(per_page, "endpoint", top_endpoints), "endpoint", "endpoint")
    totals = totals_of_days(daily)
    c = who.scalar()
    return totals.select(
        c["top_ips"].alias("top_ips"),
        pages.scalar().alias("top_endpoints"),
        c["distinct_ip_count"].alias("distinct_ip_count"),
        F.col("distinct_day_count"),
        F.col("day_with_most_client_errors"),
        F.col("total_volume"),
        F.col("max_volume"),
        F.col("min_volume"),
        F.col("avg_volume"),
    )


def report_frames(gold: DataFrame) -> dict[str, DataFrame]:
    """The data behind the report charts: exploded top clients, exploded top
    pages and the scalar KPIs of the first report row."""
    ips = gold.select(F.explode("top_ips").alias("item")).select(
        F.col("item.client_ip").alias("client_ip"), F.col("item.access_count").alias("access_count")
    )
    pages = gold.select(F.explode("top_endpoints").alias("item")).select(
        F.col("item.endpoint").alias("endpoint"), F.col("item.access_count").alias("access_count")
    )
    kpis = gold.select(*REPORT_COLUMNS[2:]).limit(1)
    return {"top_ips": ips, "top_endpoints": pages, "kpis": kpis}


# The same report as SQL text (for pipelines whose gold step is a SQL
# parameter), in the same shape as ``access_report``: three column groups,
# each scanned and shuffled once, combined by scalar subqueries.
# ``{table}`` is the silver table.
ACCESS_REPORT_SQL = """
WITH per_client AS (
    SELECT client_ip, COUNT(*) AS access_count FROM {table} GROUP BY client_ip
),
client_summary AS (
    SELECT first(items, true) AS top_ips, max(n) AS distinct_ip_count
    FROM (
        SELECT array_sort(collect_list(named_struct('client_ip', client_ip, 'access_count', access_count)),
                          (l, r) -> CASE WHEN l.access_count <> r.access_count
                                         THEN IF(l.access_count > r.access_count, -1, 1)
                                         WHEN l.client_ip IS NULL OR r.client_ip IS NULL
                                         THEN IF(l.client_ip IS NULL, IF(r.client_ip IS NULL, 0, 1), -1)
                                         WHEN l.client_ip = r.client_ip THEN 0
                                         ELSE IF(l.client_ip < r.client_ip, -1, 1) END) AS items,
               CAST(NULL AS BIGINT) AS n
        FROM (SELECT client_ip, access_count FROM per_client
              ORDER BY access_count DESC, client_ip ASC NULLS LAST LIMIT {top_ips}) ranked
        UNION ALL
        SELECT NULL, COUNT(IF(access_count > 0, client_ip, NULL)) FROM per_client
    ) parts
),
page_summary AS (
    SELECT array_sort(collect_list(named_struct('endpoint', endpoint, 'access_count', access_count)),
                      (l, r) -> CASE WHEN l.access_count <> r.access_count
                                     THEN IF(l.access_count > r.access_count, -1, 1)
                                     WHEN l.endpoint IS NULL OR r.endpoint IS NULL
                                     THEN IF(l.endpoint IS NULL, IF(r.endpoint IS NULL, 0, 1), -1)
                                     WHEN l.endpoint = r.endpoint THEN 0
                                     ELSE IF(l.endpoint < r.endpoint, -1, 1) END) AS items
    FROM (SELECT endpoint_clean AS endpoint, COUNT(*) AS access_count
          FROM {table}
          WHERE NOT lower(endpoint_clean) RLIKE '{static_re}' AND endpoint_clean <> '{robots}'
          GROUP BY endpoint_clean
          ORDER BY access_count DESC, endpoint ASC NULLS LAST LIMIT {top_endpoints}) ranked
),
per_day AS (
    SELECT to_date(timestamp) AS day,
           count_if(coalesce(status_code BETWEEN 400 AND 499, false)) AS client_errors,
           sum(try_cast(response_size AS DOUBLE)) AS size_sum,
           max(try_cast(response_size AS DOUBLE)) AS size_max,
           min(try_cast(response_size AS DOUBLE)) AS size_min,
           count(try_cast(response_size AS DOUBLE)) AS size_n
    FROM {table} GROUP BY to_date(timestamp)
),
per_weekday AS (
    SELECT date_format(day, 'EEEE') AS day_of_week, sum(client_errors) AS client_errors, count(day) AS days,
           sum(size_sum) AS size_sum, max(size_max) AS size_max, min(size_min) AS size_min, sum(size_n) AS size_n
    FROM per_day GROUP BY date_format(day, 'EEEE')
)
SELECT
    (SELECT top_ips FROM client_summary) AS top_ips,
    (SELECT items FROM page_summary) AS top_endpoints,
    (SELECT distinct_ip_count FROM client_summary) AS distinct_ip_count,
    coalesce(sum(days), 0) AS distinct_day_count,
    min_by(day_of_week, IF(client_errors > 0,
                           named_struct('e', -client_errors, 'n', day_of_week IS NULL, 'd', day_of_week),
                           NULL)) AS day_with_most_client_errors,
    sum(size_sum) AS total_volume,
    max(size_max) AS max_volume,
    min(size_min) AS min_volume,
    try_divide(sum(size_sum), CAST(sum(size_n) AS DOUBLE)) AS avg_volume
FROM per_weekday
"""


def access_report_sql(table: str, top_ips: int = TOP_CLIENT_IPS, top_endpoints: int = TOP_ENDPOINTS) -> str:
    """SQL text of the report over catalog table ``table`` (for ``PipelineSpec.sql_gold``)."""
    return ACCESS_REPORT_SQL.format(table=table, top_ips=top_ips, top_endpoints=top_endpoints,
                                    static_re=STATIC_ASSET_RE.replace("\\", "\\\\"), robots=ROBOTS_PATH)
