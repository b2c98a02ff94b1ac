"""DuckDB SQL that computes what each registered check in ``tidelog.workloads``
should return, over the same parquet tables (views ``events``, ``pages``,
``orders`` …).  Written independently of the Spark code: regexes through
``regexp_extract``, times through ``try_strptime``, ranking through
``ORDER BY … LIMIT``.
"""

from __future__ import annotations

from tidelog.sources.events_log import event_lines_duckdb, execution_rows_duckdb

RUN_TS_SQL = "TIMESTAMP '2024-02-01 12:30:00'"
RUN_DATE_SQL = "DATE '2024-02-01'"

# fixed values: asset extensions (and the status classes and ranges below)
STATIC_ASSET_SQL = (
    r"'\.(css|js|png|jpg|jpeg|gif|txt|ico|svg|woff|ttf|mp4|avi|mov|mpeg|mpg|webm|mkv|bmp)(\?|#|$)'"
)


def _clean(e: str) -> str:
    return f"CASE WHEN {e} = '/' THEN '/' ELSE regexp_replace(split_part({e}, '?', 1), '/$', '') END"


def _parsed(noisy: bool = True) -> str:
    return rf"""
    SELECT
      regexp_extract(value, '^(\S+)', 1) AS client_ip,
      CASE WHEN regexp_matches(value, '\[\d\d/') THEN
        try_strptime(regexp_extract(value, '\[(.*?)\]', 1), '%d/%b/%Y:%H:%M:%S %z') AT TIME ZONE 'UTC' END AS timestamp,
      regexp_extract(value, '"(\S+)', 1) AS method,
      regexp_extract(value, '"(?:\S+)\s(\S+)', 1) AS endpoint,
      {_clean(r"regexp_extract(value, '" + '"' + r"(?:\S+)\s(\S+)', 1)")} AS endpoint_clean,
      regexp_extract(value, '"(?:\S+)\s(?:\S+)\s(\S+)', 1) AS protocol,
      TRY_CAST(NULLIF(regexp_extract(value, '\s(\d{{3}})\s', 1), '') AS INTEGER) AS status_code,
      TRY_CAST(regexp_extract(value, '\s(\d+)$', 1) AS BIGINT) AS response_size
    FROM ({event_lines_duckdb(noisy)}) lines
    """


def _with(noisy: bool = True) -> str:
    return f"WITH silver AS ({_parsed(noisy)})\n"


TOP_IPS = """SELECT client_ip, COUNT(*) AS access_count FROM silver GROUP BY client_ip
             ORDER BY access_count DESC, client_ip ASC NULLS LAST LIMIT 10"""
TOP_PAGES = f"""SELECT endpoint_clean AS endpoint, COUNT(*) AS access_count FROM silver
             WHERE NOT regexp_matches(lower(endpoint_clean), {STATIC_ASSET_SQL})
               AND endpoint_clean != '/robots.txt'
             GROUP BY endpoint_clean ORDER BY access_count DESC, endpoint ASC NULLS LAST LIMIT 6"""
VOLUME = """SELECT SUM(CAST(response_size AS DOUBLE)) AS total_volume, MAX(CAST(response_size AS DOUBLE)) AS max_volume,
             MIN(CAST(response_size AS DOUBLE)) AS min_volume, AVG(CAST(response_size AS DOUBLE)) AS avg_volume FROM silver"""
DISTINCT = """SELECT COUNT(DISTINCT client_ip) AS distinct_ip_count,
             COUNT(DISTINCT CAST(timestamp AS DATE)) AS distinct_day_count FROM silver"""
BY_WEEKDAY = """SELECT dayname(timestamp) AS day_of_week, COUNT(*) AS client_error_count FROM silver
             WHERE status_code BETWEEN 400 AND 499 GROUP BY dayname(timestamp)"""
WORST_WEEKDAY = f"""SELECT * FROM ({BY_WEEKDAY}) w
             ORDER BY client_error_count DESC, day_of_week ASC NULLS LAST LIMIT 1"""
REPORT_SCALARS = f"""SELECT COUNT(DISTINCT client_ip) AS distinct_ip_count,
             COUNT(DISTINCT CAST(timestamp AS DATE)) AS distinct_day_count,
             (SELECT day_of_week FROM ({WORST_WEEKDAY}) x) AS day_with_most_client_errors,
             SUM(CAST(response_size AS DOUBLE)) AS total_volume, MAX(CAST(response_size AS DOUBLE)) AS max_volume,
             MIN(CAST(response_size AS DOUBLE)) AS min_volume, AVG(CAST(response_size AS DOUBLE)) AS avg_volume
             FROM silver"""


def _quality(noisy: bool) -> str:
    def rule(name: str, col: str) -> str:
        return (f"SELECT CASE WHEN total > 0 AND valid_{col} = total THEN 'OK' ELSE 'FAIL' END AS status, "
                f"'{name}' AS rule, CASE WHEN total > 0 THEN round((valid_{col} / total) * 100, 2) ELSE 0.0 END "
                f"AS percentage_ok FROM c")

    rules = [("not_null_client_ip", "client_ip"), ("not_null_endpoint", "endpoint"),
             ("not_null_status_code", "status_code"), ("not_null_timestamp", "timestamp")]
    unions = " UNION ALL ".join(rule(n, c) for n, c in rules)
    return f"""{_with(noisy)}, c AS (SELECT COUNT(*) AS total, COUNT(client_ip) AS valid_client_ip,
        COUNT(endpoint) AS valid_endpoint, COUNT(status_code) AS valid_status_code,
        COUNT(timestamp) AS valid_timestamp FROM silver),
      r AS ({unions} UNION ALL SELECT CASE WHEN total > 0 THEN 'OK' ELSE 'FAIL' END, 'not_zero_count',
        CASE WHEN total > 0 THEN 100.0 ELSE 0.0 END FROM c)
      SELECT 'access_log' AS pipeline_name, 'bronze_to_silver' AS step, {RUN_TS_SQL} AS timestamp,
        status, rule, CAST(percentage_ok AS DOUBLE) AS percentage_ok, 'silver.s_access_logs' AS verified_table FROM r"""


LISTS = f"""SELECT 'top_ips' AS list, row_number() OVER (ORDER BY access_count DESC, client_ip ASC NULLS LAST) - 1 AS rank,
            client_ip AS entry, access_count FROM ({TOP_IPS}) i
        UNION ALL SELECT 'top_endpoints',
            row_number() OVER (ORDER BY access_count DESC, endpoint ASC NULLS LAST) - 1, endpoint, access_count
        FROM ({TOP_PAGES}) p"""
DAYS = """d AS (SELECT client_ip, CAST(timestamp AS DATE) AS day FROM silver),
        b AS (SELECT min(day) AS low, min(day) + CAST((max(day) - min(day)) // 2 AS INTEGER) AS middle FROM d)"""


def _range(name: str, condition: str) -> str:
    return (f"SELECT '{name}' AS days, COUNT(DISTINCT client_ip) AS distinct_ip_count, COUNT(DISTINCT day) "
            f"AS distinct_day_count FROM d, b WHERE {condition}")


LINES = event_lines_duckdb(noisy=True)
AUDIT = execution_rows_duckdb()

ORACLES: dict[str, str] = {
    "landing_text_scan": LINES,
    "landing_csv_scan": f"SELECT value AS _c0 FROM ({LINES}) l WHERE value <> ''",
    "ragged_csv": """WITH e AS (SELECT CAST(event_id AS VARCHAR) AS id, COALESCE(CAST(user_id AS VARCHAR), 'x') AS u,
            COALESCE(event_type, 'x') AS t FROM events)
        SELECT id AS _c0, u AS _c1, NULL AS _c2, NULL AS _c3, id || ',' || u AS _misfit FROM e
        UNION ALL SELECT id, u, t, t || ',' || u, NULL FROM e""",
    "unseen_files": LINES,
    "parse_access_log": f"{_with()} SELECT * FROM silver",
    "control_columns": f"SELECT value, {RUN_TS_SQL} AS processed_timestamp, {RUN_DATE_SQL} AS processed_date "
                       f"FROM ({LINES}) l",
    "endpoint_clean": f"{_with()} SELECT endpoint, endpoint_clean FROM silver "
                      f"UNION ALL SELECT url AS endpoint, {_clean('url')} AS endpoint_clean FROM pages",
    "response_category": f"""{_with()} SELECT status_code, CASE
        WHEN status_code BETWEEN 100 AND 199 THEN 'Informational'
        WHEN status_code BETWEEN 200 AND 299 THEN 'Success'
        WHEN status_code BETWEEN 300 AND 399 THEN 'Redirection'
        WHEN status_code BETWEEN 400 AND 499 THEN 'Client Error'
        WHEN status_code BETWEEN 500 AND 599 THEN 'Server Error'
        ELSE 'Unknown' END AS response_category FROM silver""",
    "top_client_ips": f"{_with()} {TOP_IPS}",
    "top_endpoints": f"{_with()} {TOP_PAGES}",
    "volume_stats": f"{_with()} {VOLUME}",
    "distinct_counts": f"{_with()} {DISTINCT}",
    "client_errors_by_weekday": f"{_with()} {BY_WEEKDAY}",
    "worst_error_weekday": f"{_with()} {WORST_WEEKDAY}",
    "daily_rollup": f"""{_with()} SELECT CAST(timestamp AS DATE) AS date,
        COUNT(*) FILTER (WHERE status_code BETWEEN 400 AND 499) AS client_errors,
        SUM(CAST(response_size AS DOUBLE)) AS size_sum, MAX(CAST(response_size AS DOUBLE)) AS size_max,
        MIN(CAST(response_size AS DOUBLE)) AS size_min, COUNT(response_size) AS size_n
        FROM silver GROUP BY CAST(timestamp AS DATE)""",
    "report_scalars": f"{_with()} {REPORT_SCALARS}",
    "report_top_ips": f"{_with()} {TOP_IPS}",
    "report_top_endpoints": f"{_with()} {TOP_PAGES}",
    "report_sql_scalars": f"{_with()} {REPORT_SCALARS}",
    "quality_rows": _quality(noisy=False),
    "quality_rows_noisy": _quality(noisy=True),
    "quality_rows_table": f"""SELECT 'orders' AS pipeline_name, 'bronze_to_silver' AS step, {RUN_TS_SQL} AS timestamp,
        CASE WHEN COUNT(*) > 0 THEN 'OK' ELSE 'FAIL' END AS status, 'not_zero_count' AS rule,
        CASE WHEN COUNT(*) > 0 THEN 100.0 ELSE 0.0 END::DOUBLE AS percentage_ok,
        'silver.s_orders' AS verified_table FROM orders""",
    "sql_silver": f"""SELECT o_orderstatus, o_orderpriority, count(*) AS order_count,
        min(o_totalprice) AS min_price, max(o_totalprice) AS max_price,
        round(sum(o_totalprice), 2) AS total_price,
        {RUN_TS_SQL} AS processed_timestamp, {RUN_DATE_SQL} AS processed_date
        FROM orders GROUP BY o_orderstatus, o_orderpriority""",
    "layer_roundtrip": f"SELECT value, {RUN_DATE_SQL} AS processed_date FROM ({LINES}) l",
    "pipeline_gold": f"{_with(noisy=False)} {REPORT_SCALARS}",
    "pipeline_sql_gold": f"{_with(noisy=False)} {LISTS}",
    "top_clients_sketched": f"{_with()} {TOP_IPS}",
    "top_pages_sketched": f"{_with()} {TOP_PAGES}",
    "incremental_scalars": f"{_with()} {REPORT_SCALARS}",
    "incremental_lists": f"{_with()} {LISTS}",
    "incremental_gold": f"{_with(noisy=False)} {REPORT_SCALARS}",
    "range_distincts": f"{_with()}, {DAYS} " + " UNION ALL ".join([
        _range("all", "true"), _range("first_half", "day <= middle"), _range("from_middle", "day >= middle"),
        _range("week", "day BETWEEN middle AND middle + 6")]),
    "rolling_clients": f"""{_with()}, {DAYS} SELECT e.day AS date, COUNT(DISTINCT client_ip) AS distinct_ip_count
        FROM (SELECT DISTINCT day FROM d WHERE day IS NOT NULL) e JOIN d ON d.day BETWEEN e.day - 6 AND e.day
        GROUP BY e.day""",
    "pipeline_kpis": f"{_with(noisy=False)} {REPORT_SCALARS}",
    "pipeline_csv_log": f"{_with(noisy=False)} SELECT * FROM silver",
    "pipeline_audit": f"""SELECT step, status, CASE WHEN step IN ('landing', 'bronze') THEN 2 ELSE 1 END AS runs,
        true AS timed, status = 'NOTOK' AS told, {RUN_TS_SQL} AS execution_time
        FROM (VALUES ('landing', 'OK'), ('bronze', 'OK'), ('silver', 'OK'), ('gold', 'OK'), ('silver', 'NOTOK'))
            v(step, status) WHERE EXISTS (SELECT 1 FROM events)""",
    "pipeline_refused": f"""SELECT rule, status, percentage_ok FROM ({_quality(noisy=True)}) q
        UNION ALL SELECT 'silver_rows', '', count(*)::DOUBLE FROM ({event_lines_duckdb(False)}) l""",
    "layer_fallback": f"SELECT value, {RUN_DATE_SQL} AS processed_date FROM ({LINES}) l",
    "audit_appends": f"""SELECT max(execution_time) AS execution_time, pipeline_name, step, 'OK' AS status,
        'it''s ok; --' AS error_message, '/lake/x' AS processed_file_path, count(*)::DOUBLE AS time_elapsed
        FROM ({AUDIT}) a GROUP BY pipeline_name, step""",
    "run_durations_ranked": f"""SELECT step, time_elapsed,
        row_number() OVER (ORDER BY time_elapsed DESC) - 1 AS rank
        FROM (SELECT step, AVG(time_elapsed) AS time_elapsed FROM ({AUDIT}) a GROUP BY step) d""",
    "stream_ingest": LINES,
    "stream_silver": f"{_with(noisy=False)} SELECT * FROM silver",
    "run_durations": f"SELECT step, AVG(time_elapsed) AS time_elapsed FROM ({AUDIT}) a GROUP BY step",
    "run_status": f"SELECT pipeline_name, status, COUNT(*) AS runs FROM ({AUDIT}) a GROUP BY pipeline_name, status",
    "latest_runs": f"SELECT *, row_number() OVER (ORDER BY execution_time DESC, pipeline_name, step, status, "
                   f"error_message, processed_file_path, time_elapsed) - 1 AS rank FROM ({AUDIT}) a WHERE pipeline_name LIKE 'pipeline_1' AND step = 'gold'",
    "compact_runs": f"SELECT * FROM ({AUDIT}) a",
    "purge_runs": f"SELECT * FROM ({AUDIT}) a WHERE NOT coalesce(pipeline_name = 'pipeline_0', false)",
}
