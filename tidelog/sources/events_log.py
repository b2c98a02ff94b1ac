"""Access-log lines derived from the ``events`` table.

The test tables carry no web-server log, so one line is derived per event by a
single narrow projection (no shuffle).  Lines vary by ``event_id``: methods,
protocols, zone offsets, statuses of every class and outside of them, asset
types, query strings, ``/robots.txt``, the combined format with referrer and
agent, and ``"-"`` requests.  The derivation is one SQL text; only the format of
times differs between Spark and DuckDB, so both engines see identical lines.

``noisy=True`` adds lines that a strict check refuses: cut off behind the
request, with a one-digit day, or empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METHODS = ("GET", "POST", "HEAD", "PUT", "DELETE", "OPTIONS")
PROTOCOLS = ("HTTP/1.1", "HTTP/1.0", "HTTP/2.0")
OFFSETS = ("+0000", "-0700", "+0530", "+0100", "-0330")
STATUSES = ("200", "301", "404", "500", "100", "204", "304", "400", "403", "499", "503", "599", "600", "099")
ASSETS = ("css", "js", "png", "jpg", "jpeg", "gif", "txt", "ico", "svg", "woff", "ttf", "mp4", "avi", "mov", "mpeg",
          "mpg", "webm", "mkv", "bmp", "CSS", "css?v=2", "js#top", "html", "cssx")


def _pick(values: tuple[str, ...], number: str) -> str:
    """SQL: the value at a number (modulo their count)."""
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE ({number}) % {len(values)} {cases} END)"


def line_sql(time: str, one_digit_day: str, noisy: bool) -> str:
    """The line of an event as SQL that both engines read; ``time`` and
    ``one_digit_day`` write ``ts`` (without its offset)."""
    asset = f"concat('/x.', {_pick(ASSETS, 'floor(event_id / 7)')})"
    path = (f"CASE WHEN event_id % 31 = 0 THEN '/robots.txt' WHEN event_id % 17 = 0 THEN '/' "
            f"WHEN event_id % 7 = 0 THEN {asset} WHEN event_id % 5 = 0 THEN concat('/', event_type, '/?k=1') "
            f"WHEN event_id % 13 = 1 THEN concat('/', event_type, '/', event_id % 50, '/') "
            f"ELSE concat('/', event_type) END")
    request = (f"CASE WHEN event_id % 41 = 0 THEN '-' ELSE concat({_pick(METHODS, 'floor(event_id / 3)')}, ' ', {path}, "
               f"' ', {_pick(PROTOCOLS, 'floor(event_id / 2)')}) END")
    status = (f"CASE WHEN event_type = 'error' THEN {_pick(STATUSES, 'floor(event_id / 4)')} "
              "WHEN event_id % 11 = 0 THEN '301' ELSE '200' END")
    size = "CASE WHEN event_id % 13 = 0 THEN '-' ELSE concat('', CAST(floor(value) AS BIGINT)) END"
    agent = "CASE WHEN event_id % 9 = 4 THEN ' \"http://ref.example/a\" \"Agent/1.0 (x)\"' ELSE '' END"
    when = f"CASE WHEN event_id % 19 = 3 THEN {one_digit_day} ELSE {time} END" if noisy else time
    head = (f"concat('10.', user_id % 4, '.', user_id % 256, '.', event_id % 250 + 1, ' - - [', {when}, ' ', "
            f"{_pick(OFFSETS, 'floor(event_id / 6)')}, '] \"', {request}, '\"')")
    full = f"concat({head}, ' ', {status}, ' ', {size}, {agent})"
    if noisy:
        return (f"CASE WHEN event_id % 101 = 0 THEN '' WHEN event_type = 'error' AND event_id % 3 = 0 THEN {head} "
                f"ELSE {full} END")
    return full


def access_lines(events: DataFrame, noisy: bool = False) -> DataFrame:
    """``DataFrame[value: string]``, one log line per event."""
    return events.select(F.expr(line_sql("date_format(ts, 'dd/MMM/yyyy:HH:mm:ss')",
                                         "date_format(ts, 'd/MMM/yyyy:HH:mm:ss')", noisy)).alias("value"))


def event_lines_duckdb(noisy: bool = False) -> str:
    """The same derivation as DuckDB SQL over the ``events`` view (column ``value``)."""
    return "SELECT " + line_sql("strftime(ts, '%d/%b/%Y:%H:%M:%S')", "strftime(ts, '%-d/%b/%Y:%H:%M:%S')",
                                noisy) + " AS value FROM events"


# --- execution-log rows derived from events (for the monitoring views) ------
_STEP_ARRAY = "array('landing', 'bronze', 'silver', 'gold')"


def execution_rows(events: DataFrame) -> DataFrame:
    """Execution-log rows (audit schema), one per event: pipeline from the
    user, step from the event id, NOTOK for error events, duration in
    quarter seconds from ``value`` (exactly summable)."""
    step = F.element_at(F.expr(_STEP_ARRAY), (F.col("event_id") % 4 + 1).cast("int"))
    is_error = F.col("event_type") == "error"
    return events.select(
        F.col("ts").cast("timestamp").alias("execution_time"),
        F.concat(F.lit("pipeline_"), (F.col("user_id") % 3).cast("string")).alias("pipeline_name"),
        step.alias("step"),
        F.when(is_error, F.lit("NOTOK")).otherwise(F.lit("OK")).alias("status"),
        F.when(is_error, F.concat(F.lit("failure in event "), F.col("event_id").cast("string")))
        .otherwise(F.lit(""))
        .alias("error_message"),
        F.concat(F.lit("/lake/"), step).alias("processed_file_path"),
        (F.floor(F.col("value") * 4) / 4).cast("double").alias("time_elapsed"),
    )


def execution_rows_duckdb() -> str:
    step = "(['landing', 'bronze', 'silver', 'gold'])[event_id % 4 + 1]"
    return (
        "SELECT ts AS execution_time, concat('pipeline_', user_id % 3) AS pipeline_name, "
        f"{step} AS step, CASE WHEN event_type = 'error' THEN 'NOTOK' ELSE 'OK' END AS status, "
        "CASE WHEN event_type = 'error' THEN concat('failure in event ', event_id) ELSE '' END AS error_message, "
        f"concat('/lake/', {step}) AS processed_file_path, "
        "CAST(floor(value * 4) / 4 AS DOUBLE) AS time_elapsed FROM events"
    )
