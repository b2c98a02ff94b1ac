"""HTTP-level column expressions used by the report: status classes,
static-asset detection, event day and weekday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (status classes, asset extensions, excluded path) --------
STATUS_CLASSES = (
    (100, 199, "Informational"),
    (200, 299, "Success"),
    (300, 399, "Redirection"),
    (400, 499, "Client Error"),
    (500, 599, "Server Error"),
)
UNKNOWN_CATEGORY = "Unknown"
STATIC_ASSET_RE = (
    r"\.(css|js|png|jpg|jpeg|gif|txt|ico|svg|woff|ttf|mp4|avi|mov|mpeg|mpg|webm|mkv|bmp)(\?|#|$)"
)
ROBOTS_PATH = "/robots.txt"
CLIENT_ERROR_RANGE = (400, 499)
WEEKDAY_PATTERN = "EEEE"
# ---------------------------------------------------------------------------


def response_category(status_code: Column) -> Column:
    """Status class name; null or out-of-range codes are ``Unknown``."""
    expr = None
    for low, high, name in STATUS_CLASSES:
        cond = status_code.between(low, high)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(UNKNOWN_CATEGORY))


def is_client_error(status_code: Column) -> Column:
    low, high = CLIENT_ERROR_RANGE
    return status_code.between(low, high)


def is_page(endpoint_clean: Column) -> Column:
    """True for endpoints that count as pages (not static assets, not robots.txt).

    Null endpoints give null, so a filter drops them, as SQL ``NOT … RLIKE`` does.
    """
    return ~F.lower(endpoint_clean).rlike(STATIC_ASSET_RE) & (endpoint_clean != F.lit(ROBOTS_PATH))


def event_day(ts: Column) -> Column:
    """Calendar day of an instant in the session time zone."""
    return F.to_date(ts)


def weekday_name(ts: Column) -> Column:
    """English weekday name (``Monday`` …) in the session time zone."""
    return F.date_format(ts, WEEKDAY_PATTERN)
