"""Column expressions that turn one access-log line into typed fields.

Every field is defined by a pattern of its own on the raw line, so each one
matches (or fails) independently of the others.  A *well-formed* line
(``WELL_FORMED``, one test of the whole line) is cut at its blanks once, and the
pieces are what the patterns would find; only other lines take the patterns, one
after the other.  Numbers and times are converted only where they can succeed: a
conversion that fails costs far more than a line.  All expressions are built-in
Catalyst functions, so the whole parse stays inside whole-stage codegen and is a
narrow (shuffle-free) projection that scales with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (must match the original pipeline's parse exactly) -------
CLIENT_IP_RE = r"^(\S+)"
TIMESTAMP_RE = r"\[(.*?)\]"
METHOD_RE = r"\"(\S+)"
ENDPOINT_RE = r"\"(?:\S+)\s(\S+)"
PROTOCOL_RE = r"\"(?:\S+)\s(?:\S+)\s(\S+)"
STATUS_CODE_RE = r"\s(\d{3})\s"
RESPONSE_SIZE_RE = r"\s(\d+)$"
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
# ---------------------------------------------------------------------------

# A line on which every pattern above finds what its blanks delimit: no bracket or
# quote before the time (first "[" and first quote), no name that could be a status,
# a day and a time of day that exist or at least have the ISO form of a date, a
# request of method, path and protocol, and a size only at the end of the line.
_NAME = r"[^\s\[\]\"]++"
_LOG_TIME = (r"(?:0[1-9]|[12]\d|3[01])/(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)/[12]\d{3}"
             r":(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d [+-](?:0\d|1[0-4])[0-5]\d")
_QUOTED = r"\"[^\"\r\n]*+\""
WELL_FORMED = (rf"\A{_NAME} (?!\d){_NAME} (?!\d){_NAME} \[{_LOG_TIME}\] \"{_NAME} /[^\s\"]*+ [^\s\"]++\" "
               rf"\d{{3}} (?:-|\d++)(?: {_QUOTED} {_QUOTED})?\z")
# pieces between blanks: client, two names, "[" and time, zone and "]", quote and method,
# path, protocol and quote, status, size, and the rest of a combined line
PIECES = 11
_MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
_LINE_ENDS = ("\n", "\r", "\u0085", "\u2028", "\u2029")

SILVER_LOG_COLUMNS = (
    "client_ip",
    "timestamp",
    "method",
    "endpoint",
    "endpoint_clean",
    "protocol",
    "status_code",
    "response_size",
)


def _extract(line: Column, pattern: str) -> Column:
    return F.regexp_extract(line, pattern, 1)


def clean_endpoint(endpoint: Column) -> Column:
    """Endpoint without query string and without one trailing ``/``.

    ``/`` itself stays ``/``; ``/?a=1`` becomes ``''``; ``/z//`` becomes
    ``/z/``.  ``substring_index`` takes the text before the first ``?``
    without allocating the array a regex ``split`` would.
    """
    path = F.substring_index(endpoint, "?", 1)
    # the pattern /$ also finds a slash before a line end that closes the text
    broken = F.lit(False)
    for end in _LINE_ENDS:
        broken = broken | path.endswith(end)
    return (
        F.when(endpoint == F.lit("/"), F.lit("/"))
        .when(path.endswith("/"), F.substring(path, F.lit(1), F.length(path) - 1))
        .when(broken, F.regexp_replace(path, "/$", ""))
        .otherwise(path)
    )


def parse_log_time(text: Column) -> Column:
    """``10/Oct/2023:13:55:36 -0700`` → TIMESTAMP; anything else → null.

    ``try_to_timestamp`` keeps the null-on-bad-input behaviour the
    pipeline had under non-ANSI casts.  Texts that cannot have the format
    are not tried, and neither are years of six digits and more, which
    would overflow a TIMESTAMP and stop the job: they are null.
    """
    likely = text.rlike(r"\A\d\d/[A-Za-z]{3}/\+?\d{4,5}:")
    return F.when(likely, F.try_to_timestamp(text, F.lit(LOG_TIME_FORMAT)))


def _well_formed_time(day: Column, zone: Column) -> Column:
    """``[10/Oct/2023:13:55:36`` and ``-0700]`` → TIMESTAMP, by its ISO date and the
    seconds since; null where the month has no such day."""
    month = (F.call_function("instr", F.lit(_MONTHS), F.substring(day, 5, 3)) + 2) / 3
    date = F.concat_ws("-", F.substring(day, 9, 4), month.cast("int").cast("string"), F.substring(day, 2, 2))

    def number(text: Column, start: int) -> Column:
        return F.substring(text, start, 2).cast("int")

    offset = number(zone, 2) * 3600 + number(zone, 4) * 60
    clock = number(day, 14) * 3600 + number(day, 17) * 60 + number(day, 20)
    seconds = F.unix_date(date.try_cast("date")).cast("long") * 86400 + clock
    return F.timestamp_seconds(seconds - F.when(zone.startswith("-"), -offset).otherwise(offset))


def _number(text: Column, kind: str) -> Column:
    # '' (no match) → null without a failing conversion; too many digits → null
    return F.when(text != "", text.try_cast(kind))


def parse_access_log(df: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse the log line in ``column`` into the silver log schema.

    A line that does not match a pattern yields ``''`` for the string
    fields and null for ``timestamp``, ``status_code`` and
    ``response_size``; a null line yields nulls everywhere.  ``keep``
    names extra input columns carried through unchanged (e.g. control
    columns).

    What several fields need (the line's pieces, texts that are tested before
    they are converted) are columns of projections below, so each is computed
    once and each pattern stands in the plan once.
    """
    line, p = F.col("line_"), F.col("pieces_")

    def field(piece: Column, pattern: str) -> Column:
        return F.when(p.isNotNull(), piece).otherwise(_extract(line, pattern))

    kept = [F.col(c).alias(f"keep{i}_") for i, c in enumerate(keep)]
    cut = df.select(F.col(column).alias("line_"), *kept)
    cut = cut.withColumn("pieces_", F.when(line.rlike(WELL_FORMED), F.split(line, " ", PIECES)))
    ends_with_size = (F.size(p) < PIECES) & (p[9] != "-")
    texts = cut.withColumns({
        "endpoint_": field(p[6], ENDPOINT_RE),
        "time_": F.when(p.isNull(), _extract(line, TIMESTAMP_RE)),
        "status_": field(p[8], STATUS_CODE_RE),
        "size_": field(F.when(ends_with_size, p[9]).otherwise(""), RESPONSE_SIZE_RE),
    })
    return texts.select(
        field(p[0], CLIENT_IP_RE).alias("client_ip"),
        F.when(p.isNotNull(), _well_formed_time(p[3], p[4])).otherwise(parse_log_time(F.col("time_"))).alias("timestamp"),
        field(F.substring(p[5], F.lit(2), F.length(p[5])), METHOD_RE).alias("method"),
        F.col("endpoint_").alias("endpoint"),
        clean_endpoint(F.col("endpoint_")).alias("endpoint_clean"),
        field(p[7], PROTOCOL_RE).alias("protocol"),
        _number(F.col("status_"), "int").alias("status_code"),
        _number(F.col("size_"), "bigint").alias("response_size"),
        *[F.col(f"keep{i}_").alias(c) for i, c in enumerate(keep)],
    )
