"""Property test: the Spark parse equals a plain-Python reading of the same
field rules on random log-like ASCII lines (one Spark job per example batch)."""

import re

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.functions import logparse as L

TOKENS = st.sampled_from([
    "10.0.0.1", "::1", "-", " ", "  ", "\t", "[", "]", "\"", "GET", "POST", "/", "/a", "/a/", "/a/b/?x=1",
    "?", "?q", "//", "HTTP/1.1", "200", "404", "5000", "12", "0", "99999999999999999999",
    "10/Oct/2023:13:55:36 -0700", "x.css", "#", "é", "abc",
])
LINES = st.lists(TOKENS, min_size=0, max_size=14).map("".join)


def extract(pattern, line):
    m = re.search(pattern, line, flags=re.ASCII)
    return m.group(1) if m else ""


def to_int(text, bits):
    if not text:
        return None
    v = int(text)
    return v if -(2 ** (bits - 1)) <= v < 2 ** (bits - 1) else None


def expected(line):
    endpoint = extract(L.ENDPOINT_RE, line)
    if endpoint == "/":
        clean = "/"
    else:
        clean = re.sub(r"/$", "", endpoint.split("?", 1)[0], count=1)
    return (
        extract(L.CLIENT_IP_RE, line),
        extract(L.METHOD_RE, line),
        endpoint,
        clean,
        extract(L.PROTOCOL_RE, line),
        to_int(extract(L.STATUS_CODE_RE, line), 32),
        to_int(extract(L.RESPONSE_SIZE_RE, line), 64),
    )


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(LINES, min_size=20, max_size=80))
def test_parse_matches_python_reading(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [
        (r.client_ip, r.method, r.endpoint, r.endpoint_clean, r.protocol, r.status_code, r.response_size)
        for r in L.parse_access_log(df).collect()
    ]
    assert got == [expected(x) for x in lines]


GOOD = ['10.0.0.1', ' ', '-', ' ', 'frank', ' ', '[', '29', '/', 'Feb', '/', '2024', ':', '13', ':', '55', ':', '36', ' ', '-',
        '0730', ']', ' ', '"', 'GET', ' ', '/a/?x=1', ' ', 'HTTP/1.1', '"', ' ', '404', ' ', '123']
PARTS = st.sampled_from([
    "", " ", "  ", "-", "7", "200", "1234", "[", "]", '"', "/", "//", "?", "\t", "\r", "\u2028", "é", "30", "31", "1", "00", "24",
    "60", "Mar", "oct", "2023", "0999", "3000", "+0530", "-1459", "+1500", "OPTIONS", "/é", "/b c", ' "-" "Agent/1.0 (x)"',
    ' "ref" "a [b] 404 "', "99999999999999999999", "HTTP/1.1", "x y"])
EDITS = st.lists(st.tuples(st.integers(0, len(GOOD)), st.booleans(), PARTS), max_size=3)


def edited(edits):
    parts = list(GOOD)
    for at, replace, part in sorted(edits, reverse=True):
        parts[at : at + replace] = [part]
    return "".join(parts)


def by_patterns(df):
    """Every field by its own pattern alone."""
    def found(pattern):
        return F.regexp_extract("value", pattern, 1)

    endpoint = found(L.ENDPOINT_RE)
    clean = F.when(endpoint == "/", "/").otherwise(F.regexp_replace(F.substring_index(endpoint, "?", 1), "/$", ""))
    return df.select(
        found(L.CLIENT_IP_RE), L.parse_log_time(found(L.TIMESTAMP_RE)), found(L.METHOD_RE),
        endpoint, clean, found(L.PROTOCOL_RE), found(L.STATUS_CODE_RE).try_cast("int"),
        found(L.RESPONSE_SIZE_RE).try_cast("bigint"))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
          phases=[Phase.explicit, Phase.generate])
@given(st.lists(EDITS.map(edited), min_size=150, max_size=300))
def test_well_formed_lines_are_cut_as_the_patterns_find(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(2)
    got, want = L.parse_access_log(df).collect(), by_patterns(df).collect()
    assert list(map(tuple, got)) == list(map(tuple, want))


def test_each_pattern_stands_in_the_plan_once(spark):
    df = spark.createDataFrame([("".join(GOOD),), ("",), (None,), ('1 - - [30/Feb/2024:13:55:36 +0000] "GET / H" 200 1',)],
                               "value string")
    parsed = L.parse_access_log(df)
    assert df.filter(F.col("value").rlike(L.WELL_FORMED)).count() == 2
    assert [r.timestamp is None for r in parsed.collect()] == [False, True, True, True]
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 7 and plan.count("split(") == 1 and plan.count(L.WELL_FORMED) == 1
