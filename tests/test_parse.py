import datetime as dt

import pytest
from pyspark.sql import types as T

from tidelog.functions.logparse import SILVER_LOG_COLUMNS, parse_access_log

PREFIX = "10.1.2.3 - - [10/Oct/2023:13:55:36 -0700] "


def parse(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], T.StructType([T.StructField("value", T.StringType())]))
    return [r.asDict() for r in parse_access_log(df).collect()]


def test_common_log_line(spark):
    (row,) = parse(spark, ['192.168.1.1 - - [10/Oct/2023:13:55:36 -0700] "GET /home HTTP/1.1" 200 1234'])
    assert row == {
        "client_ip": "192.168.1.1",
        "timestamp": dt.datetime(2023, 10, 10, 20, 55, 36),
        "method": "GET",
        "endpoint": "/home",
        "endpoint_clean": "/home",
        "protocol": 'HTTP/1.1"',
        "status_code": 200,
        "response_size": 1234,
    }


def test_schema(spark):
    df = spark.createDataFrame([("x",)], "value string")
    out = parse_access_log(df)
    assert tuple(out.columns) == SILVER_LOG_COLUMNS
    types = {f.name: f.dataType for f in out.schema.fields}
    assert types["timestamp"] == T.TimestampType()
    assert types["status_code"] == T.IntegerType()
    assert types["response_size"] == T.LongType()


@pytest.mark.parametrize(
    "line, endpoint, clean, status, size",
    [
        (PREFIX + '"GET /?a=1 HTTP/1.1" 404 -', "/?a=1", "", 404, None),
        (PREFIX + '"GET /a/b/?x=1 HTTP/1.1" 500 7', "/a/b/?x=1", "/a/b", 500, 7),
        (PREFIX + '"GET /a HTTP/1.1" 200 55 "-" "UA 1.0"', "/a", "/a", 200, None),
        (PREFIX + '"-" 408 -', "408", "408", 408, None),
        ('10.1.2.3 - - [bad] "GET / HTTP/1.1" 200 99999999999999999999999', "/", "/", 200, None),
        (PREFIX + '"GET / HTTP/1.1" 404 404', "/", "/", 404, 404),
        ('10.1.2.3 - - [1/Oct/2023:13:55:36 -0700] "GET /z// HTTP/1.1" 404 9', "/z//", "/z/", 404, 9),
        ("garbage", "", "", None, None),
        ("", "", "", None, None),
    ],
)
def test_malformed_and_edge_lines(spark, line, endpoint, clean, status, size):
    (row,) = parse(spark, [line])
    assert (row["endpoint"], row["endpoint_clean"], row["status_code"], row["response_size"]) == (
        endpoint, clean, status, size)


def test_request_dash_keeps_quote_in_method(spark):
    (row,) = parse(spark, [PREFIX + '"-" 408 -'])
    assert row["method"] == '-"'
    assert row["protocol"] == "-"


def test_bad_and_single_digit_day_times_are_null(spark):
    rows = parse(spark, ['1.1.1.1 - - [bad] "GET / HTTP/1.1" 200 1',
                         '1.1.1.1 - - [1/Oct/2023:13:55:36 -0700] "GET / HTTP/1.1" 200 1'])
    assert [r["timestamp"] for r in rows] == [None, None]


def test_non_match_gives_empty_strings_and_null_line_gives_nulls(spark):
    garbage, null = parse(spark, ["garbage", None])
    assert garbage["client_ip"] == "garbage" and garbage["method"] == "" and garbage["timestamp"] is None
    assert all(v is None for v in null.values())


def test_a_year_beyond_all_timestamps_is_null_and_does_not_stop_the_job(spark):
    rows = parse(spark, ['1.1.1.1 - - [10/Oct/2023999999:13:55:36 -0700] "GET / HTTP/1.1" 200 1',
                         '1.1.1.1 - - [10/Oct/+2023999999:13:55:36 -0700] "GET / HTTP/1.1" 200 1'])
    assert [(r["timestamp"], r["status_code"]) for r in rows] == [(None, 200)] * 2
