import datetime as dt

import pytest

from tidelog.operators.quality import evaluate_rules, quality_counts, quality_rows

NOW = dt.datetime(2024, 5, 6, 7, 8, 9)


COLUMNS = "client_ip string, endpoint string, status_code int, timestamp timestamp, size string"
WHOLE = ("2001:db8::5", "/", 304, NOW, None)
CHECKED = ("client_ip", "endpoint", "status_code", "timestamp")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def without(column):
    """A row that lacks one checked column."""
    i = CHECKED.index(column)
    return (*WHOLE[:i], None, *WHOLE[i + 1 :])


def rules_of(df):
    return {r.rule: (r.status, r.percentage_ok) for r in df.collect()}


def test_rows_with_every_checked_column_pass(spark):
    got = rules_of(quality_rows(frame(spark, WHOLE, WHOLE, ("", "", 0, NOW, "x")), "p", "bronze_to_silver", "t", NOW))
    assert got == {**{f"not_null_{c}": ("OK", 100.0) for c in CHECKED}, "not_zero_count": ("OK", 100.0)}


@pytest.mark.parametrize("column", CHECKED)
def test_one_missing_value_fails_its_rule_alone(spark, column):
    got = rules_of(quality_rows(frame(spark, WHOLE, WHOLE, WHOLE, without(column)), "p", "s", "t", NOW))
    assert got.pop(f"not_null_{column}") == ("FAIL", 75.0)
    assert set(got.values()) == {("OK", 100.0)} and len(got) == 4


def test_all_null_rows_fail_every_column_but_not_the_count(spark):
    got = rules_of(quality_rows(frame(spark, (None,) * 5, (None,) * 5), "p", "s", "t", NOW))
    assert got.pop("not_zero_count") == ("OK", 100.0) and set(got.values()) == {("FAIL", 0.0)}


def test_gate_and_table_use_the_same_rules(spark):
    df = frame(spark, WHOLE, without("endpoint"), without("status_code"))
    counts = quality_counts(df).first().asDict()
    results = {r.rule: (r.status, r.percentage_ok) for r in evaluate_rules(counts, True)}
    assert results == rules_of(quality_rows(df, "p", "s", "t", NOW))


def test_empty_frame_fails_everything(spark):
    empty = frame(spark)
    got = rules_of(quality_rows(empty, "p", "s", "t", NOW))
    assert got == {k: ("FAIL", 0.0) for k in got} and len(got) == 5
    non_log = rules_of(quality_rows(empty, "p", "s", "t", NOW, is_log=False))
    assert non_log == {"not_zero_count": ("FAIL", 0.0)}


def test_quality_row_schema(spark):
    df = quality_rows(frame(spark, WHOLE), "nightly", "bronze_to_silver", "s_lines", NOW)
    assert df.columns == ["pipeline_name", "step", "timestamp", "status", "rule", "percentage_ok", "verified_table"]
    row = df.first()
    assert row.pipeline_name == "nightly" and row.verified_table == "s_lines"


@pytest.mark.parametrize("valid,total,pct", [(2, 3, 66.67), (1, 3, 33.33), (0, 3, 0.0), (265, 800, 33.12)])
def test_percentages_rounded_to_two_places(valid, total, pct):
    counts = {"total": total, **{f"valid_{c}": valid for c in ("client_ip", "endpoint", "status_code", "timestamp")}}
    results = evaluate_rules(counts, True)
    assert results[0].percentage_ok == pct and results[0].status == "FAIL"
