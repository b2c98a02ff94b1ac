"""Plan-shape checks: pruning, pushdown, shuffle reuse, no cross products."""

import datetime as dt
import re

import pytest

from tidelog.functions.logparse import parse_access_log
from tidelog.operators import metrics as M
from tidelog.operators.quality import quality_counts
from tidelog.operators.report import access_report
from tidelog.plans.tables import with_control_columns
from tidelog.sources.events_log import access_lines

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored_silver(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver"))
    events = spark.read.parquet(f"{SF}/events.parquet")
    silver = with_control_columns(parse_access_log(access_lines(events)), dt.datetime(2024, 1, 1))
    silver.write.mode("overwrite").partitionBy("processed_date").parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    """The formatted plan after execution (final adaptive plans, incl. subqueries)."""
    df.collect()
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def read_schemas(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


def test_report_scans_each_column_group_once_and_reuses_the_client_shuffle(stored_silver):
    plan = final_plan(access_report(stored_silver))
    # the formatted text also lists initial-plan nodes, so compare the set
    assert set(read_schemas(plan)) == {
        "client_ip:string",
        "endpoint_clean:string",
        "timestamp:timestamp,status_code:int,response_size:bigint",
    }
    assert "ReusedExchange" in plan
    assert "TakeOrderedAndProject" in plan
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SortMergeJoin"):
        assert bad not in plan


def test_client_error_filter_reaches_parquet(stored_silver):
    plan = final_plan(M.client_errors_by_weekday(stored_silver))
    assert "GreaterThanOrEqual(status_code,400)" in plan and "LessThanOrEqual(status_code,499)" in plan


def test_top_k_is_take_ordered_not_a_global_sort(stored_silver):
    plan = final_plan(M.top_client_ips(stored_silver))
    assert "TakeOrderedAndProject" in plan and "partial_count" in plan
    assert "rangepartitioning" not in plan.lower()


def test_page_filter_reaches_the_scan_and_asset_keys_are_not_shuffled(spark, stored_silver):
    for df in (M.top_endpoints(stored_silver), access_report(stored_silver)):
        plan = final_plan(df)
        assert "Not(EqualTo(endpoint_clean,/robots.txt))" in plan
    text = M.page_hits(stored_silver)._jdf.queryExecution().optimizedPlan().toString()
    lines = [line.strip(" +-:") for line in text.splitlines()]
    assert lines[0].startswith("Aggregate") and any("RLIKE" in x and x.startswith("Filter") for x in lines[1:])


def test_quality_gate_is_one_aggregation(stored_silver):
    plan = final_plan(quality_counts(stored_silver))
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange") == 1 and len(set(read_schemas(plan))) == 1
