"""Top-k by count sketches, and the report kept up by deliveries."""

import datetime as dt
import os
import re

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.operators import metrics as M
from tidelog.operators.heavy import count_sketch, merged_sketches, top_by_sketch
from tidelog.operators.report import access_report
from tidelog.plans.report_state import ReportState

SILVER = ("client_ip string, timestamp timestamp, endpoint_clean string, status_code int, response_size bigint")


def silver(spark, rows):
    return spark.createDataFrame(rows, SILVER)


def lines(n, start, step=7):
    day = dt.datetime(2024, 1, 1)
    return [(f"10.0.{(i * step) % 5}.{(i * i) % 40}" if i % 23 else None,
             day + dt.timedelta(days=(i * 3) % 9, hours=i % 24) if i % 17 else None,
             ("/a", "/b/c", "/x.css", "/robots.txt", None, "/")[i % 6], (200, 404, 500, None)[i % 4],
             i % 100 if i % 5 else None) for i in range(start, start + n)]


# --- sketches -----------------------------------------------------------------------------

@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
          phases=[Phase.explicit, Phase.generate])
@given(st.lists(st.one_of(st.none(), st.integers(0, 60).map(lambda x: str(x * x % 37))), max_size=300),
       st.integers(1, 5), st.sampled_from([4, 16, 256]))
def test_top_by_sketch_equals_counting_all(spark, keys, k, width):
    df = spark.createDataFrame([(x,) for x in keys], "key string").coalesce(2)
    want = M.top_k(M.hits_by(df, "key"), "key", k).collect()
    assert top_by_sketch(df, "key", k, width=width, loose=1.0).collect() == want


def test_hot_keys_among_many_are_found_without_counting_all(spark):
    keys = spark.range(200000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 == 0, F.concat(
        F.lit("warm"), F.col("id") % 9)).otherwise(F.col("id").cast("string")).alias("key"))
    top = top_by_sketch(keys, "key", 5)
    assert top.collect() == M.top_k(M.hits_by(keys, "key"), "key", 5).collect()
    counted = [c for c in _inputs(top) if c]
    assert max(counted) < 200  # keys counted exactly, of about 107,000
    flat = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    assert top_by_sketch(flat, "key", 3).collect() == M.top_k(M.hits_by(flat, "key"), "key", 3).collect()


def _inputs(top):
    """Rows that the partial and final aggregations of a finished plan put out."""
    top.collect()
    found, todo = [], [top._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if "AdaptiveSparkPlan" in name:
            todo.append(node.executedPlan())
        if "QueryStage" in name or "ReusedExchange" in name:
            todo.append(node.plan() if "QueryStage" in name else node.child())
        if "HashAggregate" in name:
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_sketches_of_parts_add_up(spark):
    df = silver(spark, lines(500, 0))
    parts = count_sketch(df.filter("response_size < 40"), "client_ip").union(
        count_sketch(df.filter("NOT coalesce(response_size < 40, false)"), "client_ip"))
    whole = merged_sketches(parts)
    assert sorted(whole.collect()) == sorted(count_sketch(df, "client_ip").collect())
    assert top_by_sketch(df, "client_ip", 4, sketch=whole).collect() == M.top_client_ips(df, 4).collect()


# --- state ---------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def state(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("state"))
    kept = ReportState(spark, base, sketches=True)
    kept.add(silver(spark, lines(300, 0)), "one")
    kept.add(silver(spark, lines(50, 900)), "two")       # replaced below
    kept.add(silver(spark, []), "none")
    kept.add(silver(spark, lines(250, 300, 11)), "two")  # late lines of the same days, new clients
    return kept


@pytest.fixture(scope="module")
def whole(spark):
    return silver(spark, lines(300, 0) + lines(250, 300, 11)).cache()


def test_report_equals_the_full_one(state, whole):
    assert state.report().collect() == access_report(whole).collect()


def test_report_of_a_range_of_days(state, whole):
    first, last = dt.date(2024, 1, 3), dt.date(2024, 1, 5)
    part = whole.filter((F.to_date("timestamp") >= F.lit(first)) & (F.to_date("timestamp") <= F.lit(last)))
    assert state.report(first, last).collect() == access_report(part).collect()


@pytest.mark.parametrize("first, last", [(None, None), (dt.date(2024, 1, 4), None), (None, dt.date(2024, 1, 2)),
                                         (dt.date(2024, 1, 2), dt.date(2024, 1, 7)), (dt.date(2030, 1, 1), None)])
def test_distincts_of_any_range(state, whole, first, last):
    part = whole
    if first:
        part = part.filter(F.to_date("timestamp") >= F.lit(first))
    if last:
        part = part.filter(F.to_date("timestamp") <= F.lit(last))
    want = M.distinct_counts(part).first()
    assert state.distinct_counts(first, last).first() == want
    near = state.distinct_counts(first, last, approximate=True).first()
    assert abs(near[0] - want[0]) <= 0.05 * want[0] and near[1] == want[1]


def test_rolling_clients(state, whole):
    days = {r.day: r.ips for r in whole.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.collect_set("client_ip").alias("ips")).collect() if r.day}
    want = {d: len({ip for e, ips in days.items() if d - dt.timedelta(days=2) <= e <= d for ip in ips}) for d in days}
    assert {r.date: r.distinct_ip_count for r in state.rolling_clients(3).collect()} == want


def test_client_numbers_are_unique_and_dense(state, whole):
    rows = state.clients().collect()
    known = {r.client_ip for r in whole.select("client_ip").union(state.spark.createDataFrame(
        lines(50, 900), SILVER).select("client_ip")).distinct().collect()} - {None}
    assert {r.client_ip for r in rows} == known and len({r.number for r in rows}) == len(rows)


def test_a_delivery_leaves_earlier_ones_alone(spark, tmp_path):
    kept = ReportState(spark, str(tmp_path))
    kept.add(silver(spark, lines(100, 0)), "a")
    before = {os.path.join(r, f): os.stat(os.path.join(r, f)).st_mtime_ns for r, _, fs in os.walk(tmp_path) for f in fs}
    kept.add(silver(spark, lines(100, 50)), "b")
    assert all(os.stat(f).st_mtime_ns == t for f, t in before.items())
    with pytest.raises(ValueError):
        kept.add(silver(spark, []), "../x")


def test_plans_read_the_state_only(state):
    first = dt.date(2024, 1, 4)
    plan = state.distinct_counts(first)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "client_ip" not in plan and "key" not in re.sub(r"keys?=", "", plan)
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date,2024-01-04)]" in plan
    assert "isnotnull(kind" in plan and "kind#" in plan.split("PartitionFilters")[1]
    files = state.report().inputFiles()
    assert files and all(f"{state.base}/deliveries/" in f.replace("file://", "") for f in files)


def test_an_empty_state_gives_an_empty_report(spark, tmp_path):
    empty = ReportState(spark, str(tmp_path / "none"))
    assert empty.report().collect() == access_report(silver(spark, [])).collect()
    assert tuple(empty.distinct_counts().first()) == (0, 0)
