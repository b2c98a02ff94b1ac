import datetime as dt

from tidelog.operators import metrics as M
from tidelog.operators.report import access_report, access_report_sql, report_frames

SCHEMA = ("client_ip string, timestamp timestamp, endpoint_clean string, "
          "status_code int, response_size bigint")


def ts(day, hour=12):
    return dt.datetime(2024, 1, day, hour, 0, 0)  # 2024-01-01 is a Monday


def silver(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


ROWS = [
    ("a", ts(1), "/home", 200, 10),
    ("a", ts(1), "/home", 404, None),
    ("b", ts(2), "/about", 404, 5),
    ("b", ts(2), "/x.CSS", 200, 7),
    ("c", ts(2), "/robots.txt", 200, 1),
    ("c", None, "/home", 403, 3),
    ("d", ts(3), "/app.js?v=1", 500, None),
    ("", None, "", None, None),
]


def test_top_client_ips_ties_by_key(spark):
    got = [tuple(r) for r in M.top_client_ips(silver(spark, ROWS), k=3).collect()]
    assert got == [("a", 2), ("b", 2), ("c", 2)]


def test_top_endpoints_excludes_assets_and_robots(spark):
    got = [tuple(r) for r in M.top_endpoints(silver(spark, ROWS)).collect()]
    assert got == [("/home", 3), ("", 1), ("/about", 1)]


def test_volume_ignores_nulls(spark):
    v = M.volume_stats(silver(spark, ROWS)).first()
    assert (v.total_volume, v.max_volume, v.min_volume, v.avg_volume) == (26.0, 10.0, 1.0, 26.0 / 5)


def test_distinct_counts(spark):
    d = M.distinct_counts(silver(spark, ROWS)).first()
    assert (d.distinct_ip_count, d.distinct_day_count) == (5, 3)


def test_approximate_distinct_counts_opt_in(spark):
    d = M.distinct_counts(silver(spark, ROWS), approx_rsd=0.01).first()
    assert (d.distinct_ip_count, d.distinct_day_count) == (5, 3)


def test_weekday_counts_keep_null_weekday(spark):
    got = {r.day_of_week: r.client_error_count for r in M.client_errors_by_weekday(silver(spark, ROWS)).collect()}
    assert got == {"Monday": 1, "Tuesday": 1, None: 1}
    worst = M.worst_error_weekday(silver(spark, ROWS)).collect()
    assert [tuple(r) for r in worst] == [("Monday", 1)]


def test_report_row(spark):
    rep = access_report(silver(spark, ROWS)).first()
    assert [tuple(x) for x in rep.top_ips][:3] == [("a", 2), ("b", 2), ("c", 2)]
    assert [tuple(x) for x in rep.top_endpoints] == [("/home", 3), ("", 1), ("/about", 1)]
    assert rep.distinct_ip_count == 5 and rep.distinct_day_count == 3
    assert rep.day_with_most_client_errors == "Monday"
    assert (rep.total_volume, rep.max_volume, rep.min_volume) == (26.0, 10.0, 1.0)
    assert rep.avg_volume == 26.0 / 5


def test_report_dataframe_equals_report_sql(spark):
    df = silver(spark, ROWS)
    df.createOrReplaceTempView("silver_rows")
    assert access_report(df).collect() == spark.sql(access_report_sql("silver_rows")).collect()


def test_report_on_empty_silver(spark):
    rep = access_report(silver(spark, ROWS).limit(0)).first()
    assert rep.top_ips == [] and rep.top_endpoints == []
    assert rep.distinct_ip_count == 0 and rep.distinct_day_count == 0
    assert rep.day_with_most_client_errors is None and rep.total_volume is None and rep.avg_volume is None


def test_report_frames_explode(spark):
    frames = report_frames(access_report(silver(spark, ROWS)))
    assert frames["top_endpoints"].columns == ["endpoint", "access_count"]
    assert frames["top_ips"].count() == 5
    assert frames["kpis"].count() == 1


def test_hot_client_is_aggregated_not_collected(spark):
    # one client with a third of all rows: the plan aggregates partially before the shuffle
    rows = [("hot", ts(1), "/a", 200, 1)] * 300 + [(f"c{i}", ts(2), "/b", 200, 1) for i in range(600)]
    df = silver(spark, rows).repartition(8)
    plan = M.top_client_ips(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "TakeOrderedAndProject" in plan
    assert M.top_client_ips(df, k=1).first().access_count == 300


def test_response_category(spark):
    df = spark.createDataFrame([(c,) for c in (101, 200, 302, 404, 503, 600, None)], "status_code int")
    got = [r.response_category for r in M.response_categories(df).collect()]
    assert got == ["Informational", "Success", "Redirection", "Client Error", "Server Error", "Unknown", "Unknown"]
