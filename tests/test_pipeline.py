import datetime as dt
import os
import time

import pytest

from tidelog.operators.quality import QualityGateError
from tidelog.operators.report import access_report, access_report_sql
from tidelog.plans import pipeline as P
from tidelog.plans.spec import PipelineSpec
from tidelog.schemas import SILVER_LOG_SCHEMA

LINE = '203.0.113.9 - - [07/Feb/2024:06:05:04 +0100] "PUT /cart HTTP/2.0" 204 1717'
RUN_TS = dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)


def make_spec(tmp_path, name, file_name="access.txt", content=LINE + "\n", **kw):
    landing = tmp_path / "landing"
    landing.mkdir(exist_ok=True)
    if content is not None:
        (landing / file_name).write_text(content)
    args = dict(pipeline_name=name, file_name=file_name, landing_path=str(landing),
                base_path=str(tmp_path / "lake"), table_name_bronze=f"b_{name}",
                table_name_silver=f"s_{name}", table_name_gold=f"g_{name}")
    args.update(kw)
    return PipelineSpec(**args)


def audit(spark, name):
    rows = spark.table("monitoring.execution_logs").filter(f"pipeline_name = '{name}'").collect()
    return sorted((r.step, r.status) for r in rows), rows


def test_full_run_writes_every_layer_and_audits_each_stage(spark, tmp_path):
    spec = make_spec(tmp_path, "full", gold_builder=access_report)
    P.run(spark, spec, 4, RUN_TS)
    bronze = spark.table(spec.bronze_table).collect()
    assert [r.value for r in bronze] == [LINE]
    assert str(bronze[0].processed_date) == "2024-01-02"
    silver_types = [(f.name, f.dataType) for f in spark.table(spec.silver_table).schema.fields]
    assert silver_types == [(f.name, f.dataType) for f in SILVER_LOG_SCHEMA.fields]
    silver = spark.table(spec.silver_table).first()
    assert silver.client_ip == "203.0.113.9" and silver.status_code == 204 and silver.response_size == 1717
    gold = spark.table(spec.gold_table).first()
    assert gold.distinct_ip_count == 1 and gold.total_volume == 1717.0
    steps, rows = audit(spark, "full")
    assert steps == [("bronze", "OK"), ("gold", "OK"), ("landing", "OK"), ("silver", "OK")]
    assert all(r.time_elapsed >= 0 and r.error_message == "" for r in rows)
    spark.sql(f"DROP TABLE {spec.gold_table}")  # e.g. a new session: found again by path
    frames = P.log_analysis(spark, spec)
    assert [tuple(r) for r in frames["top_ips"].collect()] == [("203.0.113.9", 1)]
    assert [tuple(r) for r in frames["top_endpoints"].collect()] == [("/cart", 1)]
    assert frames["kpis"].first().distinct_day_count == 1
    mon = P.monitoring_analysis(spark)
    assert {r.step for r in mon["durations"].collect()} >= {"landing", "bronze", "silver", "gold"}
    assert ("full", "OK") in {(r.pipeline_name, r.status) for r in mon["status"].collect()}
    q = spark.table("quality.quality_checks").filter("verified_table = 's_full'").collect()
    assert sorted(r.rule for r in q) == sorted(
        ["not_null_client_ip", "not_null_endpoint", "not_null_status_code", "not_null_timestamp", "not_zero_count"])


def test_missing_landing_file_logs_notok_and_raises(spark, tmp_path):
    spec = make_spec(tmp_path, "missing", file_name="not_delivered.txt", content=None)
    with pytest.raises(FileNotFoundError):
        P.run(spark, spec, 1, RUN_TS)
    with pytest.raises(FileNotFoundError):
        P.landing_to_bronze(spark, spec, RUN_TS)
    steps, rows = audit(spark, "missing")
    assert steps == [("bronze", "NOTOK"), ("landing", "NOTOK")]
    assert all("not_delivered.txt" in r.error_message for r in rows)


def test_unsupported_extension(spark, tmp_path):
    spec = make_spec(tmp_path, "json", file_name="data.json", content="{}")
    with pytest.raises(ValueError, match="unsupported"):
        P.run(spark, spec, 2, RUN_TS)
    steps, _ = audit(spark, "json")
    assert steps == [("landing", "NOTOK")]


def test_upper_case_txt_loads_bronze_then_silver_fails(spark, tmp_path):
    spec = make_spec(tmp_path, "upper", file_name="LOG.TXT")
    with pytest.raises(ValueError, match="unsupported file type for a log"):
        P.run(spark, spec, 3, RUN_TS)
    steps, _ = audit(spark, "upper")
    assert steps == [("bronze", "OK"), ("landing", "OK"), ("silver", "NOTOK")]


def test_csv_log_uses_first_column(spark, tmp_path):
    spec = make_spec(tmp_path, "csvlog", file_name="log.csv")
    P.run(spark, spec, 3, RUN_TS)
    assert spark.table(spec.silver_table).first().endpoint == "/cart"


def test_empty_gold_sql_is_rejected(spark, tmp_path):
    spec = make_spec(tmp_path, "nogold", sql_gold="   ")
    with pytest.raises(ValueError, match="gold SQL"):
        P.run(spark, spec, 4, RUN_TS)
    steps, _ = audit(spark, "nogold")
    assert ("gold", "NOTOK") in steps and ("silver", "OK") in steps


def test_sql_gold_select_star(spark, tmp_path):
    spec = make_spec(tmp_path, "star", sql_gold="select * from silver.s_star")
    P.run(spark, spec, 4, RUN_TS)
    gold = spark.table(spec.gold_table)
    assert gold.count() == 1 and "endpoint_clean" in gold.columns


def test_report_sql_as_gold(spark, tmp_path):
    spec = make_spec(tmp_path, "rsql", sql_gold=access_report_sql("silver.s_rsql") + ";")
    P.run(spark, spec, 4, RUN_TS)
    assert spark.table(spec.gold_table).first().distinct_ip_count == 1


def test_invalid_step(spark, tmp_path):
    with pytest.raises(ValueError, match="invalid step"):
        P.run(spark, make_spec(tmp_path, "badstep"), 5)


def test_quality_gate_blocks_silver_and_keeps_previous_version(spark, tmp_path):
    spec = make_spec(tmp_path, "gate")
    P.run(spark, spec, 3, RUN_TS)
    assert spark.table(spec.silver_table).count() == 1
    (tmp_path / "landing" / "access.txt").write_text(LINE + "\ngarbage line\n")
    with pytest.raises(QualityGateError):
        P.run(spark, spec, 3, RUN_TS)
    assert spark.table(spec.silver_table).count() == 1  # the old silver is still published
    q = spark.table("quality.quality_checks").filter("verified_table = 's_gate' AND status = 'FAIL'")
    assert {r.rule: r.percentage_ok for r in q.collect()} == {"not_null_status_code": 50.0, "not_null_timestamp": 50.0}
    steps, _ = audit(spark, "gate")
    assert steps.count(("silver", "NOTOK")) == 1


def test_empty_landing_file_fails_every_rule(spark, tmp_path):
    spec = make_spec(tmp_path, "empty", content="")
    with pytest.raises(QualityGateError):
        P.run(spark, spec, 3, RUN_TS)
    q = spark.table("quality.quality_checks").filter("verified_table = 's_empty'").collect()
    assert {(r.rule, r.status, r.percentage_ok) for r in q} == {
        (rule, "FAIL", 0.0) for rule in ("not_null_client_ip", "not_null_endpoint", "not_null_status_code",
                                         "not_null_timestamp", "not_zero_count")}
    assert not spark.catalog.tableExists(spec.silver_table)


def test_sql_defined_silver(spark, tmp_path):
    spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string").createOrReplaceTempView("src_rows")
    spec = make_spec(tmp_path, "nonlog", is_log=False, sql_silver="SELECT id, name FROM src_rows")
    P.run(spark, spec, 3, RUN_TS)
    assert sorted(r.id for r in spark.table(spec.silver_table).collect()) == [1, 2]
    q = spark.table("quality.quality_checks").filter("verified_table = 's_nonlog'").collect()
    assert [(r.rule, r.status) for r in q] == [("not_zero_count", "OK")]


def test_blank_silver_sql_is_rejected(spark, tmp_path):
    spec = make_spec(tmp_path, "blanksilver", is_log=False, sql_silver=" ")
    with pytest.raises(ValueError, match="silver SQL"):
        P.run(spark, spec, 3, RUN_TS)


def test_once_only_ingest(spark, tmp_path):
    spec = make_spec(tmp_path, "once", once_only=True)
    P.run(spark, spec, 3, RUN_TS)
    with pytest.raises(FileNotFoundError, match="no unseen"):
        P.run(spark, spec, 3, RUN_TS)  # same file again: skipped, nothing new
    time.sleep(1.1)
    path = tmp_path / "landing" / "access.txt"
    path.write_text(LINE.replace("/cart", "/again") + "\n")
    os.utime(path, None)
    P.run(spark, spec, 3, RUN_TS)  # a new delivery under the same name loads
    assert [r.value for r in spark.table(spec.bronze_table).collect()] == [LINE.replace("/cart", "/again")]


def test_refused_delivery_is_loaded_again(spark, tmp_path):
    spec = make_spec(tmp_path, "refused", content="garbage\n", once_only=True)
    for _ in range(2):  # the second run reaches the gate again
        with pytest.raises(QualityGateError):
            P.run(spark, spec, 3, RUN_TS)
    (tmp_path / "landing" / "access.txt").write_text(LINE + "\n")
    P.run(spark, spec, 3, RUN_TS)
    assert spark.table(spec.silver_table).count() == 1
