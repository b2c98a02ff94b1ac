import datetime as dt
import threading

import pytest

from pyspark.sql import functions as F

from tidelog.operators.monitoring import latest_runs, run_durations, run_status
from tidelog.plans.audit import insert_execution_log, save_execution_log
from tidelog.plans import tables
from tidelog.plans.tables import (
    compact_table,
    ensure_environment,
    new_version_path,
    purge_rows,
    read_layer,
    write_layer,
    write_version,
)
from tidelog.schemas import EXECUTION_LOG_SCHEMA, ddl
from tidelog.sources.ledger import landing_files, read_unseen, record_files

T0 = dt.datetime(2024, 3, 1, 10, 0, 0)


def fresh_log_table(spark, tmp_path, name):
    ensure_environment(spark, str(tmp_path / "lake"))
    table = f"monitoring.{name}"
    spark.sql(f"CREATE TABLE {table} ({ddl(EXECUTION_LOG_SCHEMA)}) USING parquet LOCATION '{tmp_path / name}'")
    return table


def test_environment_is_idempotent(spark, tmp_path):
    ensure_environment(spark, str(tmp_path / "lake"))
    ensure_environment(spark, str(tmp_path / "lake"))
    names = {d.name for d in spark.catalog.listDatabases()}
    assert {"monitoring", "bronze", "silver", "gold", "quality"} <= names
    assert spark.catalog.tableExists("monitoring.execution_logs")
    assert spark.catalog.tableExists("quality.quality_checks")


def test_execution_log_append_and_parameterised_insert(spark, tmp_path):
    table = fresh_log_table(spark, tmp_path, "logs_a")
    assert save_execution_log(spark, T0, "nightly_load", "landing", "OK", "", "/lake/landing/", 3.5, table)
    insert_execution_log(spark, T0 + dt.timedelta(minutes=1), "nightly_load", "gold", "NOTOK",
                         "it's broken; DROP TABLE x", "/p", 1.25, table=table)
    rows = latest_runs(spark.table(table), "nightly_load").collect()
    assert [(r.step, r.status, r.error_message) for r in rows] == [
        ("gold", "NOTOK", "it's broken; DROP TABLE x"), ("landing", "OK", "")]
    assert rows[1].time_elapsed == 3.5


def test_audit_failure_is_swallowed(spark):
    assert save_execution_log(spark, T0, "p", "s", "OK", "", "/p", 1.0, "no_such_db.no_such_table") is False


def test_audit_table_is_created_when_missing(spark, tmp_path):
    ensure_environment(spark, str(tmp_path / "lake"))
    assert save_execution_log(spark, T0, "p", "s", "OK", "", "/p", 1.0, "monitoring.created_on_demand")
    assert spark.table("monitoring.created_on_demand").count() == 1


def test_like_without_wildcard_and_monitoring_views(spark, tmp_path):
    table = fresh_log_table(spark, tmp_path, "logs_b")
    for i, (p, step, status, secs) in enumerate([
        ("day_load", "bronze", "OK", 2.0), ("day_load", "bronze", "NOTOK", 4.0),
        ("day_load", "gold", "OK", 1.0), ("dayXload", "gold", "OK", 9.0),
    ]):
        save_execution_log(spark, T0 + dt.timedelta(minutes=i), p, step, status, "", "/p", secs, table)
    logs = spark.table(table)
    assert latest_runs(logs, "day_load", like=True).count() == 4  # '_' matches any character
    assert latest_runs(logs, "day_load").count() == 3
    assert [tuple(r) for r in run_durations(logs).collect()] == [("gold", 5.0), ("bronze", 3.0)]
    got = {(r.pipeline_name, r.status): r.runs for r in run_status(logs).collect()}
    assert got == {("day_load", "OK"): 2, ("day_load", "NOTOK"): 1, ("dayXload", "OK"): 1}


def test_purge_rows_keeps_the_rest(spark, tmp_path):
    table = fresh_log_table(spark, tmp_path, "logs_c")
    for p in ("a", "b", "a", None):
        save_execution_log(spark, T0, p, "s", "OK", "", "/p", 1.0, table)
    kept = purge_rows(spark, table, "pipeline_name = 'a'")
    assert kept == 2
    assert sorted(str(r.pipeline_name) for r in spark.table(table).collect()) == ["None", "b"]
    assert spark.table(table).schema == spark.createDataFrame([], EXECUTION_LOG_SCHEMA).schema


def test_write_layer_overwrites_and_partitions(spark, tmp_path):
    ensure_environment(spark, str(tmp_path / "lake"))
    df = spark.range(10).withColumn("processed_date", F.lit("2024-01-01").cast("date"))
    write_layer(df, "bronze.layer_t", str(tmp_path / "layer"), optimize_write=True)
    write_layer(df.limit(3), "bronze.layer_t", str(tmp_path / "layer"))
    assert spark.table("bronze.layer_t").count() == 3
    versions = [p for p in (tmp_path / "layer").iterdir() if p.name.startswith("v=")]
    assert len(versions) == 2  # the one before stays for running readers
    write_layer(df.limit(2), "bronze.layer_t", str(tmp_path / "layer"))
    versions = sorted(p for p in (tmp_path / "layer").iterdir() if p.name.startswith("v="))
    assert len(versions) == 2 and (versions[0] / "processed_date=2024-01-01").is_dir()
    assert spark.table("bronze.layer_t").count() == 2


def test_files_of_the_version_before_outlive_a_publish(spark, tmp_path):
    ensure_environment(spark, str(tmp_path / "lake"))
    df = spark.range(7).withColumn("processed_date", F.lit("2024-01-01").cast("date"))
    write_layer(df, "bronze.layer_p", str(tmp_path / "layer_p"))
    running = spark.read.parquet(*spark.table("bronze.layer_p").inputFiles())  # a reader with its files planned
    write_layer(df.limit(1), "bronze.layer_p", str(tmp_path / "layer_p"))
    assert running.count() == 7 and spark.table("bronze.layer_p").count() == 1


def test_fallback_ignores_versions_that_were_not_published(spark, tmp_path):
    ensure_environment(spark, str(tmp_path / "lake"))
    path = str(tmp_path / "layer_u")
    df = spark.range(10).withColumn("processed_date", F.lit("2024-01-01").cast("date"))
    write_layer(df, "bronze.layer_u", path)
    write_version(df.limit(3), new_version_path(path))  # a driver that died before its gate
    spark.sql("DROP TABLE bronze.layer_u")
    assert read_layer(spark, "bronze.layer_u", path).count() == 10


def test_rows_appended_during_a_compaction_stay(spark, tmp_path, monkeypatch):
    table = fresh_log_table(spark, tmp_path, "logs_e")
    for i in range(3):
        save_execution_log(spark, T0, "p", str(i), "OK", "", "/p", 1.0, table)
    plain = tables.remove_path

    def append_first(*args):  # another run appends while this one has its rows read and written
        save_execution_log(spark, T0, "p", "3", "OK", "", "/p", 1.0, table)
        plain(*args)

    monkeypatch.setattr(tables, "remove_path", append_first)
    assert compact_table(spark, table) == 3
    assert sorted(r.step for r in spark.table(table).collect()) == ["0", "1", "2", "3"]


def test_failed_layer_write_keeps_previous_table(spark, tmp_path):
    ensure_environment(spark, str(tmp_path / "lake"))
    df = spark.range(5).withColumn("processed_date", F.lit("2024-01-01").cast("date"))
    write_layer(df, "bronze.layer_f", str(tmp_path / "layer_f"))
    bad = df.withColumn("id", F.expr("assert_true(id < 0)"))  # fails inside the write job
    with pytest.raises(Exception):
        write_layer(bad, "bronze.layer_f", str(tmp_path / "layer_f"))
    assert spark.table("bronze.layer_f").count() == 5
    assert len([p for p in (tmp_path / "layer_f").iterdir() if p.name.startswith("v=")]) == 1


def test_read_layer_falls_back_to_newest_version(spark, tmp_path):
    ensure_environment(spark, str(tmp_path / "lake"))
    df = spark.range(4).withColumn("processed_date", F.lit("2024-01-01").cast("date"))
    write_layer(df, "bronze.layer_r", str(tmp_path / "layer_r"))
    spark.sql("DROP TABLE bronze.layer_r")  # e.g. a new session with an empty catalog
    back = read_layer(spark, "bronze.layer_r", str(tmp_path / "layer_r"))
    assert back.count() == 4 and "v" not in back.columns


def test_ledger_skips_seen_files(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.txt").write_text("one\ntwo\n")
    ledger = str(tmp_path / "ledger")
    rows, files = read_unseen(spark, str(landing), ledger, "text")
    assert sorted(r.value for r in rows.collect()) == ["one", "two"]
    record_files(files, ledger, "p", T0)
    (landing / "b.txt").write_text("three\n")
    rows, files = read_unseen(spark, str(landing), ledger, "text")
    assert [r.value for r in rows.collect()] == ["three"]
    assert landing_files(spark, str(landing)).count() == 2


def test_compact_table_keeps_every_row_in_fewer_files(spark, tmp_path):
    table = fresh_log_table(spark, tmp_path, "logs_d")
    for i in range(6):
        save_execution_log(spark, T0 + dt.timedelta(seconds=i), "p", "s", "OK", "", "/p", float(i), table)
    before = sorted(tuple(r) for r in spark.table(table).collect())
    files_before = len(spark.table(table).inputFiles())
    assert compact_table(spark, table) == 6
    assert sorted(tuple(r) for r in spark.table(table).collect()) == before
    assert len(spark.table(table).inputFiles()) < files_before


def test_ledger_names_with_pattern_characters_load_once(spark, tmp_path):
    landing, ledger = tmp_path / "landing", str(tmp_path / "ledger")
    landing.mkdir()
    names = ["a[1].txt", "b{x}.txt", "e*f.txt", "eXf.txt", "what?.txt"]
    for n in names:
        (landing / n).write_text(n + "\n")
    loaded = []
    for _ in range(3):  # two files a run, the rest carried over
        rows, files = read_unseen(spark, str(landing), ledger, "text", max_files=2)
        loaded += [r.value for r in rows.collect()]
        record_files(files, ledger, "p", T0)
    assert sorted(loaded) == sorted(names)
    with pytest.raises(FileNotFoundError):
        read_unseen(spark, str(landing), ledger, "text")


def test_a_large_delivery_is_loaded_whole(spark, tmp_path):
    landing, ledger = tmp_path / "landing", str(tmp_path / "ledger")
    landing.mkdir()
    (landing / "seen.txt").write_text("seen\n")
    record_files(landing_files(spark, str(landing)), ledger, "p", T0)
    n = 10_001
    for i in range(n):
        (landing / f"{i}.txt").write_text(f"{i}\n")
    rows, files = read_unseen(spark, str(landing), ledger, "text")
    assert rows.count() == files.count() == n
    assert rows.distinct().count() == n and rows.filter("value = 'seen'").count() == 0


def test_seen_files_give_csv_no_columns(spark, tmp_path):
    landing, ledger = tmp_path / "landing", str(tmp_path / "ledger")
    landing.mkdir()
    (landing / "old.csv").write_text("a\n" * 50)
    record_files(landing_files(spark, str(landing)), ledger, "p", T0)
    (landing / "new 1%.csv").write_text("x,y\n")
    rows, files = read_unseen(spark, str(landing), ledger, "csv")
    assert [tuple(r) for r in rows.collect()] == [("x", "y")] and files.count() == 1


def test_a_broken_ledger_raises(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.txt").write_text("x\n")
    ledger = tmp_path / "ledger"
    ledger.mkdir()
    (ledger / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_unseen(spark, str(tmp_path / "landing"), str(ledger), "text")


def test_a_reader_finds_the_table_at_any_time(spark, tmp_path):
    """Fifty publishes under a reader that looks the table up all the time."""
    ensure_environment(spark, str(tmp_path / "lake"))
    df = spark.range(5).withColumn("processed_date", F.lit("2024-01-01").cast("date"))
    versions = [(str(tmp_path / "layer_a" / f"v={n}"), df.limit(n)) for n in (5, 3)]
    for path, rows in versions:
        write_version(rows, path)
    tables.publish_version(spark, "bronze.layer_a", versions[0][0], schema=df.schema)
    stop, seen, missed = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                seen.append(spark.table("bronze.layer_a").count())
            except Exception as e:  # noqa: BLE001
                missed.append(str(e)[:200])

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(50):
        tables.publish_version(spark, "bronze.layer_a", versions[(i + 1) % 2][0], schema=df.schema)
    stop.set()
    reader.join()
    assert not missed and len(seen) > 10 and set(seen) == {3, 5}
    assert spark.table("bronze.layer_a").schema["processed_date"].dataType.simpleString() == "date"


def test_publish_with_other_columns_or_no_rows(spark, tmp_path):
    ensure_environment(spark, str(tmp_path / "lake"))
    day = F.lit("2024-01-01").cast("date")
    path = str(tmp_path / "layer_s")
    write_layer(spark.range(5).withColumn("processed_date", day), "bronze.layer_s", path)
    wider = spark.range(4).withColumn("name", F.lit("x")).withColumn("processed_date", day)
    write_layer(wider, "bronze.layer_s", path)
    assert spark.table("bronze.layer_s").columns == ["id", "name", "processed_date"]
    write_layer(wider.filter("id < 0"), "bronze.layer_s", path)
    assert spark.table("bronze.layer_s").count() == 0
    write_layer(wider, "bronze.layer_s", path)
    assert spark.table("bronze.layer_s").filter("processed_date = DATE '2024-01-01'").count() == 4


def clustered_log(spark, tmp_path, name):
    table = fresh_log_table(spark, tmp_path, name)
    runs = spark.range(4000).select(
        F.timestamp_seconds(F.col("id")).alias("execution_time"),
        F.concat(F.lit("p"), (F.col("id") % 40).cast("string")).alias("pipeline_name"), F.lit("s").alias("step"),
        F.lit("OK").alias("status"), F.lit("").alias("error_message"), F.lit("/p").alias("processed_file_path"),
        F.lit(1.0).alias("time_elapsed"))
    runs.repartition(8).write.insertInto(table)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files of this little data
    try:
        assert compact_table(spark, table) == 4000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return table


def test_reads_of_one_pipeline_skip_the_row_groups_of_others(spark, tmp_path):
    table = clustered_log(spark, tmp_path, "logs_g")
    for cond in (F.col("pipeline_name") == "p7", F.col("pipeline_name").like("p7%")):
        one = spark.table(table).filter(cond)
        assert len(one.collect()) == 100
        scan = one._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().get("numOutputRows").get().value() < 2000
    assert latest_runs(spark.table(table), "p7").count() == 100


def test_purge_leaves_files_without_a_match(spark, tmp_path):
    table = clustered_log(spark, tmp_path, "logs_h")
    before = set(spark.table(table).inputFiles())
    assert purge_rows(spark, table, F.col("pipeline_name") == "p7") == 3900
    after = set(spark.table(table).inputFiles())
    assert len(before - after) <= 2 and len(before & after) >= len(before) - 2 >= 1
    assert spark.table(table).filter("pipeline_name = 'p7'").count() == 0 and spark.table(table).count() == 3900
    assert purge_rows(spark, table, "pipeline_name = 'p7'") == 3900
    assert set(spark.table(table).inputFiles()) == after  # no match: no file is written
