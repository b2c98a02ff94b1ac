import pytest

from tidelog.operators.quality import QualityGateError
from tidelog.plans.tables import ensure_environment
from tidelog.schemas import SILVER_LOG_SCHEMA
from tidelog.streaming.ingest import ingest_available, read_stream_silver, silver_available

LINE = '203.0.113.9 - - [07/Feb/2024:06:05:04 +0100] "PUT /cart HTTP/2.0" 204 17'


def test_available_now_ingest_consumes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.txt").write_text(LINE + "\n" + LINE + "\n")
    args = (str(landing), str(tmp_path / "bronze"), str(tmp_path / "ckpt"))
    ingest_available(spark, *args)
    ingest_available(spark, *args)  # nothing new: no duplicates
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 2
    (landing / "b.txt").write_text(LINE + "\n")
    ingest_available(spark, *args)
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 3


def gated(spark, tmp_path, landing, name="stream_p", checkpoint="ckpt", **kw):
    silver_available(spark, str(landing), str(tmp_path / "silver"), str(tmp_path / checkpoint), name,
                     "quality.quality_checks", **kw)


def rules(spark, name):
    return spark.table("quality.quality_checks").filter(f"pipeline_name = '{name}'").collect()


def test_gated_silver_stream(spark, tmp_path):
    ensure_environment(spark, str(tmp_path / "lake"))
    spark.table("quality.quality_checks").count()  # the caller's session has a file list of its own
    landing, silver = tmp_path / "landing", str(tmp_path / "silver")
    landing.mkdir()
    (landing / "a.txt").write_text(LINE + "\n")
    gated(spark, tmp_path, landing, silver_view="silver.stream_lines")
    out = read_stream_silver(spark, silver)
    assert out.first().endpoint == "/cart" and out.count() == 1
    assert out.columns == SILVER_LOG_SCHEMA.names == spark.table("silver.stream_lines").columns
    assert {r.verified_table for r in rules(spark, "stream_p")} == {"silver"} and len(rules(spark, "stream_p")) == 5
    (landing / "b.txt").write_text("garbage\n")
    with pytest.raises(Exception) as err:
        gated(spark, tmp_path, landing)
    assert "quality check failed" in str(err.value) or isinstance(err.value, QualityGateError)
    assert read_stream_silver(spark, silver).count() == 1
    assert "garbage" not in {r.client_ip for r in spark.read.parquet(silver).collect()}
    assert len(rules(spark, "stream_p")) == 10
    with pytest.raises(Exception):
        gated(spark, tmp_path, landing)  # the refused batch again: its rule rows are there
    assert len(rules(spark, "stream_p")) == 10


def test_replayed_batch_adds_nothing(spark, tmp_path):
    ensure_environment(spark, str(tmp_path / "lake"))
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.txt").write_text(LINE + "\n")
    gated(spark, tmp_path, landing, "stream_r")
    for f in (tmp_path / "ckpt" / "commits").iterdir():
        f.unlink()  # as if the driver had died before the batch was committed
    gated(spark, tmp_path, landing, "stream_r")
    assert read_stream_silver(spark, str(tmp_path / "silver")).count() == 1
    assert len(rules(spark, "stream_r")) == 5


def test_new_checkpoint_replaces_no_batch(spark, tmp_path):
    ensure_environment(spark, str(tmp_path / "lake"))
    first, second = tmp_path / "one", tmp_path / "two"
    for folder, n in ((first, 2), (second, 3)):
        folder.mkdir()
        for i in range(n):
            (folder / f"{i}.txt").write_text(LINE + "\n")
    gated(spark, tmp_path, first, "stream_c")
    gated(spark, tmp_path, second, "stream_c", checkpoint="other", max_files_per_trigger=1)
    assert read_stream_silver(spark, str(tmp_path / "silver")).count() == 5
    assert len(rules(spark, "stream_c")) == 20  # one batch, then three


def test_consumed_files_are_archived(spark, tmp_path):
    landing, archive = tmp_path / "landing", tmp_path / "processed"
    landing.mkdir()
    for i in range(3):
        (landing / f"part{i}.txt").write_text(LINE + "\n")
    args = (str(landing), str(tmp_path / "bronze"), str(tmp_path / "ckpt"))
    ingest_available(spark, *args, archive_dir=str(archive))
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 3
    # files of a batch are archived once the stream plans its next batch
    (landing / "part3.txt").write_text(LINE + "\n")
    ingest_available(spark, *args, archive_dir=str(archive))
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == 4
    import time
    deadline = time.time() + 20
    while time.time() < deadline and len(list(archive.rglob("*.txt"))) < 3:
        time.sleep(0.5)
    archived = sorted(p.name for p in archive.rglob("*.txt"))
    assert archived == ["part0.txt", "part1.txt", "part2.txt"]
    assert [p.name for p in landing.glob("*.txt")] == ["part3.txt"]
