import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidelog.plans.pipeline import landing_to_bronze
from tidelog.plans.spec import PipelineSpec
from tidelog.plans.tables import ensure_environment
from tidelog.sources.landing import csv_schema, csv_width, read_ragged
from tidelog.sources.ledger import read_unseen, record_files

T0 = dt.datetime(2024, 3, 1, 10, 0, 0)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.csv").write_text("1,2\n\n3,4\n" * 50)  # the largest file is a narrow one
    (folder / "b.csv").write_text('x\n"p,q",r,s\n')
    return folder


def test_no_column_of_a_wider_file_is_lost(spark, landing):
    df = read_ragged(spark, str(landing), misfits="misfit")
    assert df.columns == ["_c0", "_c1", "_c2", "misfit"]
    rows = {tuple(r) for r in df.collect()}
    assert rows == {("1", "2", None, "1,2"), ("3", "4", None, "3,4"), ("x", None, None, "x"), ("p,q", "r", "s", None)}
    assert df.count() == 102 and read_ragged(spark, str(landing)).columns == ["_c0", "_c1", "_c2"]


def test_once_only_and_whole_loads_keep_wide_lines(spark, landing, tmp_path):
    ledger = str(tmp_path / "ledger")
    rows, files = read_unseen(spark, str(landing), ledger, "csv")
    assert {tuple(r) for r in rows.collect()} >= {("p,q", "r", "s"), ("1", "2", None)} and rows.count() == 102
    record_files(files, ledger, "p", T0)
    (landing / "c.csv").write_text("only\n")  # seen files do not count for the columns
    rows, _ = read_unseen(spark, str(landing), ledger, "csv")
    assert [tuple(r) for r in rows.collect()] == [("only",)]

    ensure_environment(spark, str(tmp_path / "lake"))
    spec = PipelineSpec(pipeline_name="ragged", file_name="*.csv", landing_path=str(landing),
                        base_path=str(tmp_path / "lake"), table_name_bronze="b_ragged", table_name_silver="s_ragged",
                        table_name_gold="g_ragged", sql_silver="SELECT 1 AS a", sql_gold="SELECT 1 AS a")
    landing_to_bronze(spark, spec, T0)
    assert spark.table("bronze.b_ragged").columns == ["_c0", "_c1", "_c2", "processed_timestamp", "processed_date"]
    assert spark.table("bronze.b_ragged").filter("_c2 = 's'").count() == 1


def test_widths_are_those_of_the_csv_reader(spark, tmp_path):
    """The reader flags a line that has another number of fields than the schema."""
    rng = random.Random(5)
    lines = sorted({"".join(rng.choice('ab,,""\\ ') for _ in range(rng.randrange(1, 14))) for _ in range(400)})
    lines = [x for x in lines if x.strip()]
    lines += ['1.2.3.4 - - [x] "GET /a,b HTTP/1.1" 200', '"a ""b"", c",d', '"unclosed,x', 'é,"ü,",', ","]
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    widths = {r.value: r.n for r in frame.select("value", csv_width(F.col("value")).alias("n")).collect()}
    def unfit(own, n):
        path = str(tmp_path / f"w{n}-{len(list(tmp_path.iterdir()))}")
        spark.createDataFrame([(x,) for x in own], "value string").coalesce(1).write.text(path)
        names = ", ".join(f"_c{i} string" for i in range(n))
        read = spark.read.schema(f"{names}, bad string").option("columnNameOfCorruptRecord", "bad").csv(path)
        return [r.bad for r in read.collect() if r.bad is not None]

    for n in sorted(set(widths.values())):
        odd = unfit([x for x in lines if widths[x] == n], n)
        assert all('"\\' in x for x in odd), odd[:10]  # a backslash right behind a closing quote
        for fewer in range(n - 1, 0, -1):  # such a line is narrower than was thought, never wider
            odd = odd and unfit(odd, fewer)
        assert not odd


def test_no_lines_give_one_column(spark):
    assert csv_schema(spark.createDataFrame([("",), ("  ",)], "value string")).names == ["_c0"]
