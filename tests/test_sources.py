import pytest

from tidelog.sources.landing import UnsupportedFileType, landing_format, log_column, read_landing

LINE = '1.2.3.4 - - [10/Oct/2023:13:55:36 -0700] "GET /a HTTP/1.1" 200 5'


def test_reader_choice_by_extension():
    assert landing_format("log.txt") == "text" and landing_format("LOG.TXT") == "text"
    assert landing_format("data.csv") == "csv" and landing_format("DATA.Csv") == "csv"
    with pytest.raises(UnsupportedFileType):
        landing_format("teste.json")
    with pytest.raises(ValueError, match="empty"):
        landing_format("")


def test_log_column_is_case_sensitive():
    assert log_column("a.txt") == "value" and log_column("a.csv") == "_c0"
    with pytest.raises(UnsupportedFileType):
        log_column("a.TXT")


def test_text_keeps_blank_lines_csv_drops_them_and_cuts_at_commas(spark, tmp_path):
    path = tmp_path / "in.txt"
    path.write_text(LINE + "\n\n" + LINE.replace("/a", "/a,b") + "\n")
    text = [r.value for r in read_landing(spark, str(path), "text").collect()]
    assert text == [LINE, "", LINE.replace("/a", "/a,b")]
    csv = read_landing(spark, str(path), "csv")
    # the column count comes from the first line; the comma still cuts _c0
    assert csv.columns == ["_c0"]
    assert [r._c0 for r in csv.collect()] == [LINE, LINE.split("/a")[0] + "/a"]


def test_missing_landing_path(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nope.txt"):
        read_landing(spark, str(tmp_path / "nope.txt"), "text")


def test_parse_plan_does_not_depend_on_the_number_of_files(spark, tmp_path):
    from tidelog.functions.logparse import parse_access_log

    plans = []
    for n in (1, 40):
        path = str(tmp_path / f"lines{n}")
        spark.range(200).selectExpr("cast(id as string) AS value").repartition(n).write.text(path)
        plan = parse_access_log(read_landing(spark, path, "text"))._jdf.queryExecution().executedPlan()
        nodes = []
        while True:
            nodes.append(plan.nodeName())
            if plan.children().isEmpty():
                break
            plan = plan.children().head()
        plans.append(nodes)
    assert plans[0] == plans[1] and not any("Exchange" in n for n in plans[0])
