"""Files: typed CSV, folders, catalog, documents."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rowsmith.operators import issues
from rowsmith.plans import quality
from rowsmith.sources import documents, shared, tables


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_types(spark, tmp_path):
    path = write(
        tmp_path / "t.csv",
        'i,b,d,x,n,t,s\n1,True,2024-01-02,,NA,"a ""q"", b",2024-01-02 03:04:05\n,,2024-02-03,,1.5,"two\nlines",\n3,false,,,2,null,\n',
    )
    df = tables.read_table(spark, path, multi_line=True)
    assert dict(df.dtypes) == {
        "i": "bigint", "b": "boolean", "d": "date", "x": "double", "n": "double", "t": "string", "s": "timestamp_ntz",
    }
    rows = df.collect()
    assert [r.i for r in rows] == [1, None, 3] and [r.n for r in rows] == [None, 1.5, 2.0]
    assert [r.t for r in rows] == ['a "q", b', "two\nlines", None]
    forced = tables.read_table(spark, path, types={"i": "string", "n": "int"}, multi_line=True)
    assert [r.i for r in forced.collect()] == ["1", None, "3"]


def test_whole_numbers_keep_all_digits(spark, tmp_path):
    ends = [-(2**63), 2**63 - 1, 1234567890123456789, 1234567890123456788]
    lines = "".join(f"{n},{n}{i},{'9' * 38}\n" for i, n in enumerate(ends))
    df = tables.read_table(spark, write(tmp_path / "n.csv", "i,j,k\n" + lines))
    assert df.dtypes == [("i", "bigint"), ("j", "decimal(38,0)"), ("k", "decimal(38,0)")]
    assert sorted(r.i for r in df.collect()) == sorted(ends)
    assert sorted(int(r.j) for r in df.collect()) == sorted(int(f"{n}{i}") for i, n in enumerate(ends))


def test_missing_file_and_folder(spark, tmp_path):
    assert tables.read_table(spark, str(tmp_path / "no.csv")) is None
    assert tables.load_tables(spark, str(tmp_path / "no")) == {}


def test_folder_of_tables(spark, tmp_path):
    write(tmp_path / "a.csv", "x,y\n1,2\n")
    write(tmp_path / "empty.csv", "x,y\n")
    write(tmp_path / "note.txt", "no table")
    tables.write_table(spark.range(5).withColumn("t", F.lit(" pad ")), str(tmp_path / "b.csv"))
    loaded = tables.load_tables(spark, str(tmp_path))
    assert sorted(loaded) == ["a", "b"]
    assert {r.t for r in loaded["b"].collect()} == {" pad "} and loaded["b"].count() == 5


def test_catalog_and_preview(spark, tmp_path):
    path = str(tmp_path / "p")
    tables.write_table(spark.range(100), path, "parquet")
    row = tables.catalog_row(spark.read.parquet(path), "p").first()
    assert (row.row_count, row.column_count) == (100, 1) and row.size_kb > 0
    assert [r.id for r in tables.preview(spark.read.parquet(path), 3, "id").collect()] == [0, 1, 2]


def test_reports_and_contexts(spark, tmp_path):
    write(tmp_path / "a.json", '{"user_context": {"original_query": "q"}, "available_datasets": [{"name": "n", "quality_score": 0.5}]}')
    write(tmp_path / "b.json", '{"user_context": {"domain": "d"}, "available_datasets": [{"name": "m", "data_quality_score": 0.7}]}')
    write(tmp_path / "c.json", "{bad")
    write(tmp_path / "d.txt", "other")
    read = documents.read_reports(spark, str(tmp_path))
    assert sorted(r.report_id for r in read.collect()) == ["a.json", "b.json", "c.json"]
    rows = {r.report_id: r for r in documents.read_contexts(read).collect()}
    assert rows["a.json"].quality_score == 0.5 and rows["a.json"].domain == "general"
    assert rows["b.json"].quality_score == 0.7 and "c.json" not in rows


def test_shared_folder_comes_from_the_session(spark):
    assert shared.shared_folder(spark) == (spark.conf.get(shared.SETTING, None) or spark.sparkContext.getCheckpointDir())
    assert shared.new_path(spark, "x") != shared.new_path(spark, "x")
    assert sorted(r.id for r in shared.settled(spark.range(3)).collect()) == [0, 1, 2]


def stats(spark, **values):
    row = {"dataset_name": "d", "total_records": 1000, "missing_percentage": 0.0, "duplicate_percentage": 0.0, "duplicate_rows": 0}
    return spark.createDataFrame([{**row, **values}])


def issue_rows(spark, *severities, share=100.0):
    rows = [("d", f"c{i}", s, "general", "x", share, 10, "fix", 2, ["v"]) for i, s in enumerate(severities)]
    return spark.createDataFrame(
        rows,
        "dataset_name string, column string, severity string, category string, description string,"
        " percentage_affected double, affected_records long, recommendation string, fix_priority long,"
        " example_values array<string>",
    )


def score(found, figures, **more):
    return issues.quality_scores(found, figures, **more).first().quality_score


def test_scores(spark):
    assert score(issue_rows(spark, "critical", "low", "odd"), stats(spark)) == 100 - 20 - 2 - 5
    assert score(issue_rows(spark), stats(spark, missing_percentage=30.0, duplicate_percentage=15.0)) == 100 - 10 - 3
    assert score(issue_rows(spark, *["critical"] * 9), stats(spark)) == 0
    external = spark.createDataFrame([("d", 50.0)], "dataset_name string, external_score double")
    assert score(issue_rows(spark), stats(spark), external=external) == 80


def test_risk_levels(spark):
    def risk(*severities):
        return issues.risk_levels(issue_rows(spark, *severities)).first().risk_level

    assert risk("critical") == "critical"
    assert risk(*["high"] * 3) == "high" and risk(*["high"] * 2) == "low"
    assert risk(*["medium"] * 6) == "medium" and risk(*["medium"] * 5) == "low"
    assert issues.severity_counts(issue_rows(spark, "odd")).first().other_issues == 1


def test_issue_answers(spark):
    answers = spark.createDataFrame([(1, 'x [{"severity": "high", "estimated_affected_percentage": 12.39, "priority": 1}, {}] y')], "id int, response string")
    rows = issues.parse_issues(answers, total_records=100).orderBy("position").collect()
    assert (rows[0].affected_records, rows[0].fix_priority) == (12, 1)
    assert (rows[1].severity, rows[1].category, rows[1].fix_priority, rows[1].affected_records) == ("medium", "general", 3, 0)


def test_score_stays_in_range(spark, small):
    from rowsmith.queries.issues import checked_tables

    for r in quality.quality_report(checked_tables(spark, small)).collect():
        assert 0 <= r.quality_score <= 100


def test_line_breaks_in_csv(spark, tmp_path):
    """Written in full with multi_line, refused without, and never turned into rows."""
    rows = [(1, "x\ny"), (2, "z"), (3, "a\r\nb"), (4, None)]
    df = spark.createDataFrame(rows, "k bigint, t string").coalesce(1)
    tables.write_table(df, str(tmp_path / "whole"), multi_line=True)
    back = tables.read_table(spark, str(tmp_path / "whole"), multi_line=True)
    assert sorted((r.k, r.t) for r in back.collect()) == [(1, "x\ny"), (2, "z"), (3, "a\r\nb"), (4, None)]
    with pytest.raises((Py4JJavaError, PySparkException), match="line break"):
        tables.write_table(df, str(tmp_path / "refused"))
    tables.write_table(df.filter("k IN (2, 4)"), str(tmp_path / "plain"))
    assert tables.read_table(spark, str(tmp_path / "plain")).count() == 2
    tables.write_table(df, str(tmp_path / "parquet"), "parquet")
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 4
