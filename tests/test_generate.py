"""Generation: repeatable, independent of partitions, by the naming rules."""

import re

from pyspark.sql import functions as F

from rowsmith.operators import generate

SPEC = [("patient_id", "id"), ("age", "int"), ("rate", "string"), ("day", "date"), ("sex", "categorical"), ("t", "string")]


def test_rows_do_not_depend_on_partitions(spark):
    one = generate.generate_rows(spark, 200, SPEC, seed=1, anchor="2024-01-01", partitions=1)
    many = generate.generate_rows(spark, 200, SPEC, seed=1, anchor="2024-01-01", partitions=9)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    other = generate.generate_rows(spark, 200, SPEC, seed=2, anchor="2024-01-01")
    assert sorted(map(tuple, one.collect())) != sorted(map(tuple, other.collect()))


def test_ranges_and_formats(spark):
    rows = generate.generate_rows(spark, 3000, SPEC, anchor="2024-01-01").collect()
    assert {r.patient_id for r in rows} == {f"PAT_{i:06d}" for i in range(1, 3001)}
    assert {r.age for r in rows} == set(range(18, 91))
    assert all(0 <= r.rate <= 100 and round(r.rate, 2) == r.rate for r in rows)
    assert min(r.day for r in rows) >= "2019-01-01" and max(r.day for r in rows) <= "2024-01-01"
    assert {r.sex for r in rows} == {"Male", "Female"}
    assert all(0 < len(r.t) <= 50 for r in rows)


def test_name_rules():
    assert generate.named("width", ["id"]) and not generate.named("width", ["id"], whole_parts=True)
    assert generate.named("customerId", ["id"], whole_parts=True)


def test_batches_fall_back_alone(spark):
    answers = spark.createDataFrame(
        [(0, '[{"id": "a", "x": "1"}]'), (1, "[broken"), (2, "nothing")], "batch long, response string"
    )
    rows = generate.parse_generated_rows(answers, "batch", [("id", "id"), ("x", "string"), ("gone", "int")], size=2)
    found = {(r.batch, r.position): r for r in rows.collect()}
    assert len(found) == 5
    assert (found[0, 0].id, found[0, 0].x, found[0, 0].source) == ("a", "1", "answer")
    assert found[0, 0].gone is None
    assert found[1, 1].id == "ID_000004" and found[1, 1].source == "rule"


def test_column_absent_everywhere_is_unknown(spark):
    answers = spark.createDataFrame([(0, '[{"id": "a"}, {"id": "b", "x": 2}]')], "batch long, response string")
    rows = generate.parse_generated_rows(answers, "batch", [("id", "id"), ("x", "int"), ("gone", "int")])
    assert [(r.id, r.x, r.gone) for r in rows.orderBy("position").collect()] == [("a", None, "Unknown"), ("b", "2", "Unknown")]


def test_sample_rows(spark):
    df = spark.createDataFrame([(1, ["id", "Name", "contact_email", "amount", "x"]), (2, [])], "k int, columns array<string>")
    rows = {r.k: r.sample_data for r in generate.sample_rows(df, "k", n=3, anchor="2024-01-01").collect()}
    assert rows[2] == [] and len(rows[1]) == 3
    assert re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", rows[1][0]["id"])
    assert re.fullmatch(r"[a-z]+\.[a-z]+@example\.com", rows[1][0]["contact_email"])
    assert re.fullmatch(r"\d+\.\d\d", rows[1][0]["amount"])
    assert rows[1][0] != rows[1][1]


def test_align_and_repeated_ids(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "id string, v int")
    assert generate.align_schema(df, ["v", "new"]).first().new == "Unknown"
    assert [tuple(r) for r in generate.repeated_ids(df, "id").collect()] == [("a", 2)]
    assert generate.generate_rows(spark, 5, [("id", "id")]).agg(F.count_distinct("id")).first()[0] == 5
