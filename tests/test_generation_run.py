"""Generation runs: odd specifications, ranges of keys, alignment."""

import json
import re

from pyspark.sql import functions as F

from rowsmith.plans import generation
from rowsmith.sources.shared import new_path


def answer(spec):
    return f"Sure (see below) {json.dumps(spec)} done"


def columns(*names, **details):
    return {"columns": list(names), "column_details": details}


ANSWERS = [
    ("a", answer({"dataset_name": "one", "row_count": 25} | columns("id", "age", "amount", "kind", "seen", age={"type": "int", "value_range": "40-30"}, amount={"type": "float", "value_range": "0.25 and 0.75"}, kind={"type": "categorical", "value_range": '["x", "y"]'}, seen={"type": "int", "value_range": "any"}))),
    ("b", answer({"dataset_name": "odd/name: 1", "row_count": -3, "columns": ["id"]})),
    ("c", answer({"row_count": 7.9, "columns": ["user_id", "user_id", None, "text"]})),
    ("d", "nothing here"),
    ("e", None),
    ("f", answer({"dataset_name": "flat", "row_count": 3, "columns": []})),
]


def test_run(spark, monkeypatch):
    monkeypatch.setattr(generation, "RANGE", 10)
    answers = spark.createDataFrame([(i, r, ["id", "value"]) for i, r in ANSWERS], "answer_id string, response string, expected_columns array<string>")
    path = new_path(spark, "run")
    specs, rows, manifest = generation.generation_run(answers, "answer_id", path, seed=3, anchor="2024-01-01")
    sizes = {r.dataset: r.n for r in rows.groupBy("dataset").agg(F.count("*").alias("n")).collect()}
    assert sizes == {"a-one": 25, "c-SyntheticDataset": 7, "d-SyntheticDataset": 50, "e-SyntheticDataset": 50, "f-flat": 3}
    found = {r.file_path.split("dataset=")[1]: r for r in manifest.collect()}
    assert (found["a-one"].row_count, found["a-one"].asked_rows, found["a-one"].repeated_ids) == (25, 25, 0)
    assert found["b-odd/name: 1"].row_count == 0 and found["c-SyntheticDataset"].columns == ["user_id", "text"]
    one = {r.row_no: r.row for r in rows.filter("dataset = 'a-one'").collect()}
    assert sorted(one) == list(range(25)) and one[24]["id"] == "ID_000025"
    assert all(30 <= int(r["age"]) <= 40 and 0.25 <= float(r["amount"]) <= 0.75 and r["kind"] in "xy" and 0 <= int(r["seen"]) <= 100 for r in one.values())
    assert len({r["age"] for r in one.values()}) > 5
    again = generation.generated(specs.repartition(7), 3, "2024-01-01")
    assert {(r.dataset, r.row_no): r.row for r in again.filter("dataset = 'a-one'").collect()} == {("a-one", k): v for k, v in one.items()}
    texts = {r.row["value"] for r in rows.filter("dataset = 'd-SyntheticDataset'").collect()}
    assert len(texts) == 50 and all(re.fullmatch(r"[A-Z][a-z ]{5,49}", t) for t in texts)


def test_alignment_and_repeated_ids(spark):
    rows = spark.createDataFrame([("t", 0, {"id": "1", "x": "a"}), ("t", 1, {"id": "1"}), ("u", 0, {"x": "b"})], generation.WRITTEN.replace("row_no bigint, row map<string,string>, dataset string", "dataset string, row_no bigint, row map<string,string>"))
    wanted = spark.createDataFrame([("t", ["x", "id", "no"]), ("u", ["id"])], "dataset string, columns array<string>")
    cells = {(r.dataset, r.row_no, r.position): (r.column, r.value) for r in generation.aligned(rows, wanted).collect()}
    assert cells == {
        ("t", 0, 0): ("x", "a"),
        ("t", 0, 1): ("id", "1"),
        ("t", 0, 2): ("no", "Unknown"),
        ("t", 1, 0): ("x", None),
        ("t", 1, 1): ("id", "1"),
        ("t", 1, 2): ("no", "Unknown"),
        ("u", 0, 0): ("id", "Unknown"),
    }
    fields = "array<struct<column:string, type:string>>"
    specs = spark.createDataFrame([("t", "t", "", 2, [("id", "string"), ("x", "string")])], f"dataset string, name string, description string, row_count bigint, fields {fields}")
    assert generation.manifest(specs, rows.filter("dataset = 't'"), "/p/").first().repeated_ids == 1
