"""Several tables side by side, beside plain versions."""

import datetime
import math

import numpy as np
import pytest

from rowsmith.operators import collection, repair


def plain(tables, at_least):
    """Every column's values against every other's."""
    sets = {}
    for name, df in tables.items():
        for c in df.columns:
            kind = collection.value_kind(df, c)
            if kind:
                values = {r[0] for r in df.select(c).collect()}
                sets[name, c] = {(kind, 0.0 if v == 0 else v) for v in values if v is not None and not (isinstance(v, float) and math.isnan(v))}
    return sorted(
        (*a, *b, len(sets[a]), len(sets[a] & sets[b]), len(sets[a] & sets[b]) / len(sets[a]))
        for a in sets
        for b in sets
        if a[0] != b[0] and sets[a] & sets[b] and len(sets[a] & sets[b]) / len(sets[a]) >= at_least
    )


@pytest.mark.parametrize("sample", [1024, 60])
def test_no_pair_above_the_limit_is_left_out(spark, monkeypatch, sample):
    """Columns with shares around the limit, small ones inside large ones, hot values, nulls, and few sampled values."""
    monkeypatch.setattr(collection, "SAMPLE", sample)
    rng = np.random.default_rng(11)
    big = list(range(6000))
    tables = {}
    for n in range(3):
        rows = []
        shares = [rng.uniform(0.35, 0.65) for _ in range(4)]
        for i in range(4000):
            inside = [big[(i * 7 + n) % 6000] if rng.random() < s else 10**6 * (n + 1) + i for s in shares]
            rows.append((*inside, i % 40, None if i % 3 else f"v{i % 900}", [0.0, -0.0, float("nan"), i / 8][i % 4], datetime.datetime(2020, 1, 1 + i % 20)))
        tables[f"t{n}"] = spark.createDataFrame(rows, "a bigint, b int, c bigint, d bigint, few smallint, txt string, x double, at timestamp_ntz")
    tables["t9"] = spark.range(6000).selectExpr("id", "concat('v', id) AS name", "array(id) AS list", "NULL AS none", "CAST(NULL AS STRING) AS nothing")
    found = collection.join_candidates(tables, at_least=0.5)
    assert sorted(map(tuple, found.collect())) == plain(tables, 0.5)


def test_no_candidates(spark):
    tables = {"a": spark.range(5).toDF("x"), "b": spark.range(5).selectExpr("id + 100 AS y"), "c": spark.range(0).toDF("z")}
    found = collection.join_candidates(tables)
    assert found.count() == 0 and found.columns[:4] == ["dataset_a", "column_a", "dataset_b", "column_b"]


def test_conflicts_and_changes_without_sorting(spark):
    """Types that differ, nulls, NaN and signed zeros, repeated keys, null keys."""
    left = spark.createDataFrame(
        [(1, 1, 0.0, "a"), (2, 2, 1.5, None), (2, 2, 1.5, None), (3, 3, float("nan"), "c"), (4, None, 2.0, "d"), (None, 9, 1.0, "n"), (7, 1, 1.0, "x")],
        "k int, n int, d double, t string",
    )
    right = spark.createDataFrame(
        [(1, 1, -0.0, "a"), (2, 2, 1.5, ""), (3, 4, None, "c"), (4, None, 2.0, "d"), (4, 5, 2.0, "d"), (None, 9, 1.0, "n"), (8, 1, 1.0, "x")],
        "k int, n bigint, d double, t string",
    )
    found = collection.value_conflicts(left, right, ["k"])
    assert {r.column: (r.shared_keys, r.conflicts) for r in found.collect()} == {"n": (4, 2), "d": (4, 0), "t": (4, 1)}
    changes = repair.cell_changes(left, right, ["k"])
    want = {"n": (7, 1, 1, 1), "d": (7, 1, 1, 0), "t": (7, 1, 1, 2)}
    assert {r.column: (r.rows_compared, r.rows_gone, r.rows_unclear, r.changed) for r in changes.collect()} == want
    for frame in (found, changes):
        assert "SortAggregate" not in frame._jdf.queryExecution().executedPlan().toString()
    assert collection.value_conflicts(left.limit(0), right, ["k"]).first().shared_keys == 0
