"""Profiles and flags on toy frames, and beside pandas."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rowsmith.operators import flags, profile
from rowsmith.operators import quantiles
from rowsmith.operators.quantiles import BINS, quantile_values
from rowsmith.plans import quality
from rowsmith.queries.views import orders_dirty


def toy(spark):
    rows = [
        (1, 1.0, "a", None),
        (1, 1.0, "a", None),
        (2, float("nan"), None, None),
        (2, None, None, None),
        (3, 5.0, "b", None),
    ]
    return spark.createDataFrame(rows, "i int, d double, t string, e double")


def by(df, key="column"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_nan_counts_as_missing_and_equals_null(spark):
    stats = profile.basic_stats(toy(spark), "toy").first()
    assert stats.missing_values_total == 2 + 2 + 5
    assert stats.duplicate_rows == 2
    assert math.isclose(stats.missing_percentage, 45.0)
    assert (stats.numeric_columns, stats.text_columns, stats.datetime_columns) == (3, 1, 0)


def test_empty_table_gives_no_ratio(spark):
    stats = profile.basic_stats(toy(spark).limit(0), "none").first()
    assert (stats.total_records, stats.duplicate_rows) == (0, 0)
    assert stats.missing_percentage is None and stats.duplicate_percentage is None
    assert profile.missing_by_column(toy(spark).limit(0), "none").count() == 0
    assert flags.column_flags(toy(spark).limit(0), "none").count() == 0
    assert profile.numeric_summary(toy(spark).limit(0), "none").count() == 0


def test_table_without_numbers_or_texts(spark):
    texts = spark.createDataFrame([("a",), ("b",)], "t string")
    assert flags.column_flags(texts, "t").count() == 0
    assert profile.numeric_summary(texts, "t").count() == 0
    assert profile.correlations(texts, "t").count() == 0
    numbers = spark.createDataFrame([(1,), (2,)], "n int")
    assert profile.top_values(numbers, "n").count() == 0
    assert profile.format_fit(numbers, "n").count() == 0


def test_all_null_column_has_no_uniqueness_flag(spark):
    found = flags.low_uniqueness(toy(spark), "toy")
    assert "e" not in by(found)


def test_distinct_counts_and_nulls(spark):
    counts = by(profile.distinct_counts(toy(spark), ["i", "d", "t", "e"]))
    assert counts["t"]["unique_count"] == 2 and counts["t"]["unique_with_null"] == 3
    assert counts["d"]["unique_count"] == 2 and counts["d"]["non_null"] == 3
    assert counts["e"]["unique_count"] == 0


def test_first_values_follow_the_key(spark):
    df = spark.createDataFrame([(k, f"v{k}" if k % 2 else None) for k in range(20, 0, -1)], "k int, t string")
    assert by(profile.first_values(df, ["t"], "k", 3))["t"]["sample_values"] == ["v1", "v3", "v5"]


def test_first_values_of_sparse_columns_and_shared_keys(spark, monkeypatch):
    """Columns filled late, seldom or never; keys that many rows share, null keys, few rows."""
    monkeypatch.setattr(profile, "HEAD", 20)
    rng = np.random.default_rng(14)
    rows = []
    for i in range(400):
        k = None if i % 100 == 7 else int(i // 30 if i < 90 else i)
        rows.append((k, f"a{rng.integers(99)}", f"b{i}" if i > 300 else None, f"c{i}" if i in (3, 380, 390) else None, None, int(rng.integers(99))))
    df = spark.createDataFrame(rows, "k int, a string, b string, c string, d string, e int").repartition(6)
    for frame, some in ((df, rows), (df.filter("k > 385"), [r for r in rows if r[0] is not None and r[0] > 385])):
        found = {r.column: r.sample_values for r in profile.first_values(frame, list("abcde"), "k", 5).collect()}
        for at, c in enumerate("abcde", 1):
            known = sorted((r[0] is not None, r[0] or 0, str(r[at])) for r in some if r[at] is not None)
            assert found.get(c, []) == [v for _, _, v in known[:5]], c
    assert profile.first_values(df.limit(0), ["a"], "k").count() == 0


def test_skewness_of_constant_and_short_columns(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, None)], "c double, s double")
    rows = by(profile.numeric_summary(df, "x"))
    assert rows["c"]["skewness"] == 0.0
    assert rows["s"]["skewness"] is None


def test_column_names_with_dots_and_quotes(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], ["a.b", "it's"])
    assert set(by(profile.missing_counts(df, "n"))) == {"a.b", "it's"}
    assert by(profile.missing_by_column(df, "n"))["it's"]["missing_count"] == 1
    assert profile.describe(df, "n").count() == 2


def test_profile_equals_pandas(spark, small):
    df = orders_dirty(spark, small)
    pdf = df.toPandas()
    price = pdf["o_totalprice"]
    stats = profile.basic_stats(df, "o").first()
    assert stats.missing_values_total == int(pdf.isnull().sum().sum())
    assert stats.duplicate_rows == int(pdf.duplicated().sum())
    row = by(profile.numeric_summary(df, "o"))["o_totalprice"]
    for name, value in {
        "mean_value": price.mean(),
        "std_value": price.std(),
        "skewness": price.skew(),
        "min_value": price.min(),
        "max_value": price.max(),
    }.items():
        assert row[name] == pytest.approx(value, rel=1e-9)
    described = by(profile.describe(df, "o"))
    for q, value in price.quantile([0.25, 0.5, 0.75]).items():
        assert described["o_totalprice"][f"q{int(q * 100)}"] == pytest.approx(value, rel=1e-12)
    top = pdf["o_orderpriority"].value_counts()
    assert described["o_orderpriority"]["freq"] == int(top.iloc[0])
    q1, q3 = price.quantile(0.25), price.quantile(0.75)
    outside = price[(price < q1 - 1.5 * (q3 - q1)) | (price > q3 + 1.5 * (q3 - q1))]
    counted = by(flags.outlier_counts(df, "o"))["o_totalprice"]
    assert counted["outliers"] == len(outside)
    assert flags.outlier_rows(df, "o_totalprice").count() == len(outside)


@pytest.mark.parametrize(
    "values",
    [
        [3.0],
        [1.0, 2.0],
        [7.0] * 50,
        list(range(1000)),
        [0.0] * 900 + [1e12, -1e12, 5.5],
        [1.6e9 + i for i in range(5000)] + [0.0, 1e300, -1e300],
        [1.0, math.nextafter(1.0, 2.0), math.nextafter(math.nextafter(1.0, 2.0), 2.0)] * 7,
    ],
)
def test_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame(pd.DataFrame({"v": values})).withColumn("n", F.lit(None).cast("double"))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = quantile_values(df, ["v", "n"], probs)
    assert found["n"] == (0, [None] * len(probs))
    assert found["v"][0] == len(values)
    assert found["v"][1] == pytest.approx(list(np.quantile(np.array(values, dtype=float), probs)), rel=1e-12)


@pytest.mark.parametrize(("name", "value"), [("SPREAD", -200), ("AT_ONCE", 3), ("ACCURACY", 20)])
def test_quantiles_where_sketches_miss_or_much_lies_between(spark, monkeypatch, name, value):
    monkeypatch.setattr(quantiles, name, value)
    rng = np.random.default_rng(4)
    tables = {"v": rng.normal(0, 5, 3000), "w": rng.integers(0, 40, 3000).astype(float), "x": rng.pareto(0.4, 3000)}
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = quantile_values(spark.createDataFrame(pd.DataFrame(tables)).repartition(5), list(tables), probs)
    for c, values in tables.items():
        assert found[c] == (3000, pytest.approx(list(np.quantile(values, probs)), rel=1e-12))


@pytest.mark.parametrize("coarse", [64, 2])
def test_quantiles_of_groups(spark, monkeypatch, coarse):
    """A group with a third of all rows, many of few rows, a null group, groups without values, ties and infinities."""
    monkeypatch.setattr(quantiles, "COARSE", coarse)
    monkeypatch.setattr(quantiles, "BUCKETS", coarse * coarse)
    rng = np.random.default_rng(6)
    rows = [(0, "hot", float(v)) for v in rng.lognormal(0, 3, 3000)] + [(0, None, float(v)) for v in rng.integers(-3, 3, 500)]
    rows += [(int(i), "few", float(v)) for i, v in zip(rng.integers(0, 900, 5500), rng.normal(0, 1, 5500), strict=True)]
    rows += [(None, "hot", 1.0), (None, "hot", math.inf), (None, "hot", -math.inf), (5, "none", None), (6, "none", math.nan)]
    groups = {}
    for k, g, v in rows:
        if v is not None and not math.isnan(v):
            groups.setdefault((k, g), []).append(v)
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    df = spark.createDataFrame(rows, "k int, g string, v double").repartition(6)
    found = {(r.k, r.g): (r.non_null, r.quantiles) for r in quantiles.group_quantiles(df, "v", ["k", "g"], probs).collect()}
    assert set(found) == set(groups)
    for key, values in groups.items():
        if math.inf not in values:
            assert found[key] == (len(values), pytest.approx(list(np.quantile(values, probs)), rel=1e-12)), key
    assert found[None, "hot"][1][2] == 1.0
    assert quantiles.group_quantiles(df.limit(0), "v", ["k"], probs).count() == 0


def test_quantiles_beside_infinities(spark):
    values = [-math.inf, -1.0, 0.0, 1.0, 2.0, 3.0, math.inf]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert quantile_values(df, ["v"], [0.5])["v"] == (7, [1.0])


def test_quantiles_of_random_skewed_values(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.lognormal(0, 3, 20_000), np.full(10_000, 2.0), -rng.pareto(0.5, 5_000)])
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(7)
    probs = [0.01, 0.25, 0.5, 0.75, 0.999]
    found = quantile_values(df, ["v"], probs)["v"][1]
    assert found == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)
    assert len(values) > BINS * 4


def test_profile_does_not_depend_on_row_order(spark, small):
    df = orders_dirty(spark, small)
    mixed = df.orderBy(F.md5(F.col("o_orderkey").cast("string"))).repartition(5)
    for fn in (profile.basic_stats, profile.missing_by_column, profile.top_values, flags.problem_list):
        assert sorted(map(str, fn(df, "o").collect())) == sorted(map(str, fn(mixed, "o").collect()))


def test_top_values_pass_on_few_rows_per_task(spark, small):
    plan = profile.top_values(orders_dirty(spark, small), "o")._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_a_failing_and_an_empty_table_do_not_end_the_report(spark):
    good = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, t string")
    bad = spark.range(3).select(F.raise_error(F.lit("broken")).cast("int").alias("v"))
    rows = {r.dataset_name: r for r in quality.quality_report({"good": good, "none": good.limit(0), "bad": bad}).collect()}
    assert rows["good"].quality_score is not None and rows["good"].duplicate_percentage > 33 and rows["good"].score_reason is None
    assert rows["none"].quality_score is None and rows["none"].risk_level is None and rows["none"].score_reason == "no rows"
    assert rows["bad"].quality_score is None and rows["bad"].score_reason.startswith("error: ")


def test_digest_tells_null_from_value_and_place(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, "a"), ("a", "a")], "x string, y string")
    assert profile.basic_stats(df, "t").first().duplicate_rows == 1


def plain_correlation(x, y):
    both = ~(np.isnan(x) | np.isnan(y))
    x, y = x[both], y[both]
    if len(x) < 2 or (x == x[0]).all() or (y == y[0]).all() or np.isinf([*x, *y]).any():
        return None
    return float(np.corrcoef(x, y)[0, 1])


@pytest.mark.parametrize("tile", [256, 7])
def test_correlations_of_a_hundred_columns(spark, monkeypatch, tile):
    """Pairwise nulls, far-off means, constant and empty columns, infinities."""
    monkeypatch.setattr(profile, "TILE", tile)
    monkeypatch.setattr(profile, "CELLS", 4000)
    rng = np.random.default_rng(12)
    base = rng.normal(0, 1, (900, 5))
    data = {}
    for i in range(100):
        values = base @ rng.normal(0, 1, 5) + rng.normal(0, 1, 900) * (i % 4) + (1e9 if i % 10 == 3 else 0)
        data[f"c{i}"] = np.where(rng.random(900) < 0.3 * (i % 3), np.nan, values)
    data |= {"constant": np.full(900, 0.1), "none": np.full(900, np.nan), "odd": np.where(np.arange(900) == 5, np.inf, base[:, 0])}
    data["half"] = np.where(np.arange(900) < 450, np.nan, np.where(np.arange(900) < 900, 7.25, 0))
    names = list(data)
    found = profile.correlations(spark.createDataFrame(pd.DataFrame(data)).repartition(5), "wide").collect()
    assert len(found) == len(names) * (len(names) - 1) // 2
    for r in found:
        want = plain_correlation(data[r.column_a], data[r.column_b])
        assert r.correlation == (want if want is None else pytest.approx(want, abs=1e-6 if "3" in r.column_a + r.column_b else 1e-9)), r
    plan = profile.correlations(spark.range(2).selectExpr(*[f"id + {i} AS c{i}" for i in range(20)]), "t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == -(-20 // tile)


def test_gaps_of_minutes_over_years(spark):
    rng = np.random.default_rng(13)
    minutes = sorted({*rng.integers(0, 60 * 24 * 365 * 4, 4000).tolist(), *range(100_000, 103_000), 60 * 24 * 365 * 9})
    rows = spark.createDataFrame([(m,) for m in minutes], "m bigint").selectExpr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, m, 0) AS at", "m")
    found = profile.temporal_profile(rows.unionByName(rows.limit(3)), "t", "at", "minute").orderBy("bucket")
    windows = [line for line in found._jdf.queryExecution().sparkPlan().toString().split("\n") if "Window [" in line]
    assert len(windows) == 1 and "range" in windows[0].rsplit("], [", 2)[1]
    days = [m // 1440 for m in minutes]
    assert [r.gap_days for r in found.collect()] == [None, *[b - a for a, b in zip(days, days[1:], strict=False)]]
    early = spark.sql("SELECT timestamp_ntz'1960-02-01 00:00:00' AS at UNION ALL SELECT timestamp_ntz'1969-12-31 00:00:00'")
    assert [r.gap_days for r in profile.temporal_profile(early, "t", "at").orderBy("bucket").collect()] == [None, 3621]
    assert profile.temporal_profile(rows.limit(0), "t", "at").count() == 0
