"""Profiling: one table in, profile rows out.

Every function takes the table and the name it is reported under. Whole-table figures come from one
aggregate; distinct counts, top values and modes share one group-by over (column, value), whose map-side
combine absorbs hot values.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.functions.columns import (
    FRACTIONAL,
    TEMPORAL,
    WHOLE,
    col,
    columns_of,
    column_figures,
    control_table,
    is_missing,
    known,
    percentage,
    quoted,
    type_class,
)
from rowsmith.operators.quantiles import quantile_columns
from rowsmith.sources.shared import settled

# Texts that count as a number or as an ISO date or timestamp.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
NUMBER_FIGURES = {"min_value": "min({v})", "max_value": "max({v})", "mean_value": "avg({v})"}
FINITE_MEAN = "avg(CASE WHEN abs({v}) < double('Infinity') THEN {v} END)"
DATE_PATTERN = r"^\s*[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])([ T][0-9:.]+)?\s*$"


def basic_stats(df: DataFrame, name: str) -> DataFrame:
    """Row and column counts, missing cells, duplicate rows, columns per type class.

    Rows are merged by a 128-bit digest of their cells (null equals null, NaN counts as null), so all figures come
    from one scan and one shuffle of a few numbers per different row, however long its texts are.
    """
    classes = [type_class(f.dataType) for f in df.schema.fields]
    width = len(df.columns)
    cells = [known(df, c) for c in df.columns]
    missing = reduce(lambda a, b: a + b, [c.isNull().cast("int") for c in cells])
    # A null leaves a hash as it is, so each cell is followed by whether it is null.
    marked = [part for c in cells for part in (c, c.isNull())]
    digests = [F.xxhash64(F.lit(salt), *marked).alias(f"d_{salt}") for salt in (1, 2)]
    rows = df.select(*digests, missing.alias("missing"))
    groups = rows.groupBy("d_1", "d_2").agg(F.count(F.lit(1)).alias("copies"), F.sum("missing").alias("missing"))
    totals = groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("total_records"),
        F.coalesce(F.sum("missing"), F.lit(0)).cast("bigint").alias("missing_values_total"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
    )
    total = F.col("total_records")
    return totals.select(
        F.lit(name).alias("dataset_name"),
        "total_records",
        F.lit(width).cast("bigint").alias("total_columns"),
        "missing_values_total",
        percentage(F.col("missing_values_total"), total * width).alias("missing_percentage"),
        "duplicate_rows",
        percentage(F.col("duplicate_rows"), total).alias("duplicate_percentage"),
        *[
            F.lit(classes.count(c)).cast("bigint").alias(f"{c}_columns")
            for c in ("numeric", "text", "datetime")
        ],
    )


def column_types(df: DataFrame, name: str) -> DataFrame:
    """Schema rows: column, ordinal, type, type class. Reads no data."""
    rows = [
        (name, f.name, i, f.dataType.simpleString(), type_class(f.dataType)) for i, f in enumerate(df.schema.fields)
    ]
    return control_table(
        df.sparkSession,
        rows,
        dataset_name=pa.string(),
        column=pa.string(),
        ordinal=pa.int32(),
        data_type=pa.string(),
        type_class=pa.string(),
    )


def missing_counts(df: DataFrame, name: str) -> DataFrame:
    """Missing cells per column, zero included, with the row count."""
    return column_figures(df, df.columns, {"missing_count": "count_if({v} IS NULL)"}).select(
        F.lit(name).alias("dataset_name"),
        "column",
        "total_records",
        "missing_count",
        percentage(F.col("missing_count"), F.col("total_records")).alias("missing_percentage"),
    )


def missing_by_column(df: DataFrame, name: str) -> DataFrame:
    """Count and percentage of missing values, only for columns that have any."""
    return missing_counts(df, name).filter("missing_count > 0").drop("total_records")


def native_counts(df: DataFrame, columns: list[str]) -> list[DataFrame]:
    """Counts per (column, value), one frame per kind of value.

    Grouping whole numbers as bigint and fractions as double is several times cheaper than grouping their
    texts; the map-side combine leaves one row per distinct value and task.
    """
    kinds: dict[str, list[str]] = {}
    for c in columns:
        data_type = df.schema[c].dataType
        if isinstance(data_type, WHOLE):
            kind = "bigint"
        elif isinstance(data_type, FRACTIONAL):
            kind = "double"
        elif isinstance(data_type, TEMPORAL):
            kind = data_type.simpleString()
        else:
            kind = "string"
        kinds.setdefault(kind, []).append(c)
    parts = []
    for kind, names in kinds.items():
        values = df.select(*[known(df, c).cast(kind).alias(c) for c in names])
        if len(names) == 1:
            pairs = values.select(F.lit(names[0]).alias("column"), col(names[0]).alias("value"))
        else:
            pairs = values.unpivot([], [col(c) for c in names], "column", "value")
        parts.append(pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("value_count")))
    return parts


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value as text, count) for every distinct value, null included."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, value string, value_count bigint")
    parts = [p.withColumn("value", F.col("value").cast("string")) for p in native_counts(df, columns)]
    return reduce(DataFrame.unionByName, parts)


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values per column without null, and with null counted as one value."""
    if not columns:
        return df.sparkSession.createDataFrame(
            [], "column string, unique_count bigint, unique_with_null bigint, non_null bigint"
        )
    known_count = F.sum(F.when(F.col("value").isNotNull(), F.col("value_count")))
    parts = [
        p.groupBy("column").agg(
            F.count("value").alias("unique_count"),
            F.count(F.lit(1)).alias("unique_with_null"),
            F.coalesce(known_count, F.lit(0)).alias("non_null"),
        )
        for p in native_counts(df, columns)
    ]
    return reduce(DataFrame.unionByName, parts)


#: First rows of a table that samples are looked for in.
HEAD = 200


def first_values(df: DataFrame, columns: list[str], order_by: str, n: int = 5) -> DataFrame:
    """First n known values of each column in key order, ties by value, as one text array per column.

    One scan finds the first HEAD rows, which hold the samples of most columns. A second one looks for the values of
    all columns that have too few there, or whose values there share the last key; a task passes on n of each.
    """
    texts = df.select(col(order_by).alias("k"), *[F.when(~is_missing(df, c), col(c).cast("string")).alias(f"c{i}") for i, c in enumerate(columns)])
    names = F.array(*[F.lit(c) for c in columns])

    def cells(rows: DataFrame, wanted: list[int]) -> DataFrame:
        pairs = rows.unpivot(["k"], [F.col(f"c{i}") for i in wanted], "cell", "value").filter("value IS NOT NULL")
        return pairs.select(F.get(names, F.substring("cell", 2, 9).cast("int")).alias("column"), "k", "value")

    head = settled(texts.orderBy("k").limit(HEAD))
    held, last = head.agg(F.count(F.lit(1)), F.max("k")).first()
    # Rows of the last key may go on behind the head; null keys come first.
    sure = F.lit(True) if held < HEAD else ~F.col("k").eqNullSafe(F.lit(last))
    counts = head.agg(*[F.count_if(F.col(f"c{i}").isNotNull() & sure).alias(str(i)) for i in range(len(columns))]).first()
    found = [i for i in range(len(columns)) if held < HEAD or counts[str(i)] >= n]
    others = [i for i in range(len(columns)) if i not in found]
    parts = [cells(rows, wanted) for rows, wanted in ((head, found), (texts, others)) if wanted]
    place = F.row_number().over(Window.partitionBy("column").orderBy("k", "value"))
    firsts = [part.withColumn("place", place).filter(F.col("place") <= n) for part in parts]
    rows = reduce(DataFrame.unionByName, firsts)
    ordered = F.array_sort(F.collect_list(F.struct("place", "value")))
    return rows.groupBy("column").agg(F.transform(ordered, lambda r: r["value"]).alias("sample_values"))


def column_summary(df: DataFrame, name: str, order_by: str, samples: int = 5) -> DataFrame:
    """Type, null count, distinct count, first values, and min, max, mean of numeric columns."""
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    figures = missing_counts(df, name).join(
        column_figures(df, columns_of(df, "numeric"), NUMBER_FIGURES, cast="double").drop("total_records"),
        "column",
        "left",
    )
    return (
        figures.join(column_types(df, name).select("column", "data_type"), "column")
        .join(distinct_counts(df, plain).select("column", "unique_count"), "column", "left")
        .join(first_values(df, plain, order_by, samples), "column", "left")
        .select(
            "dataset_name",
            "column",
            "data_type",
            F.col("missing_count").alias("null_count"),
            F.coalesce("unique_count", F.lit(0)).cast("bigint").alias("unique_count"),
            F.coalesce("sample_values", F.array().cast("array<string>")).alias("sample_values"),
            "min_value",
            "max_value",
            "mean_value",
        )
    )


def numeric_summary(df: DataFrame, name: str) -> DataFrame:
    """Min, max, mean, sample deviation and bias-corrected skewness; columns without a value are left out.

    A single value and a constant column have skewness 0; two different values give null.
    """
    fields = {
        "non_null": "count({v})",
        **NUMBER_FIGURES,
        "std_value": "stddev_samp({v})",
        "skew": "skewness({v})",
    }
    n = F.col("non_null").cast("double")
    corrected = F.col("skew") * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    constant = (F.col("min_value") == F.col("max_value")) & (n != 2)
    skewness = F.when(constant, F.lit(0.0)).when(n >= 3, corrected)
    return (
        column_figures(df, columns_of(df, "numeric"), fields, cast="double", cost=2)
        .filter("non_null > 0")
        .select(
            F.lit(name).alias("dataset_name"),
            "column",
            "non_null",
            "min_value",
            "max_value",
            "mean_value",
            "std_value",
            skewness.alias("skewness"),
        )
    )


def top_values(df: DataFrame, name: str, k: int = 10) -> DataFrame:
    """Most frequent values of every text column, ties by value, with the distinct count incl. null.

    The rank filter is a group limit: each task passes on at most k rows per column.
    """
    counts = value_counts(df, columns_of(df, "text"))
    best = Window.partitionBy("column").orderBy(F.desc("value_count"), "value")
    ranked = (
        counts.filter(F.col("value").isNotNull())
        .withColumn("value_rank", F.row_number().over(best))
        .filter(F.col("value_rank") <= k)
    )
    sizes = counts.groupBy("column").agg(F.count(F.lit(1)).alias("unique_count"))
    return sizes.join(ranked, "column", "left").select(
        F.lit(name).alias("dataset_name"),
        "column",
        "unique_count",
        F.col("value_rank").cast("bigint").alias("value_rank"),
        "value",
        "value_count",
    )


def modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent known value per column, the smallest on a tie."""
    best = F.struct((-F.col("value_count")).alias("less"), F.col("value").alias("value"))
    return (
        value_counts(df, columns)
        .filter(F.col("value").isNotNull())
        .groupBy("column")
        .agg(F.min(best).alias("m"))
        .select("column", F.col("m.value").alias("top"), (-F.col("m.less")).alias("freq"))
    )


def describe(df: DataFrame, name: str) -> DataFrame:
    """Summary of all columns: numbers get moments and quartiles, everything else count, unique, top, freq."""
    numeric = columns_of(df, "numeric")
    others = [c for c in df.columns if c not in numeric]
    parts = []
    if numeric:
        quartiles = quantile_columns(df, numeric, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
        fields = {"value_count": "count({v})", **NUMBER_FIGURES, "std_value": "stddev_samp({v})"}
        moments = column_figures(df, numeric, fields, cast="double", cost=2)
        parts.append(moments.drop("ordinal", "total_records").join(quartiles.drop("non_null"), "column"))
    if others:
        parts.append(
            distinct_counts(df, others)
            .select("column", F.col("non_null").alias("value_count"), "unique_count")
            .join(modes(df, others), "column", "left")
        )
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    wanted = {
        "unique_count": "bigint",
        "top": "string",
        "freq": "bigint",
        "mean_value": "double",
        "std_value": "double",
        "min_value": "double",
        "q25": "double",
        "q50": "double",
        "q75": "double",
        "max_value": "double",
    }
    return rows.select(
        F.lit(name).alias("dataset_name"),
        "column",
        "value_count",
        *[
            (F.col(c) if c in rows.columns else F.lit(None).cast(t)).alias(c)
            for c, t in wanted.items()
        ],
    )


#: Columns whose pairs with all later columns are summed in one scan, and cells laid out at a time.
TILE, CELLS = 256, 1 << 20


def product_sums(values: DataFrame, tile: range) -> DataFrame:
    """(i, j, n, si, sj, sii, sjj, sij): for each column i of a tile and each later column j, the rows that have both, and
    the sums of both values, their squares and their product over those rows; `odd` counts the rows with an infinite one.

    A task adds up matrix products of its batches, so a scan gives all pairs of a tile whatever their number, and a
    task passes on one row for each pair."""
    first, last, width = tile.start, tile.stop, len(values.columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((last - first, width)) for _ in range(7)]
        step = max(1, CELLS // width)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in part.columns]).astype(float)
                has, odd = (~np.isnan(x)).astype(float), np.isinf(x).astype(float)
                x = np.where((has > 0) & (odd == 0), x, 0.0)
                mine, own = x[:, first:last], has[:, first:last]
                parts = (own.T @ has, mine.T @ has, own.T @ x, (mine * mine).T @ has, own.T @ (x * x), mine.T @ x, odd[:, first:last].T @ has + own.T @ odd)
                for total, product in zip(sums, parts, strict=True):
                    total += product
        i, j = np.nonzero(np.arange(width) > np.arange(first, last)[:, None])
        yield pa.RecordBatch.from_arrays([pa.array((i + first).astype(np.int32)), pa.array(j.astype(np.int32)), *[pa.array(t[i, j]) for t in sums]], names)

    names = ["i", "j", "n", "si", "sj", "sii", "sjj", "sij", "odd"]
    found = values.mapInArrow(task, "i int, j int, " + ", ".join(f"{name} double" for name in names[2:]))
    return found.groupBy("i", "j").agg(*[F.sum(name).alias(name) for name in names[2:]])


def correlations(df: DataFrame, name: str) -> DataFrame:
    """Pearson correlation of every pair of numeric columns over the rows that have both; null where it has no meaning:
    fewer than two such rows, a column constant on them, or an infinite value among them.

    Values are taken from the column's mean, so that sums of squares keep their digits. One scan gives all pairs of up to
    TILE columns with the columns after them."""
    numeric = columns_of(df, "numeric")
    if len(numeric) < 2:
        return df.sparkSession.createDataFrame(
            [], "dataset_name string, column_a string, column_b string, correlation double"
        )
    means = {r["column"]: r["mean"] for r in column_figures(df, numeric, {"mean": FINITE_MEAN}, cast="double").collect()}
    values = df.select(*[(known(df, c).cast("double") - F.lit(means[c] or 0.0)).alias(f"v_{i}") for i, c in enumerate(numeric)])
    tiles = [range(at, min(at + TILE, len(numeric))) for at in range(0, len(numeric), TILE)]
    sums = reduce(DataFrame.unionByName, [product_sums(values, tile) for tile in tiles])
    rows = sums.withColumns({f"c{x}{y}": F.col(f"s{x}{y}") - F.col(f"s{x}") * F.col(f"s{y}") / F.nullif("n", F.lit(0.0)) for x, y in ("ii", "jj", "ij")})
    # What is left of a constant column is rounding.
    varied = [F.col(f"c{x}{x}") > F.col(f"s{x}{x}") * 1e-12 for x in "ij"]
    r = F.col("cij") / F.sqrt(F.nullif("cii", F.lit(0.0))) / F.sqrt(F.nullif("cjj", F.lit(0.0)))
    defined = (F.col("n") > 1) & (F.col("odd") == 0) & varied[0] & varied[1]
    names = F.array(*[F.lit(c) for c in numeric])
    return rows.select(
        F.lit(name).alias("dataset_name"),
        F.get(names, F.col("i")).alias("column_a"),
        F.get(names, F.col("j")).alias("column_b"),
        F.when(defined, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("correlation"),
    )


#: Seconds of a unit, at least, and buckets of a range.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800, "month": 2_419_200, "quarter": 7_776_000, "year": 31_536_000}
RANGE = 4096


def temporal_profile(df: DataFrame, name: str, column: str, unit: str = "day") -> DataFrame:
    """Rows per time bucket and the distance to the previous filled bucket in days.

    Buckets are put in order within ranges of RANGE of them; the first of a range looks up the end of the range before in
    a list with one entry per range.
    """
    buckets = (
        df.filter(col(column).isNotNull())
        .groupBy(F.date_trunc(unit, col(column)).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    seconds = F.unix_seconds(F.col("bucket").cast("timestamp"))
    buckets = buckets.withColumn("range", F.floor(seconds / (UNIT_SECONDS[unit.lower()] * RANGE)).cast("bigint"))
    ends = buckets.groupBy("range").agg(F.max("bucket").alias("end"))
    listed = ends.agg(F.collect_list(F.struct("range", "end")).alias("ends")).select("ends").scalar()
    own = F.lag("bucket").over(Window.partitionBy("range").orderBy("bucket"))
    before = F.array_max(F.transform(F.filter(F.col("ends"), lambda e: e["range"] < F.col("range")), lambda e: e["end"]))
    rows = buckets.withColumn("own", own).withColumn("ends", F.when(F.col("own").isNull(), listed))
    previous = F.coalesce("own", before)
    return rows.select(
        F.lit(name).alias("dataset_name"),
        F.lit(column).alias("column"),
        F.date_format("bucket", "yyyy-MM-dd HH:mm:ss").alias("bucket"),
        "row_count",
        F.datediff(F.to_date("bucket"), F.to_date(previous)).cast("bigint").alias("gap_days"),
    )


def missing_patterns(df: DataFrame, name: str) -> DataFrame:
    """Which columns are missing together: one row per combination, columns joined by commas."""
    gaps = F.array_compact(F.array(*[F.when(is_missing(df, c), F.lit(c)) for c in df.columns]))
    return (
        df.groupBy(F.array_join(gaps, ",").alias("missing_columns"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("dataset_name"), "missing_columns", "row_count")
    )


def rare_pairs(df: DataFrame, name: str, column_a: str, column_b: str, limit: float = 0.5) -> DataFrame:
    """Value combinations seen less often than limit x the count expected from both columns alone.

    Marginals are summed from the pair counts, so the table is read and shuffled once.
    """
    pairs = (
        df.select(col(column_a).cast("string").alias("value_a"), col(column_b).cast("string").alias("value_b"))
        .dropna()
        .groupBy("value_a", "value_b")
        .agg(F.count(F.lit(1)).alias("observed"))
    )
    side_a = pairs.groupBy("value_a").agg(F.sum("observed").alias("count_a"))
    side_b = pairs.groupBy("value_b").agg(F.sum("observed").alias("count_b"))
    total = pairs.agg(F.sum("observed").alias("n")).scalar()
    expected = F.col("count_a").cast("double") * F.col("count_b") / total
    return (
        pairs.join(side_a, "value_a")
        .join(side_b, "value_b")
        .withColumn("expected", expected)
        .withColumn("ratio", F.col("observed") / F.col("expected"))
        .filter(F.col("ratio") < limit)
        .select(
            F.lit(name).alias("dataset_name"),
            F.lit(column_a).alias("column_a"),
            F.lit(column_b).alias("column_b"),
            "value_a",
            "value_b",
            "observed",
            "expected",
            "ratio",
        )
    )


def format_fit(df: DataFrame, name: str) -> DataFrame:
    """Share of the known values of each text column that read as a number or as an ISO date."""
    texts = columns_of(df, "text")
    fields = {
        "non_null": "count({v})",
        "numbers": f"count_if(rlike({{v}}, {quoted(NUMBER_PATTERN.replace('{', '{{').replace('}', '}}'))}))",
        "dates": f"count_if(rlike({{v}}, {quoted(DATE_PATTERN.replace('{', '{{').replace('}', '}}'))}))",
    }
    rows = column_figures(df, texts, fields)
    whole = F.nullif(F.col("non_null").cast("double"), F.lit(0.0))
    return rows.select(
        F.lit(name).alias("dataset_name"),
        "column",
        "non_null",
        (F.col("numbers") / whole).alias("number_share"),
        (F.col("dates") / whole).alias("date_share"),
    )

