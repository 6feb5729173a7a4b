"""Quality flags from fixed limits: missing values, low uniqueness, outliers, rule violations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.functions.columns import (
    column_figures,
    columns_of,
    control_table,
    count_where,
    known,
    one_decimal,
    percentage,
)
from rowsmith.operators.profile import basic_stats, distinct_counts, missing_counts
from rowsmith.operators.quantiles import number, quantile_values

# Flag limits in percent and the width of the outlier fence in interquartile ranges.
MISSING_LIMIT = 20.0
UNIQUENESS_LIMIT = 10.0
OUTLIER_LIMIT = 5.0
FENCE = 1.5


def high_missing(df: DataFrame, name: str, limit: float = MISSING_LIMIT) -> DataFrame:
    """Columns with more than the limit of missing values."""
    return (
        missing_counts(df, name)
        .filter(F.col("missing_percentage") > limit)
        .select("dataset_name", "column", "total_records", "missing_count", "missing_percentage")
    )


def low_uniqueness(df: DataFrame, name: str, limit: float = UNIQUENESS_LIMIT) -> DataFrame:
    """Numeric columns whose distinct values are less than the limit of their known values."""
    numeric = columns_of(df, "numeric")
    share = percentage(F.col("unique_count"), F.col("non_null"))
    return (
        distinct_counts(df, numeric)
        .withColumn("unique_percentage", share)
        .filter(F.col("unique_percentage") < limit)
        .select(F.lit(name).alias("dataset_name"), "column", "unique_count", "non_null", "unique_percentage")
    )


def fences(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float, float, float]]:
    """First and third quartile, lower and upper fence of each column that has values."""
    found = {}
    for c, (n, (q1, q3)) in quantile_values(df, columns, [0.25, 0.75]).items():
        if n:
            found[c] = (q1, q3, q1 - FENCE * (q3 - q1), q3 + FENCE * (q3 - q1))
    return found


def outlier_bounds(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Quartiles and outlier fences per numeric column."""
    columns = columns_of(df, "numeric") if columns is None else list(columns)
    rows = [(c, *f) for c, f in fences(df, columns).items()]
    return control_table(
        df.sparkSession,
        rows,
        column=pa.string(),
        q1=pa.float64(),
        q3=pa.float64(),
        lower=pa.float64(),
        upper=pa.float64(),
    )


def outlier_counts(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Values strictly outside the fences per numeric column, with the extremes among them.

    Columns without any value have no fences and are left out.
    """
    bounds = fences(df, columns_of(df, "numeric") if columns is None else list(columns))
    outside = "{v} < {lower} OR {v} > {upper}"
    fields = {
        "outliers": f"count_if({outside})",
        "smallest": f"min(IF({outside}, {{v}}, NULL))",
        "largest": f"max(IF({outside}, {{v}}, NULL))",
    }
    literals = {c: {"lower": number(f[2]), "upper": number(f[3])} for c, f in bounds.items()}
    rows = column_figures(df, list(bounds), fields, cast="double", constants=literals)
    return rows.select(
        F.lit(name).alias("dataset_name"),
        "column",
        "total_records",
        "outliers",
        percentage(F.col("outliers"), F.col("total_records")).alias("outlier_percentage"),
        "smallest",
        "largest",
    )


def high_outliers(df: DataFrame, name: str, limit: float = OUTLIER_LIMIT) -> DataFrame:
    """Numeric columns in which outliers are more than the limit of all rows."""
    return outlier_counts(df, name).filter(F.col("outlier_percentage") > limit)


def outlier_rows(df: DataFrame, column: str) -> DataFrame:
    """The rows whose value lies outside the fences of its column; the fences reach the scan as filters."""
    found = fences(df, [column])
    if not found:
        return df.limit(0)
    _, _, lower, upper = found[column]
    return df.filter((known(df, column) < lower) | (known(df, column) > upper))


def column_flags(df: DataFrame, name: str) -> DataFrame:
    """All flags of a table in long form, with the figures behind them and a message."""
    missing = high_missing(df, name).select(
        "dataset_name",
        "column",
        F.lit("missing").alias("flag"),
        F.lit(1).alias("flag_order"),
        F.col("missing_count").alias("affected"),
        F.col("missing_percentage").alias("percentage"),
        F.concat(F.lit("High missing data: "), one_decimal(F.col("missing_percentage")), F.lit("%")).alias("message"),
        F.array().cast("array<string>").alias("examples"),
    )
    repeated = low_uniqueness(df, name).select(
        "dataset_name",
        "column",
        F.lit("uniqueness").alias("flag"),
        F.lit(2).alias("flag_order"),
        (F.col("non_null") - F.col("unique_count")).alias("affected"),
        F.col("unique_percentage").alias("percentage"),
        F.concat(F.lit("Low uniqueness: "), one_decimal(F.col("unique_percentage")), F.lit("%")).alias("message"),
        F.array().cast("array<string>").alias("examples"),
    )
    extreme = high_outliers(df, name).select(
        "dataset_name",
        "column",
        F.lit("outliers").alias("flag"),
        F.lit(3).alias("flag_order"),
        F.col("outliers").alias("affected"),
        F.col("outlier_percentage").alias("percentage"),
        F.format_string("High outlier rate: %d/%d", F.col("outliers"), F.col("total_records")).alias("message"),
        F.array(F.format_string("%.2f", F.col("smallest")), F.format_string("%.2f", F.col("largest"))).alias(
            "examples"
        ),
    )
    return reduce(DataFrame.unionByName, [missing, repeated, extreme])


def problem_list(df: DataFrame, name: str) -> DataFrame:
    """The messages of each flagged column, at most three per column, in flag order."""
    messages = F.array_sort(F.collect_list(F.struct("flag_order", "message")))
    return (
        column_flags(df, name)
        .groupBy("dataset_name", "column")
        .agg(F.transform(messages, lambda m: m["message"]).alias("issues"))
    )


def flag_inputs(df: DataFrame, name: str) -> DataFrame:
    """Rows, missing percentage and duplicate percentage: the basic inputs of the issue step."""
    return basic_stats(df, name).select(
        "dataset_name",
        "total_records",
        F.col("missing_percentage").alias("missing_data_percentage"),
        "duplicate_percentage",
    )


def rule_counts(df: DataFrame, name: str, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Violations per rule (rule id, column, SQL predicate that valid rows satisfy), all in one aggregate.

    A row for which the predicate is unknown does not violate it.
    """
    wide = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[count_where(~F.expr(predicate)).alias(f"violations_{i}") for i, (_, _, predicate) in enumerate(rules)],
    )
    rows = [
        F.struct(
            F.lit(rule_id).alias("rule_id"),
            F.lit(column).alias("column"),
            F.col(f"violations_{i}").alias("violations"),
        )
        for i, (rule_id, column, _) in enumerate(rules)
    ]
    long = wide.select("total_records", F.inline(F.array(*rows)))
    return long.select(
        F.lit(name).alias("dataset_name"),
        "rule_id",
        "column",
        "violations",
        percentage(F.col("violations"), F.col("total_records")).alias("violation_percentage"),
    )
