"""Quality issues, scores, risk levels and the short lists drawn from them.

Issues are rows: dataset_name, column, severity, category, description, percentage_affected,
affected_records, recommendation, fix_priority (1 first), example_values.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowsmith.functions import json_text
from rowsmith.functions.columns import computed_once, control_table, count_where, one_decimal

# Deductions per severity, the deduction for any other severity, threshold defaults.
SEVERITY_WEIGHTS = [("critical", 20.0), ("high", 10.0), ("medium", 5.0), ("low", 2.0)]
OTHER_WEIGHT = 5.0
MISSING_THRESHOLD, MISSING_MULTIPLIER = 10.0, 0.5
DUPLICATE_THRESHOLD, DUPLICATE_MULTIPLIER = 5.0, 0.3

# What a parsed issue gets when the answer leaves a field out.
DEFAULT_SEVERITY = "medium"
DEFAULT_CATEGORY = "general"
DEFAULT_DESCRIPTION = "Quality issue detected"
DEFAULT_RECOMMENDATION = "Manual review required"
DEFAULT_PRIORITY = 3

# Our rules that turn a flag into an issue: flag, from %, to %, severity, category, recommendation, priority.
ISSUE_RULES = [
    ("missing", 0.0, 30.0, "medium", "completeness", "Fill missing values", 3),
    ("missing", 30.0, 60.0, "high", "completeness", "Fill missing values", 2),
    ("missing", 60.0, 101.0, "critical", "completeness", "Collect the column again", 1),
    ("uniqueness", 0.0, 101.0, "low", "uniqueness", "Check whether the column is a category", 4),
    ("outliers", 0.0, 15.0, "medium", "validity", "Review values outside the fences", 3),
    ("outliers", 15.0, 101.0, "high", "validity", "Review values outside the fences", 2),
    ("duplicates", 0.0, 20.0, "high", "uniqueness", "Remove duplicate rows", 2),
    ("duplicates", 20.0, 101.0, "critical", "uniqueness", "Remove duplicate rows", 1),
]

# Our score bands for the fitness label.
FITNESS_BANDS = [("high", 75.0), ("medium", 50.0)]

ANSWER_SCHEMA = (
    "array<struct<severity:string, category:string, description:string, column:string,"
    " estimated_affected_percentage:double, recommendation:string, priority:double,"
    " example_problematic_values:array<string>>>"
)


def issue_rules(spark: SparkSession, rows=None) -> DataFrame:
    """The rule table as a DataFrame."""
    return control_table(
        spark,
        ISSUE_RULES if rows is None else rows,
        flag=pa.string(),
        from_pct=pa.float64(),
        to_pct=pa.float64(),
        severity=pa.string(),
        category=pa.string(),
        recommendation=pa.string(),
        fix_priority=pa.int64(),
    )


def affected_records(percentage: Column, total: Column) -> Column:
    """Whole records behind a percentage, cut not rounded."""
    return ((percentage / 100.0) * total).cast("bigint")


def issues_from_flags(flags: DataFrame, stats: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Issues of one or more tables from their flags and basic figures.

    Flags and figures are a few rows per table, so both joins stay small whatever the tables hold.
    """
    rules = issue_rules(flags.sparkSession) if rules is None else rules
    duplicates = stats.filter(F.col("duplicate_percentage") > DUPLICATE_THRESHOLD).select(
        "dataset_name",
        F.lit(None).cast("string").alias("column"),
        F.lit("duplicates").alias("flag"),
        F.lit(4).alias("flag_order"),
        F.col("duplicate_rows").alias("affected"),
        F.col("duplicate_percentage").alias("percentage"),
        F.concat(F.lit("Duplicate rows: "), one_decimal(F.col("duplicate_percentage")), F.lit("%")).alias("message"),
        F.array().cast("array<string>").alias("examples"),
    )
    found = flags.unionByName(duplicates).join(stats.select("dataset_name", "total_records"), "dataset_name")
    # Low uniqueness is a property of the column, so all its rows are affected.
    share = F.when(F.col("flag") == "uniqueness", F.lit(100.0)).otherwise(F.col("percentage"))
    in_band = (F.col("share") >= F.col("from_pct")) & (F.col("share") < F.col("to_pct"))
    return (
        found.withColumn("share", share)
        .join(rules, "flag")
        .filter(in_band)
        .select(
            "dataset_name",
            "column",
            "severity",
            "category",
            F.col("message").alias("description"),
            F.col("share").alias("percentage_affected"),
            affected_records(F.col("share"), F.col("total_records")).alias("affected_records"),
            "recommendation",
            "fix_priority",
            F.col("examples").alias("example_values"),
        )
    )


def parse_issues(responses: DataFrame, response: str = "response", total_records: int | Column = 0) -> DataFrame:
    """Issues inside free text answers: the outermost JSON array, defaults for absent fields.

    Answers without an array, or with a broken one, give no issue. Other columns are kept.
    """
    keep = [c for c in responses.columns if c != response]
    total = F.lit(total_records) if isinstance(total_records, int) else total_records
    json = json_text.valid_json(json_text.array_span(F.col(response)))
    listed = computed_once(responses, [*keep, total.alias("_total")], _list=json_text.parse_as(json, ANSWER_SCHEMA))
    rows = listed.select(*keep, "_total", F.posexplode("_list").alias("position", "_issue"))
    share = F.coalesce("_issue.estimated_affected_percentage", F.lit(0.0))
    return rows.filter(F.col("_issue").isNotNull()).select(
        *keep,
        "position",
        F.coalesce("_issue.severity", F.lit(DEFAULT_SEVERITY)).alias("severity"),
        F.coalesce("_issue.category", F.lit(DEFAULT_CATEGORY)).alias("category"),
        F.coalesce("_issue.description", F.lit(DEFAULT_DESCRIPTION)).alias("description"),
        F.col("_issue.column").alias("column"),
        affected_records(share, F.col("_total")).alias("affected_records"),
        share.alias("percentage_affected"),
        F.coalesce("_issue.recommendation", F.lit(DEFAULT_RECOMMENDATION)).alias("recommendation"),
        F.coalesce(F.col("_issue.priority").cast("bigint"), F.lit(DEFAULT_PRIORITY)).alias("fix_priority"),
        F.coalesce("_issue.example_problematic_values", F.array().cast("array<string>")).alias("example_values"),
    )


def severity_weights(spark: SparkSession, rows=None) -> DataFrame:
    """Weights per severity; a domain may bring its own rows."""
    return control_table(
        spark, SEVERITY_WEIGHTS if rows is None else rows, severity=pa.string(), weight=pa.float64()
    )


def domain_thresholds(spark: SparkSession, rows) -> DataFrame:
    """Thresholds per domain: domain, then threshold and multiplier for missing cells and for duplicates."""
    return control_table(
        spark,
        rows,
        domain=pa.string(),
        missing_threshold=pa.float64(),
        missing_multiplier=pa.float64(),
        duplicate_threshold=pa.float64(),
        duplicate_multiplier=pa.float64(),
    )


def over(value: Column, threshold: Column, multiplier: Column) -> Column:
    """Deduction for the part of a percentage above its threshold."""
    return F.when(value > threshold, (value - threshold) * multiplier).otherwise(F.lit(0.0))


def quality_scores(
    issues: DataFrame,
    stats: DataFrame,
    weights: DataFrame | None = None,
    thresholds: DataFrame | None = None,
    external: DataFrame | None = None,
) -> DataFrame:
    """One score from 0 to 100 per table.

    stats may carry a domain column that selects a row of thresholds; external holds
    (dataset_name, external_score) and counts 40 % where it has a number. A table without rows has no score.
    """
    spark = issues.sparkSession
    weights = severity_weights(spark) if weights is None else weights
    weight = F.coalesce("weight", F.lit(OTHER_WEIGHT))
    deductions = (
        issues.join(weights, "severity", "left")
        .groupBy("dataset_name")
        .agg(F.sum(weight * F.col("percentage_affected") / 100.0).alias("issue_deduction"))
    )
    rows = stats.join(deductions, "dataset_name", "left")
    if "domain" not in stats.columns:
        rows = rows.withColumn("domain", F.lit("general"))
    if thresholds is None:
        thresholds = domain_thresholds(spark, [])
    rows = rows.join(thresholds, "domain", "left")
    if external is None:
        rows = rows.withColumn("external_score", F.lit(None).cast("double"))
    else:
        rows = rows.join(external, "dataset_name", "left")
    base = (
        F.lit(100.0)
        - F.coalesce("issue_deduction", F.lit(0.0))
        - over(
            F.coalesce("missing_percentage", F.lit(0.0)),
            F.coalesce("missing_threshold", F.lit(MISSING_THRESHOLD)),
            F.coalesce("missing_multiplier", F.lit(MISSING_MULTIPLIER)),
        )
        - over(
            F.coalesce("duplicate_percentage", F.lit(0.0)),
            F.coalesce("duplicate_threshold", F.lit(DUPLICATE_THRESHOLD)),
            F.coalesce("duplicate_multiplier", F.lit(DUPLICATE_MULTIPLIER)),
        )
    )
    blended = F.when(F.col("external_score").isNull() | F.isnan("external_score"), base).otherwise(base * 0.6 + F.col("external_score") * 0.4)
    return rows.select(
        "dataset_name",
        "total_records",
        "missing_percentage",
        "duplicate_percentage",
        F.when(F.col("total_records") > 0, F.greatest(F.lit(0.0), F.least(F.lit(100.0), blended))).alias("quality_score"),
    )


def severity_counts(issues: DataFrame) -> DataFrame:
    """Issues per table: total, per severity, others, and the number of distinct columns."""
    levels = [s for s, _ in SEVERITY_WEIGHTS]
    return issues.groupBy("dataset_name").agg(
        F.count(F.lit(1)).alias("total_issues"),
        *[count_where(F.col("severity") == s).alias(f"{s}_issues") for s in levels],
        count_where(~F.col("severity").isin(levels)).alias("other_issues"),
        F.count_distinct("column").alias("columns_with_issues"),
    )


def category_counts(issues: DataFrame) -> DataFrame:
    """Issues per table and category."""
    return issues.groupBy("dataset_name", "category").agg(F.count(F.lit(1)).alias("issue_count"))


def risk_of(critical: Column, high: Column, medium: Column) -> Column:
    """critical with any critical issue, high above 2 high ones, medium above 5 medium ones, else low."""
    return F.when(critical > 0, "critical").when(high > 2, "high").when(medium > 5, "medium").otherwise("low")


def error_summary(issues: DataFrame) -> DataFrame:
    """Counts by severity, categories, columns, the critical and high issues, and the risk level."""
    grave = F.col("severity").isin("critical", "high")
    listed = issues.groupBy("dataset_name").agg(
        F.array_sort(F.collect_set("category")).alias("categories"),
        F.array_sort(F.collect_set("column")).alias("columns"),
        F.array_sort(
            F.collect_list(F.when(grave, F.struct("severity", "column", "description", "percentage_affected")))
        ).alias("most_critical_issues"),
    )
    return (
        severity_counts(issues)
        .join(listed, "dataset_name")
        .withColumn("risk_level", risk_of(F.col("critical_issues"), F.col("high_issues"), F.col("medium_issues")))
    )


def risk_levels(issues: DataFrame) -> DataFrame:
    """Risk level per table."""
    return severity_counts(issues).select(
        "dataset_name",
        "total_issues",
        risk_of(F.col("critical_issues"), F.col("high_issues"), F.col("medium_issues")).alias("risk_level"),
    )


def critical_issues(issues: DataFrame) -> DataFrame:
    """Critical issues of all tables."""
    return issues.filter(F.col("severity") == "critical")


def priority_issues(issues: DataFrame) -> DataFrame:
    """Critical and high issues with priority 1 or 2."""
    return issues.filter(F.col("severity").isin("critical", "high") & (F.col("fix_priority") <= 2))


def priority_tables(scores: DataFrame, limit: float = 60.0) -> DataFrame:
    """Tables whose score is below the limit."""
    return scores.filter(F.col("quality_score") < limit)


def top_issues(issues: DataFrame, n: int = 3) -> DataFrame:
    """First n critical or high issues of each table, most urgent first."""
    order = Window.partitionBy("dataset_name").orderBy(
        "fix_priority", F.desc("percentage_affected"), F.col("column").asc_nulls_last(), "category", "description"
    )
    return (
        issues.filter(F.col("severity").isin("critical", "high"))
        .withColumn("issue_rank", F.row_number().over(order))
        .filter(F.col("issue_rank") <= n)
    )


def first_critical(issues: DataFrame, n: int = 5) -> DataFrame:
    """First n critical issues of the whole run."""
    return critical_issues(issues).orderBy("dataset_name", "fix_priority", "column", "description").limit(n)


def fitness_labels(scores: DataFrame, bands=None) -> DataFrame:
    """high, medium or low by score band; null without a score."""
    label = None
    for name, lowest in FITNESS_BANDS if bands is None else bands:
        test = F.col("quality_score") >= lowest
        label = F.when(test, name) if label is None else label.when(test, name)
    return scores.withColumn("fitness", label.when(F.col("quality_score").isNotNull(), "low"))
