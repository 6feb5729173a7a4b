"""From tables and their issues to repaired tables, the log of what was done, and the report over all of them."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.functions.columns import control_table
from rowsmith.operators import repair

# Our rules that turn an issue into a fix: category, whether the issue names a column, a word that its description
# must hold (any if empty), fix, method, confidence. The first rule that fits is taken; no rule, no fix.
FIX_RULES = [
    ("completeness", True, "", "fill_missing", "statistical_imputation", 0.7),
    ("uniqueness", False, "", "remove_duplicates", "", 0.95),
    ("consistency", True, "", "standardize_format", "", 0.8),
    ("validity", True, "negative", "add_validation", "", 0.6),
]


def fixes_for(issues: DataFrame, rules=None) -> DataFrame:
    """One fix for each issue that a rule knows: dataset_name, step within its table, and the fields of a fix.

    Fixes are ordered by the issues' priority. Issues with the same fix of the same column give one fix.
    """
    numbered = [(i, *rule) for i, rule in enumerate(FIX_RULES if rules is None else rules)]
    table = control_table(
        issues.sparkSession,
        numbered,
        rule=pa.int32(),
        rule_category=pa.string(),
        with_column=pa.bool_(),
        mention=pa.string(),
        fix_type=pa.string(),
        implementation_method=pa.string(),
        confidence=pa.float64(),
    )
    fits = (F.col("category") == F.col("rule_category")) & (F.col("column").isNotNull() == F.col("with_column"))
    fits = fits & F.contains(F.lower(F.coalesce("description", F.lit(""))), F.col("mention"))
    rows = issues.join(table, fits).groupBy("dataset_name", "category", "column", "description", "fix_priority")
    chosen = rows.agg(F.min(F.struct("rule", "fix_type", "implementation_method", "confidence")).alias("fix"))
    fix = ["dataset_name", F.col("column").alias("target_column"), "fix.fix_type", "fix.implementation_method", "fix.confidence"]
    once = chosen.select(*fix, "fix_priority", F.col("category").alias("issue_type"), "description")
    once = once.groupBy("dataset_name", "target_column", "fix_type", "implementation_method", "confidence")
    return once.agg(
        F.min("fix_priority").alias("fix_priority"),
        F.min("issue_type").alias("issue_type"),
        F.min("description").alias("medical_reasoning"),
    ).orderBy("dataset_name", "fix_priority", F.col("target_column").asc_nulls_last(), "fix_type")


def plans_of(fixes: DataFrame) -> dict[str, list[dict]]:
    """The plan of each table, in order; refuses more fixes than a control table holds."""
    plans: dict[str, list[dict]] = {}
    for row in repair.plan_rows(fixes):
        plans.setdefault(row["dataset_name"], []).append(row)
    return plans


def repair_run(tables: dict[str, DataFrame], issues: DataFrame, rules=None) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """(repaired tables, log, report by table). Each table gets the fixes of its own issues; tables without any stay.

    Issues of tables that are not given are left out. The log has one row per fix.
    """
    plans = plans_of(fixes_for(issues, rules))
    fixed = {name: repair.apply_fix_plan(df, plans.get(name, [])) for name, df in tables.items()}
    logs = [repair.resolution_log(df, name, plans.get(name, [])) for name, df in tables.items()]
    reports = [repair.enhancement_report(df, name, plans.get(name, [])) for name, df in tables.items()]
    return fixed, reduce(DataFrame.unionByName, logs), reduce(DataFrame.unionByName, reports)


def collection_report(log: DataFrame, reports: DataFrame) -> DataFrame:
    """One row over all tables: tables, those enhanced, fixes by outcome, rows removed, mean non-zero confidence of
    the fixes that ran."""
    ran = F.col("status").isin("resolved", "no_change")
    confidence = log.agg(F.avg(F.when(ran, F.nullif("confidence", F.lit(0.0)))).alias("c")).scalar()
    return reports.agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if(F.col("fixes_applied") > 0).alias("tables_enhanced"),
        F.sum("issues_addressed").alias("issues_addressed"),
        F.sum("fixes_applied").alias("fixes_applied"),
        F.sum("fixes_without_effect").alias("fixes_without_effect"),
        F.sum("fixes_failed").alias("fixes_failed"),
        (-F.sum("row_change")).alias("rows_removed"),
    ).withColumn("average_confidence", confidence)
