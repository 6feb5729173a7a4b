"""Repair queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.functions.columns import fixed
from rowsmith.operators import dependencies, repair
from rowsmith.plans import quality
from rowsmith.plans import repair as plans
from rowsmith.plans.quality import union
from rowsmith.queries.profiles import DIRTY, r4, rounded, union_all
from rowsmith.queries.views import issue_answer, orders_dirty, part_dirty, said, table, with_views

PLAN = [
    {
        "issue_type": "completeness",
        "fix_type": "fill_missing",
        "target_column": "o_orderpriority",
        "new_values": ["5-low"],
        "fix_logic": "fill",
        "medical_reasoning": "no priority means low",
        "confidence": 0.9,
    },
    {
        "issue_type": "validity",
        "fix_type": "add_validation",
        "target_column": "o_totalprice",
        "fix_logic": "absolute value",
        "medical_reasoning": "prices are positive",
        "confidence": 0.7,
    },
    {
        "issue_type": "consistency",
        "fix_type": "standardize_format",
        "target_column": "o_orderpriority",
        "fix_logic": "title case",
        "medical_reasoning": "one spelling",
    },
    {"issue_type": "uniqueness", "fix_type": "remove_duplicates", "target_column": "multiple", "confidence": 0.95},
    {"issue_type": "validity", "fix_type": "fill_missing", "target_column": "o_totalprice", "new_values": ["none"]},
    {"issue_type": "validity", "fix_type": "fill_missing", "target_column": "o_comment", "new_values": ["x"]},
    {
        "issue_type": "completeness",
        "fix_type": "replace_values",
        "target_column": "o_totalprice",
        "new_values": ["0"],
        "confidence": 0.0,
    },
]

RULES = [
    {
        "rule_id": "price_positive",
        "validation_type": "value_range",
        "columns": ["o_totalprice"],
        "predicate": "o_totalprice >= 0",
        "severity": "critical",
        "suggestion": "take the absolute value",
        "confidence": 0.95,
    },
    {
        "rule_id": "open_is_urgent",
        "validation_type": "cross_column",
        "columns": ["o_orderstatus", "o_orderpriority"],
        "predicate": "NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')",
    },
]


#: Steps that fail on some rows among steps that do not; the seventh fails on what the fifth puts in.
ERROR_PLAN = [
    {"fix_type": "recalculate_values", "target_column": "o_totalprice", "formula": "o_totalprice / (o_custkey % 5)"},
    {"fix_type": "recalculate_values", "target_column": "o_custkey", "formula": "o_custkey * 1000000000000000000"},
    {
        "fix_type": "replace_values",
        "target_column": "o_totalprice",
        "new_values": ["0"],
        "predicate": "CAST(o_orderpriority AS INT) > 2",
    },
    {"fix_type": "recalculate_values", "target_column": "o_totalprice", "formula": "o_totalprice * 2"},
    {"fix_type": "replace_values", "target_column": "o_totalprice", "new_values": ["-1"], "predicate": "o_totalprice < 0"},
    {"fix_type": "remove_duplicates"},
    {"fix_type": "recalculate_values", "target_column": "o_totalprice", "formula": "1 / (o_totalprice + 1)"},
    {"fix_type": "recalculate_values", "target_column": "o_totalprice", "formula": "absent / 2"},
    {"fix_type": "fill_missing", "target_column": "o_orderpriority", "new_values": ["none"]},
]

ERROR_RULES = [
    RULES[0],
    {"rule_id": "urgent_number", "validation_type": "format", "columns": ["o_orderpriority"], "predicate": "CAST(o_orderpriority AS INT) > 0"},
    {
        "rule_id": "share_of_price",
        "validation_type": "cross_column",
        "columns": ["o_totalprice", "o_custkey"],
        "predicate": "o_totalprice / (o_custkey % 5) > 0",
    },
    {"rule_id": "no_such_column", "validation_type": "format", "columns": ["absent"], "predicate": "absent > 0"},
    {"rule_id": "no_condition", "validation_type": "format", "columns": ["o_custkey"], "predicate": "o_custkey + 1"},
]


def text_day(df):
    """The order date as text, so that both engines show it alike."""
    return df.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def fix_fill(spark, sf_dir):
    filled = repair.fill_missing(orders_dirty(spark, sf_dir), "o_orderpriority", "unknown")
    return text_day(repair.fill_missing(filled, "o_totalprice", "0"))


def fix_replace(spark, sf_dir):
    plain = repair.replace_values(part_dirty(spark, sf_dir), "p_name", "none")
    return repair.replace_values(plain, "p_size", 0, predicate="p_size < 0")


def fix_dedup(spark, sf_dir):
    return text_day(repair.remove_duplicates(orders_dirty(spark, sf_dir)))


def fix_title(spark, sf_dir):
    return repair.standardize_format(part_dirty(spark, sf_dir), "p_name")


def fix_abs(spark, sf_dir):
    return repair.add_validation(part_dirty(spark, sf_dir), "p_size")


def fix_formula(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").withColumn("l_charge", F.lit(None).cast("double"))
    fixed_rows = repair.recalculate(lineitem, "l_charge", "l_extendedprice * (1 - l_discount) * (1 + l_tax)")
    return rounded(fixed_rows.drop("l_shipdate"), "l_charge")


def fix_impute(spark, sf_dir):
    """Median of the price and most frequent priority of the whole table."""
    priced = repair.impute(orders_dirty(spark, sf_dir), "o_totalprice", "median")
    return text_day(rounded(repair.impute(priced, "o_orderpriority", "mode"), "o_totalprice"))


def fix_impute_grouped(spark, sf_dir):
    """Mean price and most frequent priority per order status."""
    priced = repair.impute(orders_dirty(spark, sf_dir), "o_totalprice", "mean", by=["o_orderstatus"])
    modal = repair.impute(priced, "o_orderpriority", "mode", by=["o_orderstatus"])
    return text_day(modal).withColumn("o_totalprice", fixed(F.col("o_totalprice"), 2))


def priced_groups(spark, sf_dir):
    """Line items with a group for each order, but one for a third of all orders, and prices missing here and there, in a
    few groups all of them."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    missing = (line % 3 == 0) | (key % 50 == 1)
    return table(spark, sf_dir, "lineitem").select(
        F.when(key % 3 != 0, key).alias("grp"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(~missing, F.col("l_extendedprice")).alias("price"),
        F.when(~missing, F.col("l_quantity").cast("int")).alias("pieces"),
    )


def fix_impute_median_grouped(spark, sf_dir):
    """Median price and number of pieces of the order; of all where an order has none."""
    priced = repair.impute(priced_groups(spark, sf_dir), "price", "median", by=["grp"])
    return rounded(repair.impute(priced, "pieces", "median", by=["grp"]), "price", "pieces")


def fix_plan(spark, sf_dir):
    return text_day(repair.apply_fix_plan(orders_dirty(spark, sf_dir), PLAN))


def fix_log(spark, sf_dir):
    log = repair.resolution_log(orders_dirty(spark, sf_dir), "orders_dirty", PLAN)
    return log.withColumn("step", F.col("step").cast("bigint"))


def fix_errors(spark, sf_dir):
    """What becomes of each step of a plan of which some fail."""
    log = repair.resolution_log(orders_dirty(spark, sf_dir), "orders_dirty", ERROR_PLAN)
    return log.select(F.col("step").cast("bigint").alias("step"), "fix_type", "target_column", "status", "cells_changed", "rows_removed", "rows_failed")


def fix_errors_table(spark, sf_dir):
    """The table after the steps that do not fail."""
    return text_day(repair.apply_fix_plan(orders_dirty(spark, sf_dir), ERROR_PLAN))


def rule_errors(spark, sf_dir):
    return repair.rule_errors(orders_dirty(spark, sf_dir), "o_orderkey", ERROR_RULES)


def rule_errors_apart(spark, sf_dir):
    """The broken rows of rules of which some fail."""
    return repair.rule_violations(orders_dirty(spark, sf_dir), "o_orderkey", ERROR_RULES)


def orders_wide(spark, sf_dir):
    """Orders with their customers, nations and regions, of which some have a wrong region, a null nation, or another customer's
    segment."""
    t = {name: table(spark, sf_dir, name) for name in ("orders", "customer", "nation", "region")}
    wide = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    wide = wide.join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("o_orderkey")
    return wide.select(
        "o_orderkey",
        (F.col("o_custkey") % 500).alias("branch"),
        "o_orderstatus",
        "o_orderpriority",
        F.concat_ws("/", "o_orderstatus", F.col("o_orderkey") % 4).alias("desk"),
        F.when(key % 89 != 0, F.col("n_name")).alias("n_name"),
        F.when(key % 97 == 0, "NOWHERE").otherwise(F.col("r_name")).alias("r_name"),
        (F.col("o_orderkey") % 4).alias("shift"),
    )


def rules_found(spark, sf_dir):
    """Columns that all but determine others, in three tables."""
    tables = {"orders_wide": orders_wide(spark, sf_dir), "orders_dirty": orders_dirty(spark, sf_dir), "lineitem": table(spark, sf_dir, "lineitem")}
    return rounded(union([dependencies.rules_found(df, name) for name, df in tables.items()]), "error_share", "base_error")


def rules_found_breaks(spark, sf_dir):
    """Rows that break a rule found in their table."""
    wide = orders_wide(spark, sf_dir)
    return dependencies.rule_breaks(wide, "o_orderkey", sorted(dependencies.find_rules(wide)))


def fix_report(spark, sf_dir):
    report = repair.enhancement_report(orders_dirty(spark, sf_dir), "orders_dirty", PLAN)
    return rounded(report, "average_confidence")


def fix_audit(spark, sf_dir):
    before = orders_dirty(spark, sf_dir)
    return repair.cell_changes(before, repair.apply_fix_plan(before, PLAN), ["o_orderkey"])


def rule_violations(spark, sf_dir):
    return repair.rule_violations(orders_dirty(spark, sf_dir), "o_orderkey", RULES)


def rule_findings(spark, sf_dir):
    return repair.rule_findings(orders_dirty(spark, sf_dir), "o_orderkey", RULES)


def fix_plan_parse(spark, sf_dir):
    """Instructions out of answers that name a fix, leave it out, or hold no JSON."""
    item = F.col("doc_id")
    named = F.concat(
        F.lit('I suggest {"fix_type": "fill_missing", "target_column": "c'),
        item.cast("string"),
        F.lit('", "new_values": ["1", "2"], "predicate": "c > 1", "confidence": 0.5} ok'),
    )
    answer = (
        F.when(item % 4 == 0, named)
        .when(item % 4 == 1, '{"target_column": "a"}')
        .when(item % 4 == 2, '{"fix_type": "recalculate_values", "formula": "c + 1"}')
        .otherwise(issue_answer(item))
    )
    answers = table(spark, sf_dir, "documents").select(item.alias("response_id"), said(answer).alias("response"))
    return repair.parse_fix_plan(answers).withColumn("new_values", F.array_join("new_values", ","))


def repaired(spark, sf_dir):
    """Dirty orders and parts, their issues by profile and by a report, and what the run makes of them."""
    tables = {"orders_dirty": orders_dirty(spark, sf_dir), "part_dirty": part_dirty(spark, sf_dir)}
    found = quality.detect(tables)[0].select("dataset_name", "category", "column", "description", "fix_priority")
    reported = [
        ("part_dirty", "consistency", "p_name", "padded names", 2),
        ("part_dirty", "validity", "p_size", "Negative sizes", 3),
        ("part_dirty", "validity", "p_brand", "odd brands", 3),
        ("absent", "consistency", "x", "no such table", 1),
    ]
    return plans.repair_run(tables, found.unionByName(spark.createDataFrame(reported, found.schema)))


def repair_run(spark, sf_dir):
    log = repaired(spark, sf_dir)[1]
    return log.select(
        "dataset_name", F.col("step").cast("bigint").alias("step"), "fix_type", "target_column", "status", "cells_changed", "rows_removed"
    )


def repair_run_report(spark, sf_dir):
    _, log, reports = repaired(spark, sf_dir)
    return rounded(plans.collection_report(log, reports), "average_confidence")


def repair_run_tables(spark, sf_dir):
    """The repaired tables in figures."""
    fixed_tables = repaired(spark, sf_dir)[0]
    orders, parts = fixed_tables["orders_dirty"], fixed_tables["part_dirty"]
    counts = orders.agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderpriority").isNull()).alias("without_priority"))
    return counts.select(
        "*",
        parts.agg(F.sum("p_size")).scalar().alias("sizes"),
        parts.agg(F.count_if(F.startswith("p_name", F.lit(" ")))).scalar().alias("padded"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        fix_fill,
        fix_replace,
        fix_dedup,
        fix_title,
        fix_abs,
        fix_formula,
        fix_impute,
        fix_impute_grouped,
        fix_impute_median_grouped,
        fix_plan,
        fix_log,
        fix_errors,
        fix_errors_table,
        fix_report,
        fix_audit,
        rule_violations,
        rule_findings,
        rule_errors,
        rule_errors_apart,
        rules_found,
        rules_found_breaks,
        fix_plan_parse,
        repair_run,
        repair_run_report,
        repair_run_tables,
    )
}


def strip_sql(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def title_sql(c: str) -> str:
    runs = rf"regexp_extract_all(lower({strip_sql(c)}), '(\p{{L}}+|\P{{L}}+)')"
    return f"array_to_string([concat(upper(x[1]), x[2:]) for x in {runs}], '')"


DAY = "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate"

# The plan step by step; s0 to s6 follow the order of PLAN.
PLAN_SQL = f"""s0 AS (SELECT * REPLACE (coalesce(o_orderpriority, '5-low') AS o_orderpriority) FROM orders_dirty),
s1 AS (SELECT * REPLACE (abs(o_totalprice) AS o_totalprice) FROM s0),
s2 AS (SELECT * REPLACE ({title_sql("o_orderpriority")} AS o_orderpriority) FROM s1),
s3 AS (SELECT DISTINCT * FROM s2),
s6 AS (SELECT * REPLACE (coalesce(o_totalprice, 0) AS o_totalprice) FROM s3)"""

RULE_SQL = """SELECT o_orderkey, 'price_positive' AS rule_id, 'value_range' AS validation_type,
  'o_totalprice' AS columns_involved, 'critical' AS severity, 'take the absolute value' AS fix_suggestion,
  CAST(0.95 AS DOUBLE) AS confidence FROM orders_dirty WHERE NOT (o_totalprice >= 0)
UNION ALL SELECT o_orderkey, 'open_is_urgent', 'cross_column', 'o_orderstatus,o_orderpriority', 'medium', '', 0.8
  FROM orders_dirty WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"""

LOG_SQL = """log AS (
  SELECT * FROM (VALUES
    (0, 'completeness', 'fill_missing', 'o_orderpriority', 'fill', 'no priority means low', 0.9),
    (1, 'validity', 'add_validation', 'o_totalprice', 'absolute value', 'prices are positive', 0.7),
    (2, 'consistency', 'standardize_format', 'o_orderpriority', 'title case', 'one spelling', 0.8),
    (3, 'uniqueness', 'remove_duplicates', 'multiple', '', '', 0.95),
    (4, 'validity', 'fill_missing', 'o_totalprice', '', '', 0.8),
    (5, 'validity', 'fill_missing', 'o_comment', '', '', 0.8),
    (6, 'completeness', 'replace_values', 'o_totalprice', '', '', 0.0))
    l(step, issue_type, fix_type, target_column, fix_applied, reason, confidence)),
effects(step, cells, removed) AS (
  SELECT 0, (SELECT count(*) FROM orders_dirty WHERE o_orderpriority IS NULL), 0
  UNION ALL SELECT 1, (SELECT count(*) FROM orders_dirty WHERE o_totalprice < 0), 0
  UNION ALL SELECT 2, (SELECT count(*) FROM s1 WHERE o_orderpriority <> TITLE), 0
  UNION ALL SELECT 3, 0, (SELECT count(*) FROM s2) - (SELECT count(*) FROM s3)
  UNION ALL SELECT 4, 0, 0 UNION ALL SELECT 5, 0, 0
  UNION ALL SELECT 6, (SELECT count(*) FROM s3 WHERE o_totalprice IS NULL), 0),
full_log AS (
  SELECT CAST(l.step AS BIGINT) AS step, 'orders_dirty' AS dataset_name, issue_type, fix_type, target_column,
    fix_applied, reason, CAST(confidence AS DOUBLE) AS confidence, CAST(cells AS BIGINT) AS cells_changed,
    CAST(removed AS BIGINT) AS rows_removed, CAST(0 AS BIGINT) AS rows_failed,
    CASE WHEN l.step = 4 THEN 'failed' WHEN cells + removed > 0 THEN 'resolved' ELSE 'no_change' END AS status
  FROM log l JOIN effects e ON l.step = e.step)""".replace("TITLE", title_sql("o_orderpriority"))

ERROR_SQL = """e3 AS (SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM orders_dirty),
e4 AS (SELECT * REPLACE (CASE WHEN o_totalprice < 0 THEN -1 ELSE o_totalprice END AS o_totalprice) FROM e3),
e5 AS (SELECT DISTINCT * FROM e4)"""

WIDE_SQL = """orders_wide AS (
  SELECT o_orderkey, o_custkey % 500 AS branch, o_orderstatus, o_orderpriority, concat(o_orderstatus, '/', CAST(o_orderkey % 4 AS VARCHAR)) AS desk,
    CASE WHEN o_orderkey % 89 <> 0 THEN n_name END AS n_name, CASE WHEN o_orderkey % 97 = 0 THEN 'NOWHERE' ELSE r_name END AS r_name,
    o_orderkey % 4 AS shift
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
WIDE = ["o_orderkey", "branch", "o_orderstatus", "o_orderpriority", "desk", "n_name", "r_name", "shift"]
LINES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINES += ["l_returnflag", "l_linestatus", "l_shipdate"]


def tried_sql(name: str, columns: list[str]) -> str:
    """Figures of all rules of one and two columns of a table, whatever they are good for."""
    sets = [(a,) for a in columns] + [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    return "\nUNION ALL ".join(
        f"""SELECT '{name}' AS dataset_name, '{", ".join(by)}' AS determinants, {len(by)} AS level, '{y}' AS target, count(*) AS groups, sum(kept) AS kept
  FROM (SELECT max(c) AS kept FROM (SELECT {", ".join(by)}, count(*) AS c FROM {name} GROUP BY {", ".join(by)}, {y}) GROUP BY {", ".join(by)})"""
        for by in sets
        for y in columns
        if y not in by
    )


def rules_sql(name: str, columns: list[str]) -> str:
    """The rules among them."""
    alone = "\nUNION ALL ".join(f"SELECT '{y}' AS target, max(c) AS kept FROM (SELECT count(*) AS c FROM {name} GROUP BY {y})" for y in columns)
    return f"""(WITH tried AS ({tried_sql(name, columns)}), alone AS ({alone}), whole AS (SELECT count(*) AS n FROM {name}),
good AS (
  SELECT t.*, n, 1 - t.kept / n AS error_share, 1 - a.kept / n AS base_error FROM tried t JOIN alone a USING (target), whole
  WHERE a.kept < n AND t.groups <= 0.5 * n AND (n - t.kept) / n <= least(0.05, 0.5 * ((n - a.kept) / n)))
SELECT dataset_name, determinants, target, CAST(n AS BIGINT) AS total_records, groups, CAST(n - kept AS BIGINT) AS violations,
  CAST(floor(error_share * 10000 + 0.5) / 10000 AS DOUBLE) AS error_share, CAST(floor(base_error * 10000 + 0.5) / 10000 AS DOUBLE) AS base_error
  FROM good g WHERE level = 1 OR NOT EXISTS (SELECT 1 FROM good s WHERE s.level = 1 AND s.target = g.target
    AND list_contains(string_split(g.determinants, ', '), s.determinants)))"""


def breaks_sql(columns: list[str]) -> str:
    sets = [(a,) for a in columns] + [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    return "\nUNION ALL ".join(
        f"""SELECT d.o_orderkey AS key, '{", ".join(by)} -> {y}' AS rule, CAST(d.{y} AS VARCHAR) AS value, expected, expected_rows, group_rows
  FROM orders_wide d JOIN (
    SELECT {", ".join(by)}, CAST(sum(c) AS BIGINT) AS group_rows, arg_min([v], (-c, coalesce('=' || v, '')))[1] AS expected, max(c) AS expected_rows
    FROM (SELECT {", ".join(by)}, CAST({y} AS VARCHAR) AS v, count(*) AS c FROM orders_wide GROUP BY ALL)
    GROUP BY {", ".join(by)}) g ON {" AND ".join(f"g.{x} IS NOT DISTINCT FROM d.{x}" for x in by)}
  WHERE CAST(d.{y} AS VARCHAR) IS DISTINCT FROM expected AND '{", ".join(by)} -> {y}' IN (SELECT determinants || ' -> ' || target FROM rules)"""
        for by in sets
        for y in columns
        if y not in by
    )


ORACLES = {
    "rules_found": with_views("orders_dirty", WIDE_SQL)
    + union_all(f"SELECT * FROM {rules_sql(name, columns)}" for name, columns in (("orders_wide", WIDE), ("orders_dirty", DIRTY), ("lineitem", LINES))),
    "rules_found_breaks": with_views(WIDE_SQL, f"rules AS (SELECT * FROM {rules_sql('orders_wide', WIDE)})") + breaks_sql(WIDE),
    "fix_errors": with_views("orders_dirty", ERROR_SQL)
    + """SELECT CAST(step AS BIGINT) AS step, fix_type, target_column, status, CAST(cells AS BIGINT) AS cells_changed,
  CAST(removed AS BIGINT) AS rows_removed, CAST(bad AS BIGINT) AS rows_failed FROM (
  SELECT 0 AS step, 'recalculate_values' AS fix_type, 'o_totalprice' AS target_column, 'error' AS status, 0 AS cells, 0 AS removed,
    (SELECT count(*) FROM orders_dirty WHERE o_custkey % 5 = 0 AND o_totalprice IS NOT NULL) AS bad
  UNION ALL SELECT 1, 'recalculate_values', 'o_custkey', 'error', 0, 0, (SELECT count(*) FROM orders_dirty WHERE o_custkey > 9)
  UNION ALL SELECT 2, 'replace_values', 'o_totalprice', 'error', 0, 0, (SELECT count(*) FROM orders_dirty WHERE o_orderpriority IS NOT NULL)
  UNION ALL SELECT 3, 'recalculate_values', 'o_totalprice', 'resolved', (SELECT count(*) FROM orders_dirty WHERE o_totalprice <> 0), 0, 0
  UNION ALL SELECT 4, 'replace_values', 'o_totalprice', 'resolved', (SELECT count(*) FROM e3 WHERE o_totalprice < 0 AND o_totalprice <> -1), 0, 0
  UNION ALL SELECT 5, 'remove_duplicates', NULL, 'resolved', 0, (SELECT count(*) FROM e4) - (SELECT count(*) FROM e5), 0
  UNION ALL SELECT 6, 'recalculate_values', 'o_totalprice', 'error', 0, 0, (SELECT count(*) FROM e5 WHERE o_totalprice = -1)
  UNION ALL SELECT 7, 'recalculate_values', 'o_totalprice', 'error', 0, 0, 0
  UNION ALL SELECT 8, 'fill_missing', 'o_orderpriority', 'resolved', (SELECT count(*) FROM e5 WHERE o_orderpriority IS NULL), 0, 0)""",
    "fix_errors_table": with_views("orders_dirty", ERROR_SQL)
    + f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {DAY}, coalesce(o_orderpriority, 'none') AS o_orderpriority FROM e5""",
    "rule_errors": with_views("orders_dirty")
    + """SELECT 'urgent_number' AS rule_id, 'format' AS validation_type, 'CAST(o_orderpriority AS INT) > 0' AS predicate,
  'fails' AS reason, count(*) AS failed_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
  FROM orders_dirty WHERE o_orderpriority IS NOT NULL
UNION ALL SELECT 'share_of_price', 'cross_column', 'o_totalprice / (o_custkey % 5) > 0', 'fails', count(*), min(o_orderkey), max(o_orderkey)
  FROM orders_dirty WHERE o_custkey % 5 = 0 AND o_totalprice IS NOT NULL
UNION ALL SELECT 'no_such_column', 'format', 'absent > 0', 'unresolved', 0, NULL, NULL
UNION ALL SELECT 'no_condition', 'format', 'o_custkey + 1', 'unresolved', 0, NULL, NULL""",
    "rule_errors_apart": with_views("orders_dirty")
    + """SELECT o_orderkey, 'price_positive' AS rule_id, 'value_range' AS validation_type,
  'o_totalprice' AS columns_involved, 'critical' AS severity, 'take the absolute value' AS fix_suggestion,
  CAST(0.95 AS DOUBLE) AS confidence FROM orders_dirty WHERE NOT (o_totalprice >= 0)
UNION ALL SELECT o_orderkey, 'share_of_price', 'cross_column', 'o_totalprice,o_custkey', 'medium', '', 0.8
  FROM orders_dirty WHERE o_custkey % 5 <> 0 AND NOT (o_totalprice > 0)""",
    "fix_fill": with_views("orders_dirty")
    + f"""SELECT o_orderkey, o_custkey, o_orderstatus, coalesce(o_totalprice, 0) AS o_totalprice, {DAY},
  coalesce(o_orderpriority, 'unknown') AS o_orderpriority FROM orders_dirty""",
    "fix_replace": with_views("part_dirty")
    + """SELECT * REPLACE (coalesce(p_name, 'none') AS p_name, CAST(CASE WHEN p_size < 0 THEN 0 ELSE p_size END AS INT)
  AS p_size) FROM part_dirty""",
    "fix_dedup": with_views("orders_dirty")
    + f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {DAY}, o_orderpriority
  FROM (SELECT DISTINCT * FROM orders_dirty)""",
    "fix_title": with_views("part_dirty")
    + f"SELECT * REPLACE ({title_sql('p_name')} AS p_name) FROM part_dirty",
    "fix_abs": with_views("part_dirty") + "SELECT * REPLACE (abs(p_size) AS p_size) FROM part_dirty",
    "fix_formula": f"""SELECT * EXCLUDE (l_shipdate),
  {r4("l_extendedprice * (1 - l_discount) * (1 + l_tax)")} AS l_charge FROM lineitem""",
    "fix_impute": with_views("orders_dirty")
    + f"""SELECT o_orderkey, o_custkey, o_orderstatus,
  {r4("coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM orders_dirty))")} AS o_totalprice, {DAY},
  coalesce(o_orderpriority, (SELECT o_orderpriority FROM orders_dirty WHERE o_orderpriority IS NOT NULL
    GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1)) AS o_orderpriority
  FROM orders_dirty""",
    "fix_impute_grouped": with_views("orders_dirty")
    + f"""SELECT o_orderkey, o_custkey, o_orderstatus,
  CAST(floor(coalesce(o_totalprice, avg(o_totalprice) OVER (PARTITION BY o_orderstatus)) * 100 + 0.5) / 100 AS DOUBLE)
    AS o_totalprice, {DAY},
  coalesce(o_orderpriority, (SELECT o_orderpriority FROM orders_dirty i WHERE o_orderpriority IS NOT NULL
    AND i.o_orderstatus = d.o_orderstatus
    GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1)) AS o_orderpriority
  FROM orders_dirty d""",
    "fix_impute_median_grouped": f"""WITH d AS (
  SELECT CASE WHEN l_orderkey % 3 <> 0 THEN l_orderkey END AS grp, l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_linenumber % 3 <> 0 AND l_orderkey % 50 <> 1 THEN l_extendedprice END AS price,
    CASE WHEN l_linenumber % 3 <> 0 AND l_orderkey % 50 <> 1 THEN CAST(l_quantity AS INT) END AS pieces FROM lineitem),
m AS (SELECT grp, quantile_cont(price, 0.5) AS price, quantile_cont(CAST(pieces AS DOUBLE), 0.5) AS pieces FROM d GROUP BY grp),
w AS (SELECT quantile_cont(price, 0.5) AS price, quantile_cont(CAST(pieces AS DOUBLE), 0.5) AS pieces FROM d)
SELECT d.grp, l_orderkey, l_linenumber, l_partkey, {r4("coalesce(d.price, m.price, w.price)")} AS price,
  {r4("coalesce(d.pieces, m.pieces, w.pieces)")} AS pieces
  FROM d JOIN m ON m.grp IS NOT DISTINCT FROM d.grp, w""",
    "fix_plan": with_views("orders_dirty", PLAN_SQL)
    + f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {DAY}, o_orderpriority FROM s6",
    "fix_log": with_views("orders_dirty", PLAN_SQL, LOG_SQL) + "SELECT * FROM full_log",
    "fix_report": with_views("orders_dirty", PLAN_SQL, LOG_SQL)
    + f"""SELECT 'orders_dirty' AS dataset_name, (SELECT count(*) FROM orders_dirty) AS rows_before,
  (SELECT count(*) FROM s6) AS rows_after, (SELECT count(*) FROM s6) - (SELECT count(*) FROM orders_dirty) AS row_change,
  CAST(6 AS BIGINT) AS columns_before, CAST(6 AS BIGINT) AS columns_after, count(*) AS issues_addressed,
  count(*) FILTER (WHERE status = 'resolved') AS fixes_applied,
  count(*) FILTER (WHERE status = 'no_change') AS fixes_without_effect,
  count(*) FILTER (WHERE status = 'failed') AS fixes_failed,
  {r4("avg(nullif(confidence, 0)) FILTER (WHERE status <> 'failed')")} AS average_confidence FROM full_log""",
    "fix_audit": with_views("orders_dirty", PLAN_SQL)
    + union_all(
        f"""SELECT '{c}' AS "column", count(*) AS rows_compared, CAST(0 AS BIGINT) AS rows_gone,
    CAST(0 AS BIGINT) AS rows_unclear, count(*) FILTER (WHERE b.{c} IS DISTINCT FROM a.{c}) AS changed
    FROM orders_dirty b JOIN s6 a ON b.o_orderkey = a.o_orderkey"""
        for c in ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    ),
    "rule_violations": with_views("orders_dirty") + RULE_SQL,
    "rule_findings": with_views("orders_dirty", f"v AS ({RULE_SQL})")
    + """SELECT rule_id, validation_type, columns_involved, severity, fix_suggestion, confidence,
  count(*) AS affected_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
  FROM v GROUP BY rule_id, validation_type, columns_involved, severity, fix_suggestion, confidence""",
    "fix_plan_parse": """SELECT doc_id AS response_id,
  CASE doc_id % 4 WHEN 0 THEN 'fill_missing' ELSE 'recalculate_values' END AS fix_type,
  CASE doc_id % 4 WHEN 0 THEN 'c > 1' END AS predicate, CASE doc_id % 4 WHEN 2 THEN 'c + 1' END AS formula,
  CASE doc_id % 4 WHEN 0 THEN concat('c', CAST(doc_id AS VARCHAR)) END AS target_column,
  CAST(NULL AS VARCHAR) AS fix_logic, CAST(NULL AS VARCHAR) AS implementation_method,
  CASE doc_id % 4 WHEN 0 THEN '1,2' END AS new_values, CAST(NULL AS VARCHAR) AS conditions,
  CAST(NULL AS VARCHAR) AS expected_outcome, CAST(NULL AS VARCHAR) AS medical_reasoning,
  CAST(CASE doc_id % 4 WHEN 0 THEN 0.5 ELSE 0.8 END AS DOUBLE) AS confidence
  FROM documents WHERE doc_id % 4 IN (0, 2)""",
    "repair_run": with_views("orders_dirty", "part_dirty", "d AS (SELECT DISTINCT * FROM orders_dirty)")
    + f"""SELECT 'orders_dirty' AS dataset_name, CAST(0 AS BIGINT) AS step, 'remove_duplicates' AS fix_type,
  CAST(NULL AS VARCHAR) AS target_column, 'resolved' AS status, CAST(0 AS BIGINT) AS cells_changed,
  (SELECT count(*) FROM orders_dirty) - (SELECT count(*) FROM d) AS rows_removed
UNION ALL SELECT 'orders_dirty', 1, 'fill_missing', 'o_orderpriority', 'resolved', count(*), 0 FROM d WHERE o_orderpriority IS NULL
UNION ALL SELECT 'part_dirty', 0, 'standardize_format', 'p_name', 'resolved', count(*), 0 FROM part_dirty
  WHERE p_name <> {title_sql("p_name")}
UNION ALL SELECT 'part_dirty', 1, 'add_validation', 'p_size', 'resolved', count(*), 0 FROM part_dirty WHERE p_size < 0""",
    "repair_run_report": with_views("orders_dirty", "d AS (SELECT DISTINCT * FROM orders_dirty)")
    + f"""SELECT CAST(2 AS BIGINT) AS tables, CAST(2 AS BIGINT) AS tables_enhanced, CAST(4 AS BIGINT) AS issues_addressed,
  CAST(4 AS BIGINT) AS fixes_applied, CAST(0 AS BIGINT) AS fixes_without_effect, CAST(0 AS BIGINT) AS fixes_failed,
  (SELECT count(*) FROM orders_dirty) - (SELECT count(*) FROM d) AS rows_removed,
  {r4("(0.95 + 0.7 + 0.8 + 0.6) / 4")} AS average_confidence""",
    "repair_run_tables": with_views("orders_dirty", "part_dirty")
    + """SELECT (SELECT count(*) FROM (SELECT DISTINCT * FROM orders_dirty)) AS orders, CAST(0 AS BIGINT) AS without_priority,
  (SELECT CAST(sum(abs(p_size)) AS BIGINT) FROM part_dirty) AS sizes, CAST(0 AS BIGINT) AS padded""",
}
