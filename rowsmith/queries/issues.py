"""Issue, score and risk queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.functions.columns import fixed
from rowsmith.operators import issues
from rowsmith.plans import quality
from rowsmith.queries.profiles import (
    high_missing_sql,
    outliers_sql,
    r4,
    rounded,
    uniqueness_sql,
    union_all,
)
from rowsmith.queries.views import issue_responses, orders_dirty, table, with_views
from rowsmith.sources.shared import new_path


def checked_tables(spark, sf_dir):
    """The tables judged together: dirty orders, events and line items."""
    return {
        "orders_dirty": orders_dirty(spark, sf_dir),
        "events": table(spark, sf_dir, "events"),
        "lineitem": table(spark, sf_dir, "lineitem"),
    }


def found_issues(spark, sf_dir):
    return quality.detect(checked_tables(spark, sf_dir))[0]


def scores_of(spark, sf_dir):
    found, stats = quality.detect(checked_tables(spark, sf_dir))
    return issues.quality_scores(found, stats)


def shown(df):
    """Issues with their examples as one text and rounded percentages."""
    return df.withColumns(
        {
            "example_values": F.array_join("example_values", "|"),
            "percentage_affected": fixed(F.col("percentage_affected")),
        }
    )


def issues_detect(spark, sf_dir):
    return shown(found_issues(spark, sf_dir))


def issues_parse(spark, sf_dir):
    answers = issue_responses(spark, sf_dir)
    rows = orders_dirty(spark, sf_dir).agg(F.count(F.lit(1))).scalar()
    parsed = shown(issues.parse_issues(answers, total_records=rows))
    return parsed.withColumn("position", F.col("position").cast("bigint"))


def quality_score(spark, sf_dir):
    return rounded(scores_of(spark, sf_dir), "missing_percentage", "duplicate_percentage", "quality_score")


def quality_score_domain(spark, sf_dir):
    """Scores with thresholds and weights of a domain and an external score for one table."""
    found, stats = quality.detect(checked_tables(spark, sf_dir))
    weights = issues.severity_weights(spark, [("critical", 30.0), ("high", 12.0), ("medium", 6.0)])
    thresholds = issues.domain_thresholds(spark, [("medical", 5.0, 1.0, 2.0, 0.5)])
    domain = F.when(F.col("dataset_name") == "orders_dirty", "medical").otherwise("general")
    external = stats.filter("dataset_name = 'events'").select(
        "dataset_name", F.least(F.lit(90.0), F.col("total_records") / 100.0).alias("external_score")
    )
    scores = issues.quality_scores(found, stats.withColumn("domain", domain), weights, thresholds, external)
    return rounded(scores, "missing_percentage", "duplicate_percentage", "quality_score")


def error_summary(spark, sf_dir):
    summary = issues.error_summary(found_issues(spark, sf_dir))
    grave = F.transform("most_critical_issues", lambda i: F.concat_ws(":", i["severity"], i["column"]))
    return summary.withColumns(
        {
            "categories": F.array_join("categories", ","),
            "columns": F.array_join("columns", ","),
            "most_critical_issues": F.array_join(F.array_sort(grave), ","),
        }
    )


def issue_categories(spark, sf_dir):
    return issues.category_counts(found_issues(spark, sf_dir))


def risk_level(spark, sf_dir):
    return issues.risk_levels(found_issues(spark, sf_dir))


def critical_issues(spark, sf_dir):
    return shown(issues.critical_issues(found_issues(spark, sf_dir)))


def priority_issues(spark, sf_dir):
    return shown(issues.priority_issues(found_issues(spark, sf_dir)))


def priority_tables(spark, sf_dir):
    low = issues.priority_tables(scores_of(spark, sf_dir), limit=95.0)
    return rounded(low, "missing_percentage", "duplicate_percentage", "quality_score")


def top_issues(spark, sf_dir):
    best = issues.top_issues(found_issues(spark, sf_dir))
    return shown(best).withColumn("issue_rank", F.col("issue_rank").cast("bigint"))


def first_critical(spark, sf_dir):
    return shown(issues.first_critical(found_issues(spark, sf_dir)))


def strict_issues(spark, sf_dir):
    """The issues by a stricter scale: repeated or telling values, and issues of a fifth of the rows, are critical, others high."""
    grave = (F.col("category") == "uniqueness") | (F.col("percentage_affected") >= 20)
    return found_issues(spark, sf_dir).withColumn("severity", F.when(grave, "critical").otherwise("high"))


def critical_issues_strict(spark, sf_dir):
    return shown(issues.critical_issues(strict_issues(spark, sf_dir)))


def top_issues_strict(spark, sf_dir):
    best = issues.top_issues(strict_issues(spark, sf_dir))
    return shown(best).withColumn("issue_rank", F.col("issue_rank").cast("bigint"))


def first_critical_strict(spark, sf_dir):
    return shown(issues.first_critical(strict_issues(spark, sf_dir)))


def risk_level_strict(spark, sf_dir):
    return issues.risk_levels(strict_issues(spark, sf_dir))


def fitness_label(spark, sf_dir):
    return issues.fitness_labels(scores_of(spark, sf_dir)).select("dataset_name", "fitness")


def quality_report(spark, sf_dir):
    report = quality.quality_report(checked_tables(spark, sf_dir))
    return rounded(report, "missing_percentage", "duplicate_percentage", "quality_score")


#: The condition in the message of an error, or another reason.
REASON = "([A-Z][A-Z_]+[A-Z]|no rows)"


def damaged(spark, sf_dir):
    """Regions in a file that is no Parquet, read as if it were."""
    path = new_path(spark, "damaged")
    table(spark, sf_dir, "region").select(F.concat(F.lit("PAR1"), "r_name").alias("value")).write.text(path)
    return spark.read.schema("r_regionkey int, r_name string").parquet(path)


def quality_report_failing(spark, sf_dir):
    """The report over tables of which one can not be read, one fails on its rows, and one has none."""
    tables = checked_tables(spark, sf_dir) | {
        "damaged": damaged(spark, sf_dir),
        "odd_text": table(spark, sf_dir, "orders").select(F.col("o_orderpriority").cast("int").alias("number")),
        "none": table(spark, sf_dir, "nation").limit(0),
    }
    report = rounded(quality.quality_report(tables), "missing_percentage", "duplicate_percentage", "quality_score")
    return report.withColumn("score_reason", F.regexp_extract("score_reason", REASON, 1))


def quality_report_all_failing(spark, sf_dir):
    """The report where no table can be read: a row with the reason for each."""
    report = quality.quality_report({name: damaged(spark, sf_dir) for name in ("first", "second")})
    return report.withColumn("score_reason", F.regexp_extract("score_reason", REASON, 1))


QUERIES = {
    f.__name__: f
    for f in (
        issues_detect,
        issues_parse,
        quality_score,
        quality_score_domain,
        error_summary,
        issue_categories,
        risk_level,
        critical_issues,
        priority_issues,
        priority_tables,
        top_issues,
        first_critical,
        critical_issues_strict,
        top_issues_strict,
        first_critical_strict,
        risk_level_strict,
        fitness_label,
        quality_report,
        quality_report_failing,
        quality_report_all_failing,
    )
}

TABLE_COLUMNS = {
    "orders_dirty": (
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        ["o_orderkey", "o_custkey", "o_totalprice"],
    ),
    "events": (["event_id", "ts", "user_id", "event_type", "value", "props"], ["event_id", "user_id", "value"]),
    "lineitem": (
        [
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_tax",
            "l_returnflag",
            "l_linestatus",
            "l_shipdate",
        ],
        [
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_tax",
        ],
    ),
}


def stats_sql(t: str) -> str:
    columns = TABLE_COLUMNS[t][0]
    cells = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in columns)
    copies = f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {t}))"
    return f"""SELECT '{t}' AS dataset_name, count(*) AS total_records,
    ({cells}) / (count(*) * {len(columns)}) * 100 AS missing_percentage,
    count(*) - {copies} AS duplicate_rows, (count(*) - {copies}) / count(*) * 100 AS duplicate_percentage FROM {t}"""


STATS_SQL = "stats AS (" + union_all(stats_sql(t) for t in TABLE_COLUMNS) + ")"

ALL_FLAGS_SQL = f"""flags AS (
  SELECT dataset_name, "column", 'missing' AS flag, missing_percentage AS share,
    printf('High missing data: %.1f%%', missing_percentage) AS message, '' AS examples
  FROM ({union_all(high_missing_sql(t, c) for t in TABLE_COLUMNS for c in TABLE_COLUMNS[t][0])})
  UNION ALL SELECT dataset_name, "column", 'uniqueness', 100.0,
    printf('Low uniqueness: %.1f%%', unique_percentage), ''
  FROM ({union_all(uniqueness_sql(t, c) for t in TABLE_COLUMNS for c in TABLE_COLUMNS[t][1])})
  UNION ALL SELECT dataset_name, "column", 'outliers', outlier_percentage,
    printf('High outlier rate: %d/%d', outliers, total_records), printf('%.2f|%.2f', smallest, largest)
  FROM ({union_all(outliers_sql(t, c) for t in TABLE_COLUMNS for c in TABLE_COLUMNS[t][1])})
  UNION ALL SELECT dataset_name, CAST(NULL AS VARCHAR), 'duplicates', duplicate_percentage,
    printf('Duplicate rows: %.1f%%', duplicate_percentage), ''
  FROM stats WHERE duplicate_percentage > 5)"""

RULES_SQL = (
    "rules(flag, from_pct, to_pct, severity, category, recommendation, fix_priority) AS (VALUES "
    + ", ".join(
        f"('{f}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE), '{s}', '{c}', '{r}', CAST({p} AS BIGINT))"
        for f, a, b, s, c, r, p in issues.ISSUE_RULES
    )
    + ")"
)

ISSUES_SQL = """issues AS (
  SELECT f.dataset_name, f."column", r.severity, r.category, f.message AS description,
    CAST(f.share AS DOUBLE) AS percentage_affected,
    CAST(trunc((CAST(f.share AS DOUBLE) / 100) * s.total_records) AS BIGINT) AS affected_records,
    r.recommendation, r.fix_priority, f.examples AS example_values
  FROM flags f JOIN stats s ON f.dataset_name = s.dataset_name
  JOIN rules r ON f.flag = r.flag AND f.share >= r.from_pct AND f.share < r.to_pct)"""

BASE = ("orders_dirty", STATS_SQL, ALL_FLAGS_SQL, RULES_SQL, ISSUES_SQL)

SCORES_SQL = """scores AS (
  SELECT s.dataset_name, s.total_records, s.missing_percentage, s.duplicate_percentage,
    greatest(0.0, least(100.0, 100 - coalesce(d.deduction, 0)
      - CASE WHEN s.missing_percentage > 10 THEN (s.missing_percentage - 10) * 0.5 ELSE 0 END
      - CASE WHEN s.duplicate_percentage > 5 THEN (s.duplicate_percentage - 5) * 0.3 ELSE 0 END)) AS quality_score
  FROM stats s LEFT JOIN (
    SELECT dataset_name, sum(CASE severity WHEN 'critical' THEN 20 WHEN 'high' THEN 10 WHEN 'medium' THEN 5
      WHEN 'low' THEN 2 ELSE 5 END * percentage_affected / 100) AS deduction
    FROM issues GROUP BY dataset_name) d ON s.dataset_name = d.dataset_name)"""

COUNTS_SQL = """counts AS (
  SELECT dataset_name, count(*) AS total_issues,
    count(*) FILTER (WHERE severity = 'critical') AS critical_issues,
    count(*) FILTER (WHERE severity = 'high') AS high_issues,
    count(*) FILTER (WHERE severity = 'medium') AS medium_issues,
    count(*) FILTER (WHERE severity = 'low') AS low_issues,
    count(*) FILTER (WHERE severity NOT IN ('critical', 'high', 'medium', 'low')) AS other_issues,
    count(DISTINCT "column") AS columns_with_issues
  FROM issues GROUP BY dataset_name)"""

RISK = """CASE WHEN critical_issues > 0 THEN 'critical' WHEN high_issues > 2 THEN 'high'
  WHEN medium_issues > 5 THEN 'medium' ELSE 'low' END"""

ISSUE_COLUMNS = f"""dataset_name, "column", severity, category, description,
  {r4("percentage_affected")} AS percentage_affected, affected_records, recommendation, fix_priority, example_values"""

SCORE_COLUMNS = f"""dataset_name, total_records, {r4("missing_percentage")} AS missing_percentage,
  {r4("duplicate_percentage")} AS duplicate_percentage, {r4("quality_score")} AS quality_score"""

REPORT_SQL = (
    with_views(*BASE, SCORES_SQL, COUNTS_SQL)
    + f"""SELECT {SCORE_COLUMNS},
  CASE WHEN quality_score >= 75 THEN 'high' WHEN quality_score >= 50 THEN 'medium' ELSE 'low' END AS fitness,
  coalesce(total_issues, 0) AS total_issues, coalesce(critical_issues, 0) AS critical_issues,
  coalesce(high_issues, 0) AS high_issues, coalesce(medium_issues, 0) AS medium_issues,
  coalesce(low_issues, 0) AS low_issues, coalesce(other_issues, 0) AS other_issues,
  coalesce(columns_with_issues, 0) AS columns_with_issues, {RISK} AS risk_level, CAST(NULL AS VARCHAR) AS score_reason
  FROM scores LEFT JOIN counts USING (dataset_name)"""
)

STRICT_SQL = """strict AS (
  SELECT * REPLACE (CASE WHEN category = 'uniqueness' OR percentage_affected >= 20 THEN 'critical' ELSE 'high' END AS severity) FROM issues)"""

ORACLES = {
    "critical_issues_strict": with_views(*BASE, STRICT_SQL) + f"SELECT {ISSUE_COLUMNS} FROM strict WHERE severity = 'critical'",
    "top_issues_strict": with_views(*BASE, STRICT_SQL)
    + f"""SELECT {ISSUE_COLUMNS}, issue_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset_name ORDER BY fix_priority, percentage_affected DESC,
    "column" NULLS LAST, category, description) AS issue_rank
  FROM strict WHERE severity IN ('critical', 'high')) WHERE issue_rank <= 3""",
    "first_critical_strict": with_views(*BASE, STRICT_SQL)
    + f"""SELECT {ISSUE_COLUMNS} FROM (SELECT * FROM strict WHERE severity = 'critical'
  ORDER BY dataset_name, fix_priority, "column" NULLS FIRST, description LIMIT 5)""",
    "risk_level_strict": with_views(*BASE, STRICT_SQL, COUNTS_SQL.replace("FROM issues", "FROM strict"))
    + f"SELECT dataset_name, total_issues, {RISK} AS risk_level FROM counts",
    "issues_detect": with_views(*BASE) + f"SELECT {ISSUE_COLUMNS} FROM issues",
    "issues_parse": with_views("orders_dirty", "issue_responses", "n AS (SELECT count(*) AS total FROM orders_dirty)")
    + f"""SELECT response_id, CAST(0 AS BIGINT) AS position, severity, category, description, "column",
  CAST(trunc(pct / 100 * total) AS BIGINT) AS affected_records, {r4("pct")} AS percentage_affected,
  recommendation, fix_priority, example_values FROM (
    SELECT response_id, 'high' AS severity, 'validity' AS category, 'Quality issue detected' AS description,
      'o_totalprice' AS "column", CAST(regexp_extract(response, 'percentage":([0-9.]+)', 1) AS DOUBLE) AS pct,
      'Manual review required' AS recommendation, CAST(2 AS BIGINT) AS fix_priority, '' AS example_values
    FROM issue_responses WHERE response_id % 4 = 0
    UNION ALL SELECT response_id, 'medium', 'general', 'Quality issue detected', NULL, 0,
      'Manual review required', 3, '' FROM issue_responses WHERE response_id % 4 = 1), n""",
    "quality_score": with_views(*BASE, SCORES_SQL) + f"SELECT {SCORE_COLUMNS} FROM scores",
    "quality_score_domain": with_views(
        *BASE,
        """scores AS (
  SELECT dataset_name, total_records, missing_percentage, duplicate_percentage,
    greatest(0.0, least(100.0, CASE WHEN dataset_name = 'events'
      THEN base * 0.6 + least(90.0, total_records / 100) * 0.4 ELSE base END)) AS quality_score FROM (
  SELECT s.*, 100 - coalesce(d.deduction, 0) - CASE WHEN s.dataset_name = 'orders_dirty' THEN
      greatest(0, s.missing_percentage - 5) + greatest(0, s.duplicate_percentage - 2) * 0.5
      ELSE greatest(0, s.missing_percentage - 10) * 0.5 + greatest(0, s.duplicate_percentage - 5) * 0.3 END AS base
  FROM stats s LEFT JOIN (
    SELECT dataset_name, sum(CASE severity WHEN 'critical' THEN 30 WHEN 'high' THEN 12 WHEN 'medium' THEN 6
      ELSE 5 END * percentage_affected / 100) AS deduction
    FROM issues GROUP BY dataset_name) d ON s.dataset_name = d.dataset_name))""",
    )
    + f"SELECT {SCORE_COLUMNS} FROM scores",
    "error_summary": with_views(*BASE, COUNTS_SQL)
    + f"""SELECT c.*, (SELECT string_agg(DISTINCT category, ',' ORDER BY category) FROM issues i
    WHERE i.dataset_name = c.dataset_name) AS categories,
  coalesce((SELECT string_agg(DISTINCT "column", ',' ORDER BY "column") FROM issues i
    WHERE i.dataset_name = c.dataset_name), '') AS columns,
  coalesce((SELECT string_agg(v, ',' ORDER BY v) FROM (
    SELECT dataset_name, concat_ws(':', severity, "column") AS v FROM issues
    WHERE severity IN ('critical', 'high')) g WHERE g.dataset_name = c.dataset_name), '') AS most_critical_issues,
  {RISK} AS risk_level FROM counts c""",
    "issue_categories": with_views(*BASE)
    + "SELECT dataset_name, category, count(*) AS issue_count FROM issues GROUP BY dataset_name, category",
    "risk_level": with_views(*BASE, COUNTS_SQL)
    + f"SELECT dataset_name, total_issues, {RISK} AS risk_level FROM counts",
    "critical_issues": with_views(*BASE) + f"SELECT {ISSUE_COLUMNS} FROM issues WHERE severity = 'critical'",
    "priority_issues": with_views(*BASE)
    + f"SELECT {ISSUE_COLUMNS} FROM issues WHERE severity IN ('critical', 'high') AND fix_priority <= 2",
    "priority_tables": with_views(*BASE, SCORES_SQL) + f"SELECT {SCORE_COLUMNS} FROM scores WHERE quality_score < 95",
    "top_issues": with_views(*BASE)
    + f"""SELECT {ISSUE_COLUMNS}, issue_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset_name ORDER BY fix_priority, percentage_affected DESC,
    "column" NULLS LAST, category, description) AS issue_rank
  FROM issues WHERE severity IN ('critical', 'high')) WHERE issue_rank <= 3""",
    "first_critical": with_views(*BASE)
    + f"""SELECT {ISSUE_COLUMNS} FROM (SELECT * FROM issues WHERE severity = 'critical'
  ORDER BY dataset_name, fix_priority, "column" NULLS FIRST, description LIMIT 5)""",
    "fitness_label": with_views(*BASE, SCORES_SQL)
    + """SELECT dataset_name, CASE WHEN quality_score >= 75 THEN 'high' WHEN quality_score >= 50 THEN 'medium'
  ELSE 'low' END AS fitness FROM scores""",
    "quality_report": REPORT_SQL,
    "quality_report_failing": f"""SELECT * FROM ({REPORT_SQL})
UNION ALL BY NAME SELECT dataset_name, CAST(total AS BIGINT) AS total_records, CAST(total AS BIGINT) AS total_issues,
  CAST(total AS BIGINT) AS critical_issues, CAST(total AS BIGINT) AS high_issues, CAST(total AS BIGINT) AS medium_issues,
  CAST(total AS BIGINT) AS low_issues, CAST(total AS BIGINT) AS other_issues, CAST(total AS BIGINT) AS columns_with_issues, score_reason
  FROM (VALUES ('none', 0, 'no rows'), ('damaged', NULL, 'FAILED_READ_FILE'), ('odd_text', NULL, 'CAST_INVALID_INPUT'))
    f(dataset_name, total, score_reason)""",
    "quality_report_all_failing": f"""SELECT * FROM ({REPORT_SQL}) WHERE dataset_name IS NULL
UNION ALL BY NAME SELECT unnest(['first', 'second']) AS dataset_name, 'FAILED_READ_FILE' AS score_reason""",
}
