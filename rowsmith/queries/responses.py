"""Queries over reports, answers and evidence documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.operators import reports
from rowsmith.queries.profiles import DIRTY, FLAGS_SQL, r4, rounded, union_all
from rowsmith.queries.views import issue_answer, issue_reports, issue_responses, orders_dirty, said, table, with_views


def report_issues(spark, sf_dir):
    rows = reports.flatten_report_issues(issue_reports(spark, sf_dir))
    return rows.withColumn("position", F.col("position").cast("bigint"))


def response_parse(spark, sf_dir):
    """Answers read as a list of issues: status and size."""
    parsed = reports.parse_responses(issue_responses(spark, sf_dir), "array<struct<severity:string, priority:double>>")
    return parsed.select(
        "response_id",
        "status",
        F.when(F.col("answer").isNotNull(), F.size("answer")).cast("bigint").alias("entries"),
        F.col("answer")[0]["severity"].alias("first_severity"),
    )


def recommendations(spark, sf_dir):
    """Recommendations out of answers with a list of texts, without a list, with a broken list."""
    item = F.col("doc_id")
    listed = F.concat(F.lit('Do this: ["check row '), item.cast("string"), F.lit('", "fill gaps"]'))
    answer = F.when(item % 4 < 2, listed).otherwise(issue_answer(item))
    answers = table(spark, sf_dir, "documents").select(item.alias("response_id"), said(answer).alias("response"))
    return reports.recommendations(answers).withColumn("position", F.col("position").cast("bigint"))


def evidence(spark, sf_dir):
    """The evidence document, opened again: figures of the columns as they stand in it."""
    document = reports.evidence(orders_dirty(spark, sf_dir), "orders_dirty", "o_orderkey")
    schema = (
        "struct<basic_stats:struct<total_records:bigint>,"
        " column_summary:array<struct<column:string, null_count:bigint, unique_count:bigint>>,"
        " problematic_patterns:array<struct<column:string, issues:array<string>>>>"
    )
    opened = document.select("dataset_name", F.from_json("evidence", schema).alias("e"))
    problems = F.map_from_entries(
        F.transform("e.problematic_patterns", lambda p: F.struct(p["column"], F.array_join(p["issues"], "; ")))
    )
    return opened.select(
        "dataset_name", "e.basic_stats.total_records", problems.alias("p"), F.inline("e.column_summary")
    ).select(
        "dataset_name", "total_records", "column", "null_count", "unique_count", F.col("p")[F.col("column")].alias("issues")
    )


FIGURES = {
    "mean_value": "avg({})",
    "std_value": "stddev_samp({})",
    "min_value": "min({})",
    "q25": "quantile_cont({}, 0.25)",
    "q50": "quantile_cont({}, 0.5)",
    "q75": "quantile_cont({}, 0.75)",
    "max_value": "max({})",
}


def fix_evidence(spark, sf_dir):
    """What is shown about the priority and the price before they are repaired."""
    df = orders_dirty(spark, sf_dir).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    found = reports.issue_evidence(df, "orders_dirty", "o_totalprice", "o_orderkey").unionByName(
        reports.issue_evidence(df, "orders_dirty", "o_orderpriority", "o_orderkey")
    )
    rows = F.from_json("sample_rows", "array<struct<o_orderkey:bigint>>")
    shown = found.withColumns(
        {
            # Doubles print differently in the two engines, so the price shows only how many values it has.
            "sample_values": F.when(F.col("column") == "o_orderpriority", F.array_join("sample_values", "|")).otherwise(
                F.size("sample_values").cast("string")
            ),
            "sample_rows": F.array_join(F.transform(rows, lambda r: r["o_orderkey"].cast("string")), ","),
        }
    )
    return rounded(shown, *FIGURES)


QUERIES = {f.__name__: f for f in (report_issues, response_parse, recommendations, evidence, fix_evidence)}


def evidence_sql(c: str) -> str:
    return f"""SELECT 'orders_dirty' AS dataset_name, count(*) AS total_records, '{c}' AS "column",
    count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(DISTINCT {c}) AS unique_count,
    (SELECT issues FROM listed WHERE "column" = '{c}') AS issues FROM orders_dirty"""


def fix_evidence_sql(c: str, data_type: str, figures: str, samples: str) -> str:
    return f"""SELECT 'orders_dirty' AS dataset_name, '{c}' AS "column", '{data_type}' AS data_type,
    count(*) AS total_records, CAST(6 AS BIGINT) AS total_columns,
    count(*) FILTER (WHERE {c} IS NULL) AS null_count, {figures}, {samples} AS sample_values,
    (SELECT string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) FROM (
      SELECT o_orderkey FROM orders_dirty ORDER BY o_orderkey LIMIT 20)) AS sample_rows FROM orders_dirty"""


LISTED = """listed AS (SELECT "column", string_agg(message, '; ' ORDER BY flag_order) AS issues
  FROM flags GROUP BY "column")"""
NOTHING = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in FIGURES)
PRICE = "o_totalprice"
ORACLES = {
    "report_issues": with_views("issue_reports")
    + """SELECT report_id, CAST(0 AS BIGINT) AS position, CAST(NULL AS VARCHAR) AS dataset_name,
  CASE report_id % 7 WHEN 0 THEN 'completeness' WHEN 1 THEN 'ranges_issue' WHEN 2 THEN 'format_problem'
WHEN 3 THEN 'critical_issues' WHEN 4 THEN 'general_enhancement' ELSE 'extraction_error' END AS issue_type,
  CASE report_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'negative' WHEN 2 THEN 'case' WHEN 3 THEN '[{"description":"dup"}]'
WHEN 4 THEN concat('General quality improvements needed based on report ', CAST(report_id AS VARCHAR))
ELSE concat('Could not parse report ', CAST(report_id AS VARCHAR)) END AS description,
  CASE report_id % 7 WHEN 0 THEN 'high' WHEN 4 THEN 'low' WHEN 5 THEN 'low' ELSE 'medium' END AS severity,
  CASE report_id % 7 WHEN 0 THEN 'o_orderpriority' WHEN 1 THEN 'o_totalprice' END AS "column",
  CASE report_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'Fix ranges issue' WHEN 2 THEN 'Resolve format problem'
WHEN 3 THEN concat('Address critical_issues identified in report ', CAST(report_id AS VARCHAR))
WHEN 4 THEN 'Apply general data quality improvements' ELSE 'Manual review of report needed' END AS recommendation
  FROM issue_reports WHERE json_valid(body)""",
    "response_parse": with_views("issue_responses")
    + r"""SELECT response_id, status, CASE WHEN status = 'ok' THEN CAST(json_array_length(span) AS BIGINT) END AS entries,
  CASE WHEN status = 'ok' THEN json_extract_string(span, '$[0].severity') END AS first_severity
  FROM (SELECT response_id, span, CASE WHEN span IS NULL THEN 'no_json'
      WHEN json_valid(span) AND NOT regexp_matches(span, ',\s*[}\]]') THEN 'ok' ELSE 'bad_json' END AS status
    FROM (SELECT response_id, nullif(regexp_extract(response, '(?s)\[.*\]'), '') AS span FROM issue_responses))""",
    "recommendations": """SELECT doc_id AS response_id, s.position, 'ok' AS status,
  CASE s.position WHEN 0 THEN concat('check row ', CAST(doc_id AS VARCHAR)) ELSE 'fill gaps' END AS recommendation
  FROM documents, (SELECT unnest([0, 1])::BIGINT AS position) s WHERE doc_id % 4 < 2
UNION ALL SELECT doc_id, 0, 'no_json', 'Manual review of data quality issues required' FROM documents
  WHERE doc_id % 4 = 2
UNION ALL SELECT doc_id, 0, 'bad_json', 'Error generating recommendations - manual review required' FROM documents
  WHERE doc_id % 4 = 3""",
    "evidence": with_views("orders_dirty", FLAGS_SQL, LISTED) + union_all(evidence_sql(c) for c in DIRTY),
    "fix_evidence": with_views("orders_dirty")
    + union_all(
        [
            fix_evidence_sql(
                PRICE,
                "double",
                ", ".join(f"{r4(sql.format(PRICE))} AS {n}" for n, sql in FIGURES.items()),
                "'10'",
            ),
            fix_evidence_sql(
                "o_orderpriority",
                "string",
                NOTHING,
                """(SELECT string_agg(coalesce(v, 'null'), '|' ORDER BY k, v NULLS FIRST) FROM (
  SELECT o_orderkey AS k, o_orderpriority AS v FROM orders_dirty ORDER BY k, v NULLS FIRST LIMIT 10))""",
            ),
        ]
    ),
}
