"""Input tables, and dirty views derived from them over all their rows.

The given tables hold no nulls and no repeated rows, so the views put in the faults that the operators look
for. Each view exists as a DataFrame and as a common table expression with the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with null, negative and tenfold prices, null and untidy priorities, and repeated rows."""
    key = F.col("o_orderkey")
    price = F.col("o_totalprice")
    priority = F.col("o_orderpriority")
    copies = F.when(key % 10 == 0, 2).otherwise(1)
    return (
        table(spark, sf_dir, "orders")
        .select(
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            F.when(key % 7 == 0, F.lit(None))
            .when(key % 11 == 0, -price)
            .when(key % 13 == 0, price * 10)
            .otherwise(price)
            .alias("o_totalprice"),
            "o_orderdate",
            F.when(key % 4 == 0, F.lit(None))
            .when(key % 3 == 0, F.concat(F.lit("  "), F.lower(priority), F.lit(" ")))
            .otherwise(priority)
            .alias("o_orderpriority"),
            F.explode(F.array_repeat(F.lit(1), copies)).alias("copy"),
        )
        .drop("copy")
    )


def part_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with null, padded and upper-case names and negative sizes."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(key % 9 == 0, F.lit(None))
        .when(key % 2 == 0, F.concat(F.lit(" "), F.upper("p_name")))
        .otherwise(F.col("p_name"))
        .alias("p_name"),
        "p_brand",
        "p_type",
        F.when(key % 5 == 0, -F.col("p_size")).otherwise(F.col("p_size")).alias("p_size"),
        "p_retailprice",
    )


def pages_abs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with absolute links on every second page."""
    host = F.regexp_extract("url", r"^(https?://[^/]+)", 1)
    absolute = F.replace(F.col("html"), F.lit('href="/'), F.concat(F.lit('href="'), host, F.lit("/")))
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", F.when(F.col("page_id") % 2 == 0, absolute).otherwise(F.col("html")).alias("html")
    )


def said(answer: Column, text: str = "text") -> Column:
    """An answer in the middle of a document's whole text, without the brackets that mark where an answer begins and ends."""
    plain = F.translate(text, "[]{}", "()()")
    return F.concat(plain, F.lit(" "), answer, F.lit(" "), plain)


def said_sql(answer: str, text: str = "text") -> str:
    plain = f"translate({text}, '[]{{}}', '()()')"
    return f"concat({plain}, ' ', {answer}, ' ', {plain})"


def issue_answer(item: Column) -> Column:
    """Answers about issues: good inside free text, sparse, without JSON, with broken JSON."""
    good = F.concat(
        F.lit(
            'Result: [{"severity":"high","category":"validity","column":"o_totalprice",'
            '"estimated_affected_percentage":'
        ),
        (item % 100).cast("string"),
        F.lit('.5,"priority":2}] end'),
    )
    return F.when(item % 4 == 0, good).when(item % 4 == 1, '[{"column":null}]').when(item % 4 == 2, "no json here").otherwise('[{"severity":"low",}]')


def issue_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer about issues within each document's text."""
    item = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(item.alias("response_id"), said(issue_answer(item)).alias("response"))


def issue_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports in every known form, one without issues, a list, and broken JSON."""
    item = F.col("item_id")
    return table(spark, sf_dir, "benchmark").select(
        item.alias("report_id"),
        F.when(
            item % 7 == 0,
            '{"quality_issues":[{"issue_type":"completeness","severity":"high","column":"o_orderpriority"}]}',
        )
        .when(
            item % 7 == 1,
            '{"analysis_results":{"ranges":{"issues":[{"description":"negative","column":"o_totalprice"}]}}}',
        )
        .when(item % 7 == 2, '{"analysis_results":{"format":{"problems":["case"]}}}')
        .when(item % 7 == 3, '{"critical_issues":[{"description":"dup"}]}')
        .when(item % 7 == 4, '{"score":80}')
        .when(item % 7 == 5, '["x"]')
        .otherwise('{"score":')
        .alias("body"),
    )


def page_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers about pages: full, sparse, not a dataset, without JSON."""
    page = F.col("page_id")
    full = F.concat(
        F.lit('Answer: {"is_dataset": true, "dataset_name": "Set '),
        page.cast("string"),
        F.lit('", "description": "rows", "file_format": "csv", "estimated_columns": ["id", "value"], '),
        F.lit('"data_size": "2 MB", "download_available": true, "relevance_to_query": 0.'),
        (page % 90 + 10).cast("string"),
        F.lit("} done"),
    )
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(page % 4 == 0, full)
        .when(page % 4 == 1, '{"is_dataset": true}')
        .when(page % 4 == 2, '{"is_dataset": false, "dataset_name": "none"}')
        .otherwise("I can not tell")
        .alias("response"),
    )


SQL = {
    "orders_dirty": """orders_dirty AS (
  WITH b AS (SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN -o_totalprice
         WHEN o_orderkey % 13 = 0 THEN o_totalprice * 10 ELSE o_totalprice END AS o_totalprice,
    o_orderdate,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL
         WHEN o_orderkey % 3 = 0 THEN concat('  ', lower(o_orderpriority), ' ')
         ELSE o_orderpriority END AS o_orderpriority
    FROM orders)
  SELECT * FROM b UNION ALL SELECT * FROM b WHERE o_orderkey % 10 = 0)""",
    "part_dirty": """part_dirty AS (
  SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN concat(' ', upper(p_name))
    ELSE p_name END AS p_name, p_brand, p_type,
    CASE WHEN p_partkey % 5 = 0 THEN -p_size ELSE p_size END AS p_size, p_retailprice FROM part)""",
    "pages_abs": """pages_abs AS (
  SELECT page_id, url, CASE WHEN page_id % 2 = 0
    THEN replace(html, 'href="/', concat('href="', regexp_extract(url, '^(https?://[^/]+)', 1), '/'))
    ELSE html END AS html FROM pages)""",
    "issue_responses": "issue_responses AS (\n  SELECT doc_id AS response_id, "
    + said_sql(
        """CASE doc_id % 4
    WHEN 0 THEN concat('Result: [{"severity":"high","category":"validity","column":"o_totalprice",',
      '"estimated_affected_percentage":', CAST(doc_id % 100 AS VARCHAR), '.5,"priority":2}] end')
    WHEN 1 THEN '[{"column":null}]' WHEN 2 THEN 'no json here' ELSE '[{"severity":"low",}]' END"""
    )
    + " AS response FROM documents)",
    "issue_reports": """issue_reports AS (
  SELECT item_id AS report_id, CASE item_id % 7
    WHEN 0 THEN '{"quality_issues":[{"issue_type":"completeness","severity":"high","column":"o_orderpriority"}]}'
    WHEN 1 THEN '{"analysis_results":{"ranges":{"issues":[{"description":"negative","column":"o_totalprice"}]}}}'
    WHEN 2 THEN '{"analysis_results":{"format":{"problems":["case"]}}}'
    WHEN 3 THEN '{"critical_issues":[{"description":"dup"}]}'
    WHEN 4 THEN '{"score":80}' WHEN 5 THEN '["x"]' ELSE '{"score":' END AS body
  FROM benchmark)""",
    "page_responses": """page_responses AS (
  SELECT page_id, CASE page_id % 4
    WHEN 0 THEN concat('Answer: {"is_dataset": true, "dataset_name": "Set ', CAST(page_id AS VARCHAR),
      '", "description": "rows", "file_format": "csv", "estimated_columns": ["id", "value"], ',
      '"data_size": "2 MB", "download_available": true, "relevance_to_query": 0.',
      CAST(page_id % 90 + 10 AS VARCHAR), '} done')
    WHEN 1 THEN '{"is_dataset": true}' WHEN 2 THEN '{"is_dataset": false, "dataset_name": "none"}'
    ELSE 'I can not tell' END AS response
  FROM pages)""",
}


def with_views(*parts: str) -> str:
    """WITH clause from view names and further common table expressions."""
    return "WITH " + ",\n".join(SQL.get(p, p) for p in parts) + "\n"
