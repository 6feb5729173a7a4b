"""Round trips through files in the shared folder, the catalog and the preview."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.operators import issues, profile
from rowsmith.plans import quality
from rowsmith.queries.issues import BASE, SCORES_SQL, checked_tables
from rowsmith.queries.pages import CANDIDATE_BASE, ranked_of
from rowsmith.queries.profiles import r4, rounded, union_all
from rowsmith.queries.repairs import DAY, text_day
from rowsmith.queries.views import issue_reports, orders_dirty, part_dirty, table, with_views
from rowsmith.sources import documents, tables
from rowsmith.sources.shared import new_path

GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages"]
GIVEN += ["embeddings", "benchmark", "labels", "conversations"]


def io_csv(spark, sf_dir):
    """Dirty orders written as CSV and read back with inferred types."""
    path = new_path(spark, "orders_dirty")
    tables.write_table(orders_dirty(spark, sf_dir), path)
    return text_day(tables.read_table(spark, path))


def io_write(spark, sf_dir):
    """Dirty parts through parquet."""
    path = new_path(spark, "part_dirty")
    tables.write_table(part_dirty(spark, sf_dir), path, "parquet")
    return spark.read.parquet(path)


def io_tables(spark, sf_dir):
    """A folder of CSV tables, one of them empty, loaded as a whole."""
    folder = new_path(spark, "tables")
    for name in ("nation", "customer", "supplier"):
        tables.write_table(table(spark, sf_dir, name), f"{folder}/{name}.csv")
    tables.write_table(table(spark, sf_dir, "region").filter("r_regionkey < 0"), f"{folder}/region.csv")
    loaded = tables.load_tables(spark, folder)
    return quality.union([profile.basic_stats(df, name) for name, df in loaded.items()]).select("dataset_name", "total_records", "total_columns", "numeric_columns")


def io_reports(spark, sf_dir):
    """Reports written one file each and read back."""
    folder = new_path(spark, "reports")
    reports = issue_reports(spark, sf_dir).select("body", F.col("report_id").alias("number"))
    reports.write.partitionBy("number").text(folder)
    read = documents.read_reports(spark, folder, glob="*.txt")
    number = F.regexp_extract("report_id", "number=([0-9]+)/", 1).cast("bigint")
    return read.select(number.alias("report_id"), F.regexp_replace("body", "\n$", "").alias("body"))


def io_context(spark, sf_dir):
    """Both hand-over forms written as JSON and read back."""
    ranked = ranked_of(spark, sf_dir)
    common = ["name", "url", "columns", "relevance_score"]
    form_a = F.struct(*common, F.col("data_quality_score").alias("quality_score"), F.lit("short").alias("extracted_content_preview"))
    form_b = F.struct(*common, "data_quality_score", F.lit("long").alias("extracted_content"))
    context = F.struct(F.lit("alcohol").alias("original_query"), F.lit("medical").alias("domain"))
    folder = new_path(spark, "contexts")
    for i, form in enumerate((form_a, form_b)):
        body = F.to_json(F.struct(context.alias("user_context"), F.array(form).alias("available_datasets")))
        ranked.select(body.alias("value"), F.col("crawl_pos").alias("pos")).write.partitionBy("pos").text(f"{folder}/form={i}")
    read = documents.read_contexts(documents.read_reports(spark, folder, glob="*.txt"))
    shown = read.select(
        F.regexp_extract("report_id", "form=([0-9])/", 1).cast("bigint").alias("form"),
        "original_query",
        "domain",
        "name",
        "url",
        F.array_join("columns", ",").alias("columns"),
        "relevance_score",
        "quality_score",
        "extracted_content",
    )
    return rounded(shown, "relevance_score", "quality_score")


def io_manifest(spark, sf_dir):
    """Manifest of the dirty tables, written and read back."""
    path = new_path(spark, "manifest")
    rows = quality.union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("name"),
                F.lit("dirty view").alias("description"),
                F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
                F.lit(f"{name}.csv").alias("file_path"),
                "row_count",
            )
            for name, df in {"orders_dirty": orders_dirty(spark, sf_dir), "part_dirty": part_dirty(spark, sf_dir)}.items()
        ]
    )
    documents.write_manifest(rows, path)
    return documents.read_manifest(spark, path).withColumn("columns", F.array_join("columns", ","))


def io_report(spark, sf_dir):
    """Analysis documents of the judged tables, written with a time stamp, read back and opened."""
    judged = checked_tables(spark, sf_dir)
    found, stats = quality.detect(judged)
    path = documents.write_report(quality.analysis_documents(judged, found, stats), new_path(spark, "report"), "quality")
    read = spark.read.schema("dataset_name string, document string").json(path)
    schema = (
        "overall_quality_score double, basic_stats struct<total_records:bigint>,"
        " quality_issues array<struct<description:string>>, error_summary struct<risk_level:string>"
    )
    opened = read.select("dataset_name", F.from_json("document", schema).alias("d"))
    shown = opened.select(
        "dataset_name",
        F.col("d.overall_quality_score").alias("quality_score"),
        "d.basic_stats.total_records",
        F.array_join(F.array_sort("d.quality_issues.description"), ";").alias("descriptions"),
    )
    return rounded(shown, "quality_score")


def io_export(spark, sf_dir):
    """What the repair stage is handed, with a limit that some table is below."""
    found, stats = quality.detect(checked_tables(spark, sf_dir))
    export = quality.repair_export(found, issues.quality_scores(found, stats), limit=95.0)
    return export.select(
        F.array_join(F.transform("critical_issues", lambda i: i["description"]), ";").alias("critical_issues"),
        F.array_join("priority_datasets", ",").alias("priority_datasets"),
        "total_datasets_analyzed",
    )


def catalog(spark, sf_dir):
    rows = quality.union([tables.catalog_row(table(spark, sf_dir, t), t) for t in GIVEN])
    # SQL can not see file sizes, so only their presence is compared.
    return rows.select("dataset_name", "row_count", "column_count", (F.col("size_kb") > 0).alias("has_size"))


def preview(spark, sf_dir):
    return text_day(tables.preview(orders_dirty(spark, sf_dir), 20, "o_orderkey"))


QUERIES = {
    f.__name__: f
    for f in (io_csv, io_write, io_tables, io_reports, io_context, io_manifest, io_report, io_export, catalog, preview)
}

COLUMN_COUNTS = dict(zip(GIVEN, [2, 3, 5, 4, 6, 6, 11, 6, 5, 3, 3, 2, 3, 4]))

ORACLES = {
    "io_csv": with_views("orders_dirty")
    + f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {DAY}, o_orderpriority FROM orders_dirty",
    "io_write": with_views("part_dirty") + "SELECT * FROM part_dirty",
    "io_tables": union_all(
        f"""SELECT '{t}' AS dataset_name, count(*) AS total_records, CAST({c} AS BIGINT) AS total_columns,
    CAST({n} AS BIGINT) AS numeric_columns FROM {t}"""
        for t, c, n in (("nation", 3, 2), ("customer", 5, 3), ("supplier", 4, 3))
    ),
    "io_reports": with_views("issue_reports") + "SELECT report_id, body FROM issue_reports",
    "io_context": with_views(*CANDIDATE_BASE)
    + f"""SELECT CAST(f AS BIGINT) AS form, 'alcohol' AS original_query, 'medical' AS domain, name, url, columns,
  {r4("relevance_score")} AS relevance_score, {r4("data_quality_score")} AS quality_score,
  CASE f WHEN 0 THEN 'short' ELSE 'long' END AS extracted_content FROM ranked, (SELECT unnest([0, 1]) AS f)""",
    "io_manifest": with_views("orders_dirty", "part_dirty")
    + """SELECT 'orders_dirty' AS name, 'dirty view' AS description,
  'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns,
  'orders_dirty.csv' AS file_path, count(*) AS row_count FROM orders_dirty
UNION ALL SELECT 'part_dirty', 'dirty view', 'p_partkey,p_name,p_brand,p_type,p_size,p_retailprice', 'part_dirty.csv',
  count(*) FROM part_dirty""",
    "io_report": with_views(*BASE, SCORES_SQL)
    + f"""SELECT s.dataset_name, {r4("quality_score")} AS quality_score, total_records,
  coalesce((SELECT string_agg(description, ';' ORDER BY description) FROM issues i
    WHERE i.dataset_name = s.dataset_name), '') AS descriptions FROM scores s""",
    "io_export": with_views(*BASE, SCORES_SQL)
    + """SELECT coalesce((SELECT string_agg(description, ';' ORDER BY dataset_name, "column" NULLS FIRST, description)
    FROM issues WHERE severity = 'critical'), '') AS critical_issues,
  coalesce((SELECT string_agg(dataset_name, ',' ORDER BY dataset_name) FROM scores WHERE quality_score < 95), '')
    AS priority_datasets, (SELECT count(*) FROM scores) AS total_datasets_analyzed""",
    "catalog": union_all(
        f"""SELECT '{t}' AS dataset_name, count(*) AS row_count, CAST({COLUMN_COUNTS[t]} AS BIGINT) AS column_count,
    count(*) > 0 AS has_size FROM {t}"""
        for t in GIVEN
    ),
    "preview": with_views("orders_dirty")
    + f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {DAY}, o_orderpriority
  FROM (SELECT * FROM orders_dirty ORDER BY o_orderkey LIMIT 20)""",
}
