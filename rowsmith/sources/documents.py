"""JSON documents between stages: reports, request contexts, manifests, exports."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.functions.json_text import parse_as, valid_json

CONTEXT_SCHEMA = (
    "struct<user_context:struct<original_query:string, domain:string, intent:string, key_entities:array<string>,"
    " data_requirements:array<string>, expected_columns:array<string>, use_cases:array<string>>,"
    " available_datasets:array<struct<name:string, description:string, url:string, format:string,"
    " columns:array<string>, source_context:string, relevance_score:double, quality_score:double,"
    " data_quality_score:double, extracted_content_preview:string, extracted_content:string>>>"
)


def read_reports(spark: SparkSession, folder: str, glob: str = "*.json") -> DataFrame:
    """(report_id, body) of every report file of a folder; the id is the path below the folder."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    last = folder.rstrip("/").split("/")[-1]
    below = F.element_at(F.split(F.col("_metadata.file_path"), F.lit("/" + last.replace(".", r"\.") + "/")), -1)
    return files.select(below.alias("report_id"), F.col("value").alias("body"))


def read_contexts(documents: DataFrame, document_id: str = "report_id", body: str = "body") -> DataFrame:
    """Request contexts with their dataset descriptors, one row per descriptor, from both hand-over forms.

    The forms differ in two field names: quality_score or data_quality_score, and
    extracted_content_preview or extracted_content. Documents that are not JSON are left out.
    """
    parsed = documents.select(
        document_id, parse_as(valid_json(F.col(body)), CONTEXT_SCHEMA).alias("c")
    ).filter(F.col("c").isNotNull())
    rows = parsed.select(document_id, "c.user_context", F.posexplode_outer("c.available_datasets").alias("position", "d"))
    return rows.select(
        document_id,
        "user_context.original_query",
        F.coalesce("user_context.domain", F.lit("general")).alias("domain"),
        "user_context.intent",
        "user_context.key_entities",
        "user_context.data_requirements",
        "user_context.expected_columns",
        "position",
        *[f"d.{c}" for c in ("name", "description", "url", "format", "columns", "source_context", "relevance_score")],
        F.coalesce("d.quality_score", "d.data_quality_score").alias("quality_score"),
        F.coalesce("d.extracted_content_preview", "d.extracted_content").alias("extracted_content"),
    )


def write_manifest(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Generated tables: name, description, columns, file_path, row_count, one JSON line each."""
    rows.select("name", "description", "columns", "file_path", "row_count").write.mode(mode).json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a manifest."""
    return spark.read.schema(
        "name string, description string, columns array<string>, file_path string, row_count bigint"
    ).json(path)


def time_stamped(name: str) -> str:
    """Report name with the time of writing."""
    return f"{name}_{datetime.now(timezone.utc):%Y%m%d_%H%M%S_%f}"


def write_report(rows: DataFrame, folder: str, name: str) -> str:
    """Rows as JSON lines under a time-stamped name; returns the path."""
    path = f"{folder.rstrip('/')}/{time_stamped(name)}"
    rows.write.json(path)
    return path
