"""Reports and answers as tables: flatten issue reports, read free text answers, write evidence documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.functions import json_text
from rowsmith.functions.columns import col, computed_once, count_where, is_missing
from rowsmith.operators.flags import flag_inputs, problem_list
from rowsmith.operators.profile import column_summary, describe, missing_by_column, numeric_summary, top_values

# Key parts that mark an entry of a report as an issue, and texts used when nothing is given.
ISSUE_KEY_PARTS = ["issue", "problem", "error"]
DEFAULT_RECOMMENDATIONS = ["Manual review of data quality issues required"]
ERROR_RECOMMENDATION = "Error generating recommendations - manual review required"

ISSUE_FIELDS = (
    "struct<issue_type:string, category:string, description:string, severity:string, column:string,"
    " affected_rows:array<bigint>, recommendation:string, ai_recommendation:string>"
)
FLAT = (
    "struct<dataset_name:string, issue_type:string, description:string, severity:string, column:string,"
    " recommendation:string>"
)


def flat_issue(
    issue_type: Column,
    description: Column,
    severity: Column,
    column: Column,
    recommendation: Column,
    dataset: Column | None = None,
) -> Column:
    """One flattened issue."""
    nothing = F.lit(None).cast("string")
    return F.struct(
        (nothing if dataset is None else dataset).alias("dataset_name"),
        issue_type.alias("issue_type"),
        description.alias("description"),
        severity.alias("severity"),
        column.alias("column"),
        recommendation.alias("recommendation"),
    ).cast(FLAT)


def or_text(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def flatten_report_issues(reports: DataFrame, report_id: str = "report_id", body: str = "body") -> DataFrame:
    """Issues of every report form, in one pass over the reports.

    Read are: a top-level list quality_issues; issues or problems inside the parts of analysis_results; the
    quality_issues of each entry of dataset_analyses; every other non-empty entry whose key names issues,
    problems or errors (one lump each). A report without any gets one general_enhancement. A JSON value that
    is no object gives an extraction_error; text that is not JSON gives nothing.
    """
    nothing = F.lit(None).cast("string")
    medium = F.lit("medium")
    ident = F.col("_id").cast("string")
    texts = "map<string,string>"
    parsed = computed_once(
        reports, [col(report_id).alias("_id")], _json=json_text.valid_json(col(body))
    ).filter(F.col("_json").isNotNull())
    top = parsed.withColumn("_top", json_text.parse_as(F.col("_json"), texts))

    listed = F.transform(
        json_text.parse_as(F.col("_top")["quality_issues"], f"array<{ISSUE_FIELDS}>"),
        lambda i: flat_issue(
            or_text(i["issue_type"], "unknown"),
            or_text(i["description"], ""),
            or_text(i["severity"], "medium"),
            i["column"],
            or_text(i["recommendation"], ""),
        ),
    )

    def of_part(entry):
        """Issues, or else problems, of one part of analysis_results."""
        name = entry["key"]
        part = json_text.parse_as(entry["value"], "struct<issues:array<string>, problems:array<string>>")
        opened = F.transform(
            part["issues"], lambda t: F.struct(t.alias("text"), json_text.parse_as(t, ISSUE_FIELDS).alias("i"))
        )
        issues = F.transform(
            opened,
            lambda x: flat_issue(
                F.concat(name, F.lit("_issue")),
                F.coalesce(x["i"]["description"], x["text"]),
                or_text(x["i"]["severity"], "medium"),
                x["i"]["column"],
                F.coalesce(x["i"]["recommendation"], F.concat(F.lit("Fix "), name, F.lit(" issue"))),
            ),
        )
        problems = F.transform(
            part["problems"],
            lambda t: flat_issue(
                F.concat(name, F.lit("_problem")),
                t,
                medium,
                nothing,
                F.concat(F.lit("Resolve "), name, F.lit(" problem")),
            ),
        )
        return F.coalesce(issues, problems, F.array().cast(f"array<{FLAT}>"))

    parts = F.flatten(
        F.transform(F.map_entries(json_text.parse_as(F.col("_top")["analysis_results"], texts)), of_part)
    )

    analyses = json_text.parse_as(
        F.col("_top")["dataset_analyses"],
        f"array<struct<dataset_name:string, quality_issues:array<{ISSUE_FIELDS}>>>",
    )
    nested = F.flatten(
        F.transform(
            analyses,
            lambda a: F.coalesce(
                F.transform(
                    a["quality_issues"],
                    lambda i: flat_issue(
                        F.coalesce(i["issue_type"], i["category"], F.lit("unknown")),
                        or_text(i["description"], ""),
                        or_text(i["severity"], "medium"),
                        i["column"],
                        F.coalesce(i["recommendation"], i["ai_recommendation"], F.lit("")),
                        a["dataset_name"],
                    ),
                ),
                F.array().cast(f"array<{FLAT}>"),
            ),
        )
    )

    def names_issue(key, value):
        hit = F.lit(False)
        for part in ISSUE_KEY_PARTS:
            hit = hit | F.contains(F.lower(key), F.lit(part))
        text = F.regexp_replace(value, r"\s+", "")
        holds = F.rlike(text, F.lit(r"^[\[{]")) & ~text.isin("[]", "{}")
        return hit & holds & (key != "quality_issues")

    lumps = F.transform(
        F.map_entries(F.map_filter("_top", names_issue)),
        lambda e: flat_issue(
            e["key"],
            e["value"],
            medium,
            nothing,
            F.concat(F.lit("Address "), e["key"], F.lit(" identified in report "), ident),
        ),
    )

    empty = F.array().cast(f"array<{FLAT}>")
    every = F.concat(*[F.coalesce(a, empty) for a in (listed, parts, nested, lumps)])
    general = F.array(
        flat_issue(
            F.lit("general_enhancement"),
            F.concat(F.lit("General quality improvements needed based on report "), ident),
            F.lit("low"),
            nothing,
            F.lit("Apply general data quality improvements"),
        )
    )
    failed = F.array(
        flat_issue(
            F.lit("extraction_error"),
            F.concat(F.lit("Could not parse report "), ident),
            F.lit("low"),
            nothing,
            F.lit("Manual review of report needed"),
        )
    )
    chosen = (
        F.when(~F.startswith(F.ltrim("_json"), F.lit("{")), failed)
        .when(F.size("_every") > 0, F.col("_every"))
        .when(F.size("_top") > 0, general)
        .otherwise(empty)
    )
    return (
        top.withColumn("_every", every)
        .select(F.col("_id").alias(report_id), F.posexplode(chosen).alias("position", "i"))
        .select(report_id, "position", "i.*")
    )


def parse_responses(responses: DataFrame, schema: str, response: str = "response") -> DataFrame:
    """Typed answer of each response with a status: ok, no_json or bad_json.

    The outermost object is read for a struct schema, the outermost array otherwise.
    """
    text = col(response)
    is_object = schema.lower().lstrip().startswith(("struct", "map"))
    span = json_text.object_span(text) if is_object else json_text.array_span(text)
    keep = [c for c in responses.columns if c != response]
    spans = computed_once(responses, keep, _span=span)
    read = computed_once(spans, [*keep, "_span"], _json=json_text.valid_json(F.col("_span")))
    return read.select(
        *keep,
        json_text.answer_status(F.col("_span"), F.col("_json")).alias("status"),
        json_text.parse_as(F.col("_json"), schema).alias("answer"),
    )


def recommendations(responses: DataFrame, response: str = "response", defaults: list[str] | None = None) -> DataFrame:
    """One row per recommendation: the array of texts in the answer, default texts without one.

    A broken array gives the error text.
    """
    parsed = parse_responses(responses, "array<string>", response)
    default = F.array(*[F.lit(t) for t in (DEFAULT_RECOMMENDATIONS if defaults is None else defaults)])
    texts = (
        F.when(F.col("status") == "ok", F.col("answer"))
        .when(F.col("status") == "no_json", default)
        .otherwise(F.array(F.lit(ERROR_RECOMMENDATION)))
    )
    keep = [c for c in responses.columns if c != response]
    return parsed.select(*keep, "status", F.posexplode(texts).alias("position", "recommendation"))


def evidence(df: DataFrame, name: str, order_by: str) -> DataFrame:
    """One JSON document per table: basic figures, column summary, distributions, top values, gaps, problems.

    Only per-column rows are gathered into the document; its size follows the schema.
    """

    def rows(part: DataFrame, alias: str) -> DataFrame:
        body = F.struct(*[c for c in part.columns if c != "dataset_name"])
        return part.agg(F.array_sort(F.collect_list(body)).alias(alias))

    basic = flag_inputs(df, name)
    parts = {
        "column_summary": column_summary(df, name, order_by),
        "numeric_columns": numeric_summary(df, name),
        "categorical_columns": top_values(df, name),
        "missing_patterns": missing_by_column(df, name),
        "problematic_patterns": problem_list(df, name),
    }
    document = basic.select(
        "dataset_name",
        F.struct(*[c for c in basic.columns if c != "dataset_name"]).alias("basic_stats"),
        *[rows(part, key).scalar().alias(key) for key, part in parts.items()],
    )
    return document.select("dataset_name", F.to_json(F.struct("*")).alias("evidence"))


def issue_evidence(df: DataFrame, name: str, column: str, order_by: str, values: int = 10, rows: int = 20) -> DataFrame:
    """What is needed to judge an issue of one column: shape, type, figures, first values and first rows.

    First means in key order; both lists are bounded top-n reads.
    """
    head = df.orderBy(col(order_by), col(column)).limit(rows)
    order = F.struct(col(order_by).alias("k"), col(column).cast("string").alias("v"))
    first_rows = head.agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.struct("*").alias("r")))), lambda x: x["r"]))
    ).scalar()
    first_values = (
        head.limit(values)
        .agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: F.coalesce(x["v"], F.lit("null"))))
        .scalar()
    )
    figures = describe(df.select(col(column)), name)
    nulls = df.agg(count_where(is_missing(df, column)).alias("null_count"), F.count(F.lit(1)).alias("total_records"))
    return figures.select(
        "dataset_name",
        "column",
        F.lit(df.schema[column].dataType.simpleString()).alias("data_type"),
        nulls.select("total_records").scalar().alias("total_records"),
        F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        nulls.select("null_count").scalar().alias("null_count"),
        "mean_value",
        "std_value",
        "min_value",
        "q25",
        "q50",
        "q75",
        "max_value",
        first_values.alias("sample_values"),
        first_rows.alias("sample_rows"),
    )
