"""From tables to issues, scores and the report."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.functions.columns import control_table
from rowsmith.operators import flags, issues, profile
from rowsmith.sources.shared import settled


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


#: What a job that reads a broken table raises: an error that PySpark knows, or one of the JVM, as for a damaged file.
FAILURES = (PySparkException, Py4JJavaError)


def together(jobs: list[Callable[[], DataFrame]], at_once: int = 8) -> list[DataFrame | Exception]:
    """Independent Spark jobs submitted side by side, so that one fills the gaps of another; what a job that failed in
    Spark has raised stands in its place."""

    def outcome(job):
        try:
            return job()
        except FAILURES as error:
            return error

    with ThreadPoolExecutor(max(1, min(at_once, len(jobs)))) as pool:
        return [f.result() for f in [pool.submit(outcome, job) for job in jobs]]


def reason_of(error: Exception) -> str:
    """A failure in one line: the first of its message, or the condition or class of an error of the JVM."""
    if isinstance(error, PySparkException):
        return f"error: {str(error).splitlines()[0]}"
    raised = error.java_exception
    condition = raised.getCondition() if hasattr(raised, "getCondition") else None
    return f"error: {condition or raised.getClass().getSimpleName()}"


def detect(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(issues, basic figures) of all tables; the first failure is raised."""
    found, figures, failed = detect_each(tables)
    if failed:
        raise next(iter(failed.values()))
    return found, figures


def detect_each(tables: dict[str, DataFrame]) -> tuple[DataFrame | None, DataFrame | None, dict[str, Exception]]:
    """(issues, basic figures, failures by table). A table that fails does not end the others; without any good table
    there are no issues and figures.

    Figures and flags are settled: a few rows per table that scores, summaries and lists all start from, so
    the tables are profiled once however many of those are made.
    """
    stats = [partial(lambda df, name: settled(profile.basic_stats(df, name)), df, name) for name, df in tables.items()]
    flagged = [partial(lambda df, name: settled(flags.column_flags(df, name)), df, name) for name, df in tables.items()]
    done = together(flagged + stats)
    pairs = dict(zip(tables, zip(done[: len(tables)], done[len(tables) :])))
    failed = {name: next(x for x in pair if isinstance(x, FAILURES)) for name, pair in pairs.items() if any(isinstance(x, FAILURES) for x in pair)}
    good = [pair for name, pair in pairs.items() if name not in failed]
    if not good:
        return None, None, failed
    found, figures = (union(list(parts)) for parts in zip(*good))
    return issues.issues_from_flags(found, figures), figures, failed


def quality_report(tables: dict[str, DataFrame], external: DataFrame | None = None) -> DataFrame:
    """One row per table: figures, score, fitness, issue counts and risk level, and why there is no score.

    A table without rows has neither score nor risk; one that fails has its name and the error alone.
    """
    found, stats, failed = detect_each(tables)
    if found is None:
        # A table without columns and rows gives the report's columns.
        spark = next(iter(tables.values())).sparkSession
        found, stats = detect({"": spark.createDataFrame([], "none int")})
        stats = stats.limit(0)
    scores = issues.fitness_labels(issues.quality_scores(found, stats, external=external))
    counts = issues.severity_counts(found)
    rows = scores.join(counts, "dataset_name", "left").na.fill(0, [c for c in counts.columns if c != "dataset_name"])
    scored = F.col("quality_score").isNotNull()
    risk = issues.risk_of(F.col("critical_issues"), F.col("high_issues"), F.col("medium_issues"))
    rows = rows.withColumns({"risk_level": F.when(scored, risk), "score_reason": F.when(~scored, "no rows")})
    if not failed:
        return rows
    errors = [(name, reason_of(error)) for name, error in failed.items()]
    table = control_table(rows.sparkSession, errors, dataset_name=pa.string(), score_reason=pa.string())
    return rows.unionByName(table, allowMissingColumns=True)


def analysis_documents(tables: dict[str, DataFrame], found: DataFrame, stats: DataFrame) -> DataFrame:
    """One JSON document per table: figures, score, issues and error summary. Its size follows the schema."""
    scores = issues.quality_scores(found, stats).select("dataset_name", "quality_score")
    listed = found.groupBy("dataset_name").agg(
        F.array_sort(F.collect_list(F.struct(*sorted(c for c in found.columns if c != "dataset_name")))).alias(
            "quality_issues"
        )
    )
    summary = issues.error_summary(found)
    body = summary.select(
        "dataset_name", F.struct(*[c for c in summary.columns if c != "dataset_name"]).alias("error_summary")
    )
    figures = stats.select("dataset_name", F.struct(*[c for c in stats.columns if c != "dataset_name"]).alias("basic_stats"))
    rows = (
        figures.join(scores.withColumnRenamed("quality_score", "overall_quality_score"), "dataset_name")
        .join(listed, "dataset_name", "left")
        .join(body, "dataset_name", "left")
    )
    return rows.select("dataset_name", F.to_json(F.struct("*")).alias("document"))


def repair_export(found: DataFrame, scores: DataFrame, limit: float = 60.0) -> DataFrame:
    """What the repair stage needs, as one document: critical issues, tables below the limit, totals."""
    critical = issues.critical_issues(found).agg(
        F.array_sort(F.collect_list(F.struct("dataset_name", "column", "description", "fix_priority"))).alias("list")
    )
    return scores.agg(
        F.array_sort(F.collect_list(F.when(F.col("quality_score") < limit, F.col("dataset_name")))).alias(
            "priority_datasets"
        ),
        F.count(F.lit(1)).alias("total_datasets_analyzed"),
    ).select(
        critical.select("list").scalar().alias("critical_issues"), "priority_datasets", "total_datasets_analyzed"
    )
