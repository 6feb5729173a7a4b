"""Several tables side by side: totals, shared columns, overlaps, conflicts, coverage.

Tables come as a dict of name to DataFrame. Per-table figures are reduced first; joins between tables run
on those reduced rows (a few per column), or on distinct values and keys.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.functions.columns import FRACTIONAL, TEMPORAL, WHOLE, col, columns_of, control_table, count_where, known, type_class
from rowsmith.functions.hashing import cell_digest
from rowsmith.operators.profile import column_types, format_fit, missing_counts, modes, numeric_summary
from rowsmith.sources.shared import stored


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def run_totals(issues: DataFrame, scores: DataFrame) -> DataFrame:
    """Tables judged, issues found, critical issues."""
    found = issues.groupBy("dataset_name").agg(
        F.count(F.lit(1)).alias("n"), count_where(F.col("severity") == "critical").alias("c")
    )
    return (
        scores.select("dataset_name")
        .join(found, "dataset_name", "left")
        .agg(
            F.count(F.lit(1)).alias("datasets_analyzed"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_issues_found"),
            F.coalesce(F.sum("c"), F.lit(0)).alias("critical_issues_count"),
        )
    )


def collection_summary(issues: DataFrame, scores: DataFrame, good: float = 75.0) -> DataFrame:
    """Mean score (0 without tables), rows, critical issues, tables scoring above the limit."""
    critical = issues.groupBy("dataset_name").agg(count_where(F.col("severity") == "critical").alias("c"))
    return scores.join(critical, "dataset_name", "left").agg(
        F.coalesce(F.avg("quality_score"), F.lit(0.0)).alias("avg_quality_score"),
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("total_critical_issues"),
        count_where(F.col("quality_score") > good).alias("datasets_with_high_quality"),
    )


def column_catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns of all tables with their types and filled cells."""
    return union(
        [
            column_types(df, name).join(
                missing_counts(df, name).select(
                    "column", (F.col("total_records") - F.col("missing_count")).alias("filled")
                ),
                "column",
            )
            for name, df in tables.items()
        ]
    )


def table_comparison(tables: dict[str, DataFrame], issues: DataFrame, scores: DataFrame) -> DataFrame:
    """One row per table: columns, types, score, rows and the descriptions of its major issues."""
    types = union([column_types(df, name) for name, df in tables.items()])
    schema = types.groupBy("dataset_name").agg(
        F.count(F.lit(1)).alias("column_count"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("ordinal", "column", "data_type"))),
            lambda c: F.concat_ws(":", c["column"], c["data_type"]),
        ).alias("columns"),
    )
    major = issues.groupBy("dataset_name").agg(
        F.array_sort(
            F.collect_list(F.when(F.col("severity").isin("critical", "high"), F.col("description")))
        ).alias("major_issues"),
        count_where(F.col("severity") == "critical").alias("critical_issues"),
    )
    return (
        scores.select("dataset_name", "total_records", "quality_score")
        .join(schema, "dataset_name")
        .join(major, "dataset_name", "left")
        .withColumn("major_issues", F.coalesce("major_issues", F.array().cast("array<string>")))
        .na.fill(0, ["critical_issues"])
    )


def shared(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of two per-column frames joined by column name, each pair of tables once."""
    a = left.select("column", F.struct(*[c for c in left.columns if c != "column"]).alias("a"))
    b = right.select("column", F.struct(*[c for c in right.columns if c != "column"]).alias("b"))
    return a.join(b, "column").filter(F.col("a.dataset_name") < F.col("b.dataset_name"))


def schema_overlap(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns that two tables have in common, their types, and whether the type classes conflict."""
    catalog = column_catalog(tables)
    return shared(catalog, catalog).select(
        F.col("a.dataset_name").alias("dataset_a"),
        F.col("b.dataset_name").alias("dataset_b"),
        "column",
        F.col("a.data_type").alias("type_a"),
        F.col("b.data_type").alias("type_b"),
        F.col("a.filled").alias("filled_a"),
        F.col("b.filled").alias("filled_b"),
        (F.col("a.type_class") != F.col("b.type_class")).alias("type_conflict"),
    )


def compatibility(tables: dict[str, DataFrame]) -> DataFrame:
    """Share of the common columns of two tables that agree in type class and hold values in both."""
    usable = ~F.col("type_conflict") & (F.col("filled_a") > 0) & (F.col("filled_b") > 0)
    return (
        schema_overlap(tables)
        .groupBy("dataset_a", "dataset_b")
        .agg(
            F.count(F.lit(1)).alias("common_columns"),
            (count_where(usable) / F.count(F.lit(1))).alias("compatibility_score"),
        )
    )


def range_overlap(tables: dict[str, DataFrame]) -> DataFrame:
    """Value ranges of common numeric columns and whether they overlap."""
    ranges = union([numeric_summary(df, name) for name, df in tables.items()]).select(
        "dataset_name", "column", "min_value", "max_value"
    )
    low = F.greatest("a.min_value", "b.min_value")
    high = F.least("a.max_value", "b.max_value")
    return shared(ranges, ranges).select(
        F.col("a.dataset_name").alias("dataset_a"),
        F.col("b.dataset_name").alias("dataset_b"),
        "column",
        F.when(low <= high, low).alias("overlap_from"),
        F.when(low <= high, high).alias("overlap_to"),
        (low <= high).alias("overlaps"),
    )


#: Distinct values of a column that are looked for in all others, and the chance that a pair above the limit is
#: not compared in full.
SAMPLE, MISSED = 1024, 1e-12


def value_kind(df: DataFrame, name: str) -> str | None:
    """Columns are comparable when they have the same kind of value."""
    data_type = df.schema[name].dataType
    if isinstance(data_type, WHOLE):
        return "whole"
    if isinstance(data_type, FRACTIONAL):
        return "fraction"
    if isinstance(data_type, TEMPORAL):
        return "time"
    return "text" if data_type.simpleString() == "string" else None


KIND_TYPES = {"whole": "bigint", "fraction": "double", "time": "timestamp_ntz", "text": "string"}


def digests(df: DataFrame, name: str, kind: str) -> tuple[Column, Column]:
    """128 bits that stand for a value of its kind; null for a missing one."""
    value = known(df, name).cast(KIND_TYPES[kind])
    return tuple(F.when(value.isNotNull(), F.xxhash64(F.lit(f"{seed}{kind}"), value)) for seed in (1, 2))


class Joinable(NamedTuple):
    """A column that may be joined on."""

    id: int
    table: str
    name: str
    kind: str


def value_cells(tables: dict[str, DataFrame], columns: Sequence[Joinable], below: dict[int, float] | None = None) -> DataFrame:
    """(column_id, d1, d2): the values of columns as digests, each table in one scan; with `below`, only those whose first
    digest lies in that share of its range."""
    parts = []
    for table, df in tables.items():
        cells = []
        for c in columns:
            if c.table != table:
                continue
            d1, d2 = digests(df, c.name, c.kind)
            if below is not None and below[c.id] < 1:
                d1 = F.when(F.shiftrightunsigned(d1, 1) < int(below[c.id] * 2**63), d1)
            cells.append(F.struct(F.lit(c.id).alias("column_id"), d1.alias("d1"), d2.alias("d2")))
        if cells:
            parts.append(df.select(F.inline(F.array(*cells))))
    return union(parts).filter("d1 IS NOT NULL")


def common_counts(places: DataFrame, sought: DataFrame) -> DataFrame:
    """(id_a, id_b, common): for how many of the values of column a in `sought` there is a place in column b.

    Values that occur in the same set of columns are counted before pairs are formed, so pairs grow with the schema."""
    sets = places.groupBy("d1", "d2").agg(F.array_sort(F.collect_set("column_id")).alias("ids"))
    counted = sought.withColumnRenamed("column_id", "id_a").join(sets, ["d1", "d2"]).groupBy("id_a", "ids").agg(F.count(F.lit(1)).alias("n"))
    pairs = counted.select("id_a", "n", F.explode("ids").alias("id_b")).filter("id_a <> id_b")
    return pairs.groupBy("id_a", "id_b").agg(F.sum("n").alias("common"))


def join_candidates(
    tables: dict[str, DataFrame], columns: dict[str, list[str]] | None = None, at_least: float = 0.5
) -> DataFrame:
    """Column pairs of different tables where one column's distinct values are largely found in the other, with the
    exact share.

    Some SAMPLE distinct values of each column, all if it has few, are looked for in all other columns: they are
    broadcast, at most about SAMPLE digests for each column of the schema. So the share of a column with few values is known
    exactly, and that of another to within a margin that holds but for a chance of MISSED. Only the columns of pairs that may
    reach the limit are compared in full, by their distinct values.
    """
    spark = next(iter(tables.values())).sparkSession
    named = []
    for table, df in tables.items():
        for c in columns.get(table, []) if columns else df.columns:
            kind = value_kind(df, c)
            if kind:
                named.append(Joinable(len(named), table, c, kind))
    table_of = {c.id: c.table for c in named}
    sizes = []
    for table, df in tables.items():
        mine = [c for c in named if c.table == table]
        if mine:
            counts = df.agg(*[F.approx_count_distinct(digests(df, c.name, c.kind)[0]).alias(str(c.id)) for c in mine])
            sizes.append(counts.select(F.inline(F.array(*[F.struct(F.lit(c.id).alias("id"), F.col(str(c.id)).alias("n")) for c in mine]))))
    share = {r["id"]: min(1.0, SAMPLE / max(r["n"], 1)) for r in union(sizes).collect()} if sizes else {}
    samples = stored(value_cells(tables, named, share).distinct(), "samples")
    sought = F.broadcast(samples.select("d1", "d2").distinct())
    hits = stored(value_cells(tables, named).join(sought, ["d1", "d2"]).distinct(), "hits")
    sizes = {r["column_id"]: r["n"] for r in samples.groupBy("column_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    found, open_pairs = [], []
    for r in common_counts(hits, samples).collect():
        a, b = r["id_a"], r["id_b"]
        if table_of[a] == table_of[b]:
            continue
        if share[a] == 1:
            found.append((a, b, sizes[a], r["common"]))
        elif r["common"] / sizes[a] >= at_least - math.sqrt(math.log(1 / MISSED) / 2 / sizes[a]):
            open_pairs.append((a, b))
    if open_pairs:
        sources = {a for a, _ in open_pairs}
        values = value_cells(tables, [c for c in named if c.id in {i for pair in open_pairs for i in pair}]).distinct()
        values = stored(values, "values")
        whole = values.filter(F.col("column_id").isin(sources))
        sizes = {r["column_id"]: r["n"] for r in whole.groupBy("column_id").agg(F.count(F.lit(1)).alias("n")).collect()}
        common = {(r["id_a"], r["id_b"]): r["common"] for r in common_counts(values, whole).collect()}
        found += [(a, b, sizes[a], common.get((a, b), 0)) for a, b in open_pairs]
    names = {c.id: (c.table, c.name) for c in named}
    rows = [(*names[a], *names[b], n, both, both / n) for a, b, n, both in found if both / n >= at_least]
    text, number = pa.string(), pa.int64()
    return control_table(
        spark, rows, dataset_a=text, column_a=text, dataset_b=text, column_b=text, values=number, common_values=number, found_share=pa.float64()
    )


def text_mask(text: Column) -> Column:
    """Shape of a text: runs of capitals A, small letters a, digits 9, white space _."""
    masked = F.regexp_replace(text, r"\s+", "_")
    masked = F.regexp_replace(masked, r"[0-9]+", "9")
    masked = F.regexp_replace(masked, r"\p{Lu}+", "A")
    return F.regexp_replace(masked, r"[\p{L}&&[^A]]+", "a")


def format_consistency(tables: dict[str, DataFrame]) -> DataFrame:
    """Common text columns: dominant shape and parse shares in both tables, and whether the shapes agree."""
    parts = []
    for name, df in tables.items():
        texts = columns_of(df, "text")
        masks = df.select(*[text_mask(col(c)).alias(c) for c in texts])
        parts.append(format_fit(df, name).join(modes(masks, texts), "column", "left"))
    fits = union(parts)
    return shared(fits, fits).select(
        F.col("a.dataset_name").alias("dataset_a"),
        F.col("b.dataset_name").alias("dataset_b"),
        "column",
        F.col("a.top").alias("mask_a"),
        F.col("b.top").alias("mask_b"),
        F.col("a.number_share").alias("number_share_a"),
        F.col("b.number_share").alias("number_share_b"),
        F.col("a.date_share").alias("date_share_a"),
        F.col("b.date_share").alias("date_share_b"),
        F.col("a.top").eqNullSafe(F.col("b.top")).alias("same_mask"),
    )


def comparable(left: DataFrame, right: DataFrame, name: str) -> T.DataType:
    """A type that the values of both tables are compared in."""
    a, b = left.schema[name].dataType, right.schema[name].dataType
    if a == b:
        return a
    if isinstance(a, WHOLE) and isinstance(b, WHOLE):
        return T.LongType()
    return T.DoubleType() if type_class(a) == type_class(b) == "numeric" else T.StringType()


def value_conflicts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per common column: keys found in both tables whose values differ.

    Each side is first reduced to one row per key holding the smallest and largest digest of each column's
    cells (null counts as a value), so a repeated key never multiplies rows in the join, and the aggregates are of fixed
    width.
    """
    common = [c for c in left.columns if c in right.columns and c not in keys]

    def per_key(df, tag):
        cells = [cell_digest(known(df, c).cast(comparable(left, right, c))).alias(f"_{i}") for i, c in enumerate(common)]
        ends = [f(f"_{i}").alias(f"{tag}_{end}_{i}") for i in range(len(common)) for end, f in (("low", F.min), ("high", F.max))]
        return df.select(*[col(k) for k in keys], *cells).groupBy(*[col(k) for k in keys]).agg(*ends)

    both = per_key(left, "a").join(per_key(right, "b"), list(keys))
    wide = both.agg(
        F.count(F.lit(1)).alias("shared_keys"),
        *[
            count_where(
                (F.col(f"a_low_{i}") != F.col(f"b_low_{i}")) | (F.col(f"a_high_{i}") != F.col(f"b_high_{i}"))
            ).alias(f"n_{i}")
            for i in range(len(common))
        ],
    )
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n_{i}").alias("conflicts")) for i, c in enumerate(common)]
    return wide.select("shared_keys", F.inline(F.array(*rows)))


def complementary_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """For every ordered pair of tables, the filled columns that only the first one has."""
    catalog = column_catalog(tables)
    others = control_table(
        catalog.sparkSession,
        [(a, b) for a in tables for b in tables if a != b],
        dataset_name=pa.string(),
        missing_in=pa.string(),
    )
    present = catalog.select(F.col("dataset_name").alias("missing_in"), "column")
    return (
        catalog.join(others, "dataset_name")
        .join(present, ["missing_in", "column"], "left_anti")
        .select("dataset_name", "missing_in", "column", "data_type", "filled")
    )


def column_coverage(df: DataFrame, name: str, expected: Sequence[str]) -> DataFrame:
    """Share of the expected columns that the table has, and that it has with values."""
    wanted = control_table(df.sparkSession, [(c,) for c in expected], column=pa.string())
    filled = missing_counts(df, name).select(
        "column", (F.col("total_records") - F.col("missing_count")).alias("filled")
    )
    return (
        wanted.join(filled, "column", "left")
        .agg(
            F.count(F.lit(1)).alias("expected_columns"),
            F.count("filled").alias("present_columns"),
            count_where(F.col("filled") > 0).alias("filled_columns"),
        )
        .select(
            F.lit(name).alias("dataset_name"),
            "*",
            (F.col("present_columns") / F.col("expected_columns") * 100.0).alias("coverage_score"),
        )
    )
