"""Queries over several tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.operators import collection, issues
from rowsmith.plans import quality
from rowsmith.queries.issues import BASE, SCORES_SQL, TABLE_COLUMNS, checked_tables
from rowsmith.queries.profiles import DIRTY, DIRTY_CLASSES, DIRTY_TYPES, fit_sql, r4, rounded, union_all
from rowsmith.queries.views import orders_dirty, part_dirty, table, with_views

ORDERS_TYPES = dict(zip(DIRTY, zip(DIRTY_TYPES, DIRTY_CLASSES)))
#: All given tables, and their columns by kind of value (lists are not compared).
COLUMNS = {
    "region": {"whole": ["r_regionkey"], "text": ["r_name"]},
    "nation": {"whole": ["n_nationkey", "n_regionkey"], "text": ["n_name"]},
    "customer": {"whole": ["c_custkey", "c_nationkey"], "fraction": ["c_acctbal"], "text": ["c_name", "c_mktsegment"]},
    "supplier": {"whole": ["s_suppkey", "s_nationkey"], "fraction": ["s_acctbal"], "text": ["s_name"]},
    "part": {"whole": ["p_partkey", "p_size"], "fraction": ["p_retailprice"], "text": ["p_name", "p_brand", "p_type"]},
    "orders": {
        "whole": ["o_orderkey", "o_custkey"],
        "fraction": ["o_totalprice"],
        "time": ["o_orderdate"],
        "text": ["o_orderstatus", "o_orderpriority"],
    },
    "lineitem": {
        "whole": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
        "fraction": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        "time": ["l_shipdate"],
        "text": ["l_returnflag", "l_linestatus"],
    },
    "events": {"whole": ["event_id", "user_id"], "fraction": ["value"], "time": ["ts"], "text": ["event_type", "props"]},
    "documents": {"whole": ["doc_id", "n_chars"], "text": ["text", "lang", "source"]},
    "embeddings": {"whole": ["vec_id", "label"]},
    "pages": {"whole": ["page_id"], "text": ["url", "html"]},
    "benchmark": {"whole": ["item_id"], "text": ["text"]},
    "labels": {"whole": ["doc_id", "quality", "toxic"]},
    "conversations": {"whole": ["conv_id", "turn"], "text": ["role", "text"]},
}
EXPECTED = ["o_orderkey", "o_custkey", "o_totalprice", "o_comment", "o_clerk"]


def judged(spark, sf_dir):
    tables = checked_tables(spark, sf_dir)
    found, stats = quality.detect(tables)
    return tables, found, issues.quality_scores(found, stats)


def versions(spark, sf_dir):
    """Two versions of orders and of part: as given and dirty. The dirty price is kept as text in one."""
    dirty = orders_dirty(spark, sf_dir)
    return {
        "orders": table(spark, sf_dir, "orders"),
        "orders_dirty": dirty.withColumn("o_orderstatus", F.ascii("o_orderstatus")).drop("o_custkey"),
        "part": table(spark, sf_dir, "part"),
        "part_dirty": part_dirty(spark, sf_dir).withColumn("p_size", F.col("p_size") * 10),
    }


def run_totals(spark, sf_dir):
    _, found, scores = judged(spark, sf_dir)
    return collection.run_totals(found, scores)


def collection_summary(spark, sf_dir):
    _, found, scores = judged(spark, sf_dir)
    return rounded(collection.collection_summary(found, scores), "avg_quality_score")


def table_comparison(spark, sf_dir):
    rows = collection.table_comparison(*judged(spark, sf_dir))
    texts = {c: F.array_join(c, ";") for c in ("columns", "major_issues")}
    return rounded(rows.withColumns(texts), "quality_score")


def schema_overlap(spark, sf_dir):
    return collection.schema_overlap(versions(spark, sf_dir))


def compatibility(spark, sf_dir):
    return rounded(collection.compatibility(versions(spark, sf_dir)), "compatibility_score")


def range_overlap(spark, sf_dir):
    return rounded(collection.range_overlap(versions(spark, sf_dir)), "overlap_from", "overlap_to")


def join_candidates(spark, sf_dir):
    """All columns of all tables."""
    return rounded(collection.join_candidates({t: table(spark, sf_dir, t) for t in COLUMNS}), "found_share")


def format_consistency(spark, sf_dir):
    tables = {
        "orders": table(spark, sf_dir, "orders"),
        "orders_dirty": orders_dirty(spark, sf_dir),
    }
    found = collection.format_consistency(tables)
    return rounded(found, "number_share_a", "number_share_b", "date_share_a", "date_share_b")


def value_conflicts(spark, sf_dir):
    return collection.value_conflicts(
        table(spark, sf_dir, "orders"), orders_dirty(spark, sf_dir), ["o_orderkey"]
    )


def complementary_columns(spark, sf_dir):
    return collection.complementary_columns(versions(spark, sf_dir))


def column_coverage(spark, sf_dir):
    df = orders_dirty(spark, sf_dir)
    return rounded(collection.column_coverage(df, "orders_dirty", EXPECTED), "coverage_score")


QUERIES = {
    f.__name__: f
    for f in (
        run_totals,
        collection_summary,
        table_comparison,
        schema_overlap,
        compatibility,
        range_overlap,
        join_candidates,
        format_consistency,
        value_conflicts,
        complementary_columns,
        column_coverage,
    )
}

DATA_TYPES = {
    "orders_dirty": DIRTY_TYPES,
    "events": ["bigint", "timestamp_ntz", "bigint", "string", "double", "string"],
    "lineitem": ["bigint"] * 3 + ["int"] + ["double"] * 4 + ["string", "string", "timestamp_ntz"],
}

# Columns of the four versions: name, type, type class.
PART_TYPES = {
    "p_partkey": ("bigint", "numeric"),
    "p_name": ("string", "text"),
    "p_brand": ("string", "text"),
    "p_type": ("string", "text"),
    "p_size": ("int", "numeric"),
    "p_retailprice": ("double", "numeric"),
}
VERSION_COLUMNS = {
    "orders": ORDERS_TYPES,
    "orders_dirty": {
        **{c: t for c, t in ORDERS_TYPES.items() if c != "o_custkey"},
        "o_orderstatus": ("int", "numeric"),
    },
    "part": PART_TYPES,
    "part_dirty": PART_TYPES,
}
CHANGED = {
    ("orders_dirty", "o_orderstatus"): "ascii(o_orderstatus)",
    ("part_dirty", "p_size"): "p_size * 10",
}
CATALOG_SQL = (
    "catalog AS ("
    + union_all(
        f"""SELECT '{t}' AS dataset_name, '{c}' AS "column", '{d}' AS data_type, '{k}' AS type_class,
    count({c}) AS filled FROM {t}"""
        for t, cols in VERSION_COLUMNS.items()
        for c, (d, k) in cols.items()
    )
    + ")"
)
RANGES_SQL = (
    "ranges AS ("
    + union_all(
        f"""SELECT '{t}' AS dataset_name, '{c}' AS "column",
    CAST(min({CHANGED.get((t, c), c)}) AS DOUBLE) AS lo, CAST(max({CHANGED.get((t, c), c)}) AS DOUBLE) AS hi FROM {t}"""
        for t, cols in VERSION_COLUMNS.items()
        for c, (_, k) in cols.items()
        if k == "numeric"
    )
    + ")"
)
OVERLAP_SQL = """overlap AS (
  SELECT a.dataset_name AS dataset_a, b.dataset_name AS dataset_b, a."column", a.data_type AS type_a,
    b.data_type AS type_b, a.filled AS filled_a, b.filled AS filled_b, a.type_class <> b.type_class AS type_conflict
  FROM catalog a JOIN catalog b ON a."column" = b."column" AND a.dataset_name < b.dataset_name)"""

SQL_TYPES = {"whole": "BIGINT", "fraction": "DOUBLE", "time": "TIMESTAMP", "text": "VARCHAR"}
VALUES_SQL = "vals AS (" + "\nUNION ".join(
    f"SELECT '{t}' AS d, '{c}' AS c, '{kind}' || CAST(CAST({c} AS {SQL_TYPES[kind]}) AS VARCHAR) AS v FROM {t} WHERE {c} IS NOT NULL"
    for t, kinds in COLUMNS.items()
    for kind, cols in kinds.items()
    for c in cols
) + ")"


def mask_sql(c: str) -> str:
    """The shape of a text; letters are turned one class after the other."""
    return (
        "regexp_replace(regexp_replace(regexp_replace(regexp_replace("
        + c
        + r", '\s+', '_', 'g'), '[0-9]+', '9', 'g'), '\p{Lu}+', 'A', 'g'), '[\p{Ll}\p{Lt}\p{Lm}\p{Lo}B-Z]+', 'a', 'g')"
    )


def consistency_sql(t: str, c: str) -> str:
    fits = fit_sql(t, c, c)
    return f"""SELECT f.*, (SELECT m FROM (SELECT {mask_sql(c)} AS m, count(*) AS n FROM {t} WHERE {c} IS NOT NULL
    GROUP BY 1 ORDER BY n DESC, m LIMIT 1)) AS mask FROM ({fits}) f"""


CONFLICT_COLUMNS = [c for c in DIRTY if c != "o_orderkey"]
VERSION_VIEWS = ("orders_dirty", "part_dirty")

ORACLES = {
    "run_totals": with_views(*BASE)
    + """SELECT (SELECT count(*) FROM stats) AS datasets_analyzed, count(*) AS total_issues_found,
  count(*) FILTER (WHERE severity = 'critical') AS critical_issues_count FROM issues""",
    "collection_summary": with_views(*BASE, SCORES_SQL)
    + f"""SELECT {r4("avg(quality_score)")} AS avg_quality_score, CAST(sum(total_records) AS BIGINT) AS total_records,
  (SELECT count(*) FROM issues WHERE severity = 'critical') AS total_critical_issues,
  count(*) FILTER (WHERE quality_score > 75) AS datasets_with_high_quality FROM scores""",
    "table_comparison": with_views(
        *BASE,
        SCORES_SQL,
        "shapes(dataset_name, column_count, columns) AS (VALUES "
        + ", ".join(
            f"('{t}', CAST({len(cols[0])} AS BIGINT), '"
            + ";".join(f"{c}:{d}" for c, d in zip(cols[0], DATA_TYPES[t]))
            + "')"
            for t, cols in TABLE_COLUMNS.items()
        )
        + ")",
    )
    + f"""SELECT s.dataset_name, s.total_records, {r4("s.quality_score")} AS quality_score, h.column_count, h.columns,
  coalesce((SELECT string_agg(description, ';' ORDER BY description) FROM issues i
    WHERE i.dataset_name = s.dataset_name AND severity IN ('critical', 'high')), '') AS major_issues,
  (SELECT count(*) FROM issues i WHERE i.dataset_name = s.dataset_name AND severity = 'critical') AS critical_issues
  FROM scores s JOIN shapes h ON s.dataset_name = h.dataset_name""",
    "schema_overlap": with_views(*VERSION_VIEWS, CATALOG_SQL, OVERLAP_SQL) + "SELECT * FROM overlap",
    "compatibility": with_views(*VERSION_VIEWS, CATALOG_SQL, OVERLAP_SQL)
    + f"""SELECT dataset_a, dataset_b, count(*) AS common_columns,
  {r4("count(*) FILTER (WHERE NOT type_conflict AND filled_a > 0 AND filled_b > 0) / count(*)")} AS compatibility_score
  FROM overlap GROUP BY dataset_a, dataset_b""",
    "range_overlap": with_views(*VERSION_VIEWS, RANGES_SQL)
    + f"""SELECT a.dataset_name AS dataset_a, b.dataset_name AS dataset_b, a."column",
  CASE WHEN greatest(a.lo, b.lo) <= least(a.hi, b.hi) THEN {r4("greatest(a.lo, b.lo)")} END AS overlap_from,
  CASE WHEN greatest(a.lo, b.lo) <= least(a.hi, b.hi) THEN {r4("least(a.hi, b.hi)")} END AS overlap_to,
  greatest(a.lo, b.lo) <= least(a.hi, b.hi) AS overlaps
  FROM ranges a JOIN ranges b ON a."column" = b."column" AND a.dataset_name < b.dataset_name""",
    "join_candidates": f"""WITH {VALUES_SQL}
SELECT a.d AS dataset_a, a.c AS column_a, b.d AS dataset_b, b.c AS column_b, n AS values,
  count(*) AS common_values, {r4("count(*) / n")} AS found_share
  FROM vals a JOIN vals b ON a.v = b.v AND a.d <> b.d
  JOIN (SELECT d, c, count(*) AS n FROM vals GROUP BY d, c) s ON s.d = a.d AND s.c = a.c
  GROUP BY a.d, a.c, b.d, b.c, n HAVING count(*) / n >= 0.5""",
    "format_consistency": with_views(
        "orders_dirty",
        "fits AS ("
        + union_all(
            consistency_sql(t, c) for t in ("orders", "orders_dirty") for c in ("o_orderstatus", "o_orderpriority")
        )
        + ")",
    )
    + """SELECT a.dataset_name AS dataset_a, b.dataset_name AS dataset_b, a."column", a.mask AS mask_a, b.mask AS mask_b,
  a.number_share AS number_share_a, b.number_share AS number_share_b, a.date_share AS date_share_a,
  b.date_share AS date_share_b, a.mask IS NOT DISTINCT FROM b.mask AS same_mask
  FROM fits a JOIN fits b ON a."column" = b."column" AND a.dataset_name < b.dataset_name""",
    "value_conflicts": with_views("orders_dirty", "d AS (SELECT DISTINCT * FROM orders_dirty)")
    + union_all(
        f"""SELECT '{c}' AS "column", count(*) AS shared_keys,
    count(*) FILTER (WHERE o.{c} IS DISTINCT FROM d.{c}) AS conflicts
    FROM orders o JOIN d ON o.o_orderkey = d.o_orderkey"""
        for c in CONFLICT_COLUMNS
    ),
    "complementary_columns": with_views(*VERSION_VIEWS, CATALOG_SQL)
    + """SELECT c.dataset_name, t.missing_in, c."column", c.data_type, c.filled
  FROM catalog c JOIN (SELECT DISTINCT dataset_name AS missing_in FROM catalog) t ON c.dataset_name <> t.missing_in
  WHERE NOT EXISTS (SELECT 1 FROM catalog o WHERE o.dataset_name = t.missing_in AND o."column" = c."column")""",
    "column_coverage": with_views("orders_dirty")
    + """SELECT 'orders_dirty' AS dataset_name, CAST(5 AS BIGINT) AS expected_columns,
  CAST(3 AS BIGINT) AS present_columns,
  (SELECT CAST((count(o_orderkey) > 0) AS BIGINT) + CAST((count(o_custkey) > 0) AS BIGINT)
    + CAST((count(o_totalprice) > 0) AS BIGINT) FROM orders_dirty) AS filled_columns,
  CAST(60 AS DOUBLE) AS coverage_score""",
}
