"""Profile and flag queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.functions.columns import fixed
from rowsmith.operators import flags, profile
from rowsmith.queries.views import orders_dirty, table, with_views


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Doubles cut to four digits, so that both engines show the same value."""
    return df.withColumns({n: fixed(F.col(n)) for n in names})


def r4(expression: str) -> str:
    """The same rounding in SQL."""
    return f"CAST(floor(({expression}) * 10000 + 0.5) / 10000 AS DOUBLE)"


LINEITEM_RULES = [
    ("quantity_range", "l_quantity", "l_quantity BETWEEN 1 AND 45"),
    ("discount_range", "l_discount", "l_discount <= 0.05"),
    ("known_flag", "l_returnflag", "l_returnflag IN ('A', 'N')"),
]

DIRTY = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINEITEM_NUMERIC = [
    ("l_orderkey", "bigint"),
    ("l_partkey", "bigint"),
    ("l_suppkey", "bigint"),
    ("l_linenumber", "int"),
    ("l_quantity", "double"),
    ("l_extendedprice", "double"),
    ("l_discount", "double"),
    ("l_tax", "double"),
]
LINEITEM_OTHER = [("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]


def profile_basic(spark, sf_dir):
    stats = profile.basic_stats(orders_dirty(spark, sf_dir), "orders_dirty")
    return rounded(stats, "missing_percentage", "duplicate_percentage")


def profile_types(spark, sf_dir):
    """Types of the columns, with the rows that carry a value: the schema beside the data it describes."""
    df = orders_dirty(spark, sf_dir)
    types = profile.column_types(df, "orders_dirty").withColumn("ordinal", F.col("ordinal").cast("bigint"))
    counts = profile.missing_counts(df, "orders_dirty")
    filled = counts.select("column", (F.col("total_records") - F.col("missing_count")).alias("filled"))
    return types.join(filled, "column")


def profile_missing(spark, sf_dir):
    return rounded(profile.missing_by_column(orders_dirty(spark, sf_dir), "orders_dirty"), "missing_percentage")


def profile_columns(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").withColumn(
        "row_key", F.col("l_orderkey") * 100000 + F.col("l_partkey") * 10 + F.col("l_linenumber")
    )
    found = profile.column_summary(lineitem, "lineitem", order_by="row_key").filter("column <> 'row_key'")
    # Doubles print differently in the two engines, so only the other types show their samples as text.
    shown = F.when(F.col("data_type") != "double", F.array_join("sample_values", "|"))
    return rounded(found.withColumn("sample_values", shown), "min_value", "max_value", "mean_value")


def profile_numeric(spark, sf_dir):
    parts = [profile.numeric_summary(table(spark, sf_dir, t), t) for t in ("lineitem", "events")]
    found = reduce(DataFrame.unionByName, parts)
    return rounded(found, "min_value", "max_value", "mean_value", "std_value", "skewness")


def profile_top_values(spark, sf_dir):
    return profile.top_values(orders_dirty(spark, sf_dir), "orders_dirty")


def profile_describe(spark, sf_dir):
    found = profile.describe(table(spark, sf_dir, "part"), "part")
    return rounded(found, "mean_value", "std_value", "min_value", "q25", "q50", "q75", "max_value")


def profile_correlation(spark, sf_dir):
    return rounded(profile.correlations(table(spark, sf_dir, "lineitem"), "lineitem"), "correlation")


def profile_temporal(spark, sf_dir):
    return profile.temporal_profile(table(spark, sf_dir, "events"), "events", "ts", "day")


def profile_missing_patterns(spark, sf_dir):
    return profile.missing_patterns(orders_dirty(spark, sf_dir), "orders_dirty")


def profile_rare_pairs(spark, sf_dir):
    found = profile.rare_pairs(table(spark, sf_dir, "lineitem"), "lineitem", "l_quantity", "l_linenumber", limit=0.9)
    # The quantity is a whole number stored as a double: shown as such in both engines.
    whole = found.withColumn("value_a", F.col("value_a").cast("double").cast("bigint").cast("string"))
    return rounded(whole, "expected", "ratio")


def profile_format_fit(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    orders = orders_dirty(spark, sf_dir).withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    found = profile.format_fit(events, "events").unionByName(profile.format_fit(orders, "orders_dirty"))
    return rounded(found, "number_share", "date_share")


def flag_missing(spark, sf_dir):
    return rounded(flags.high_missing(orders_dirty(spark, sf_dir), "orders_dirty"), "missing_percentage")


def flag_uniqueness(spark, sf_dir):
    return rounded(flags.low_uniqueness(table(spark, sf_dir, "lineitem"), "lineitem"), "unique_percentage")


def flag_outliers(spark, sf_dir):
    found = flags.high_outliers(orders_dirty(spark, sf_dir), "orders_dirty").unionByName(
        flags.high_outliers(table(spark, sf_dir, "events"), "events")
    )
    return rounded(found, "outlier_percentage", "smallest", "largest")


def outlier_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return rounded(flags.outlier_rows(events, "value").select("event_id", "user_id", "event_type", "value"), "value")


def flag_list(spark, sf_dir):
    found = flags.problem_list(orders_dirty(spark, sf_dir), "orders_dirty")
    return found.withColumn("issues", F.array_join("issues", "; "))


def flag_inputs(spark, sf_dir):
    inputs = flags.flag_inputs(orders_dirty(spark, sf_dir), "orders_dirty")
    return rounded(inputs, "missing_data_percentage", "duplicate_percentage")


def flag_rules(spark, sf_dir):
    found = flags.rule_counts(table(spark, sf_dir, "lineitem"), "lineitem", LINEITEM_RULES)
    return rounded(found, "violation_percentage")


QUERIES = {
    f.__name__: f
    for f in (
        profile_basic,
        profile_types,
        profile_missing,
        profile_columns,
        profile_numeric,
        profile_top_values,
        profile_describe,
        profile_correlation,
        profile_temporal,
        profile_missing_patterns,
        profile_rare_pairs,
        profile_format_fit,
        flag_missing,
        flag_uniqueness,
        flag_outliers,
        outlier_rows,
        flag_list,
        flag_inputs,
        flag_rules,
    )
}


def union_all(parts) -> str:
    return "\nUNION ALL ".join(parts)


def missing_sql(c: str) -> str:
    return f"count(*) FILTER (WHERE {c} IS NULL)"


BASIC_SQL = f"""SELECT 'orders_dirty' AS dataset_name, count(*) AS total_records, CAST(6 AS BIGINT) AS total_columns,
  {" + ".join(missing_sql(c) for c in DIRTY)} AS missing_values_total,
  ({" + ".join(missing_sql(c) for c in DIRTY)}) / (count(*) * 6) * 100 AS missing_percentage,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders_dirty)) AS duplicate_rows,
  (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders_dirty))) / count(*) * 100 AS duplicate_percentage
  FROM orders_dirty"""

DIRTY_TYPES = ["bigint", "bigint", "string", "double", "timestamp_ntz", "string"]
DIRTY_CLASSES = ["numeric", "numeric", "text", "numeric", "datetime", "text"]


def summary_sql(c: str, data_type: str, numeric: bool) -> str:
    sample = (
        f"""(SELECT string_agg(v, '|' ORDER BY k) FROM (SELECT CAST({c} AS VARCHAR) AS v,
      l_orderkey * 100000 + l_partkey * 10 + l_linenumber AS k FROM lineitem WHERE {c} IS NOT NULL
      ORDER BY k, v LIMIT 5))"""
        if data_type != "double"
        else "CAST(NULL AS VARCHAR)"
    )
    stats = (
        f"{r4(f'min({c})')} AS min_value, {r4(f'max({c})')} AS max_value, {r4(f'avg({c})')} AS mean_value"
        if numeric
        else "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value, CAST(NULL AS DOUBLE) AS mean_value"
    )
    return f"""SELECT 'lineitem' AS dataset_name, '{c}' AS "column", '{data_type}' AS data_type,
    {missing_sql(c)} AS null_count, count(DISTINCT {c}) AS unique_count, {sample} AS sample_values, {stats}
    FROM lineitem"""


def numeric_sql(t: str, c: str) -> str:
    return f"""SELECT '{t}' AS dataset_name, '{c}' AS "column", count({c}) AS non_null,
    {r4(f'min({c})')} AS min_value, {r4(f'max({c})')} AS max_value, {r4(f'avg({c})')} AS mean_value,
    {r4(f'stddev_samp({c})')} AS std_value, {r4(f'skewness({c})')} AS skewness FROM {t}"""


def top_sql(c: str) -> str:
    return f"""SELECT 'orders_dirty' AS dataset_name, '{c}' AS "column",
    (SELECT count(*) FROM (SELECT DISTINCT {c} FROM orders_dirty)) AS unique_count,
    value_rank, value, value_count FROM (
      SELECT {c} AS value, count(*) AS value_count,
        row_number() OVER (ORDER BY count(*) DESC, {c}) AS value_rank
      FROM orders_dirty WHERE {c} IS NOT NULL GROUP BY {c}) WHERE value_rank <= 10"""


def describe_numeric_sql(c: str) -> str:
    quartiles = ", ".join(f"{r4(f'quantile_cont({c}, {q})')} AS q{int(q * 100)}" for q in (0.25, 0.5, 0.75))
    return f"""SELECT 'part' AS dataset_name, '{c}' AS "column", count({c}) AS value_count,
    CAST(NULL AS BIGINT) AS unique_count, CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq,
    {r4(f'avg({c})')} AS mean_value, {r4(f'stddev_samp({c})')} AS std_value, {r4(f'min({c})')} AS min_value,
    {quartiles}, {r4(f'max({c})')} AS max_value FROM part"""


def describe_text_sql(c: str) -> str:
    nothing = ", ".join(
        f"CAST(NULL AS DOUBLE) AS {n}" for n in ("mean_value", "std_value", "min_value", "q25", "q50", "q75", "max_value")
    )
    best = f"(SELECT {c} AS v, count(*) AS n FROM part GROUP BY {c} ORDER BY n DESC, v LIMIT 1)"
    return f"""SELECT 'part' AS dataset_name, '{c}' AS "column", count({c}) AS value_count,
    count(DISTINCT {c}) AS unique_count, (SELECT v FROM {best}) AS top, (SELECT n FROM {best}) AS freq, {nothing}
    FROM part"""


def outliers_sql(t: str, c: str) -> str:
    return f"""SELECT '{t}' AS dataset_name, '{c}' AS "column", total_records, outliers,
    outliers / total_records * 100 AS outlier_percentage, smallest, largest FROM (
      SELECT (SELECT count(*) FROM {t}) AS total_records, count(*) AS outliers,
        CAST(min({c}) AS DOUBLE) AS smallest, CAST(max({c}) AS DOUBLE) AS largest
      FROM {t}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {t})
      WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))
    WHERE outliers > total_records * 0.05"""


def uniqueness_sql(t: str, c: str) -> str:
    return f"""SELECT '{t}' AS dataset_name, '{c}' AS "column", unique_count, non_null,
    unique_count / non_null * 100 AS unique_percentage FROM (
      SELECT count(DISTINCT {c}) AS unique_count, count({c}) AS non_null FROM {t})
    WHERE unique_count / non_null * 100 < 10"""


def high_missing_sql(t: str, c: str) -> str:
    return f"""SELECT '{t}' AS dataset_name, '{c}' AS "column", total_records, missing_count,
    missing_count / total_records * 100 AS missing_percentage FROM (
      SELECT count(*) AS total_records, {missing_sql(c)} AS missing_count FROM {t})
    WHERE missing_count / total_records * 100 > 20"""


DIRTY_NUMERIC = ["o_orderkey", "o_custkey", "o_totalprice"]
# All flags of orders_dirty in long form; later queries build on it.
FLAGS_SQL = f"""flags AS (
  SELECT dataset_name, "column", 'missing' AS flag, 1 AS flag_order, missing_count AS affected,
    missing_percentage AS percentage, printf('High missing data: %.1f%%', missing_percentage) AS message,
    '' AS examples
  FROM ({union_all(high_missing_sql("orders_dirty", c) for c in DIRTY)})
  UNION ALL SELECT dataset_name, "column", 'uniqueness', 2, non_null - unique_count, unique_percentage,
    printf('Low uniqueness: %.1f%%', unique_percentage), ''
  FROM ({union_all(uniqueness_sql("orders_dirty", c) for c in DIRTY_NUMERIC)})
  UNION ALL SELECT dataset_name, "column", 'outliers', 3, outliers, outlier_percentage,
    printf('High outlier rate: %d/%d', outliers, total_records), printf('%.2f|%.2f', smallest, largest)
  FROM ({union_all(outliers_sql("orders_dirty", c) for c in DIRTY_NUMERIC)}))"""


def fit_sql(t: str, c: str, expression: str) -> str:
    number = profile.NUMBER_PATTERN
    date = profile.DATE_PATTERN
    return f"""SELECT '{t}' AS dataset_name, '{c}' AS "column", count({expression}) AS non_null,
    {r4(f"count(*) FILTER (WHERE regexp_matches({expression}, '{number}')) / count({expression})")} AS number_share,
    {r4(f"count(*) FILTER (WHERE regexp_matches({expression}, '{date}')) / count({expression})")} AS date_share
    FROM {t}"""


def pairs(names):
    return [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]


ORACLES = {
    "profile_basic": with_views("orders_dirty")
    + f"""SELECT dataset_name, total_records, total_columns, missing_values_total,
  {r4("missing_percentage")} AS missing_percentage, duplicate_rows,
  {r4("duplicate_percentage")} AS duplicate_percentage, CAST(3 AS BIGINT) AS numeric_columns,
  CAST(2 AS BIGINT) AS text_columns, CAST(1 AS BIGINT) AS datetime_columns FROM ({BASIC_SQL})""",
    "profile_types": with_views("orders_dirty")
    + union_all(
        f"""SELECT 'orders_dirty' AS dataset_name, '{c}' AS "column", CAST({i} AS BIGINT) AS ordinal,
    '{t}' AS data_type, '{k}' AS type_class, count({c}) AS filled FROM orders_dirty"""
        for i, (c, t, k) in enumerate(zip(DIRTY, DIRTY_TYPES, DIRTY_CLASSES))
    ),
    "profile_missing": with_views("orders_dirty")
    + "SELECT * FROM ("
    + union_all(
        f"""SELECT 'orders_dirty' AS dataset_name, '{c}' AS "column", {missing_sql(c)} AS missing_count,
    {r4(f"{missing_sql(c)} / count(*) * 100")} AS missing_percentage FROM orders_dirty"""
        for c in DIRTY
    )
    + ") WHERE missing_count > 0",
    "profile_columns": union_all(
        [summary_sql(c, t, True) for c, t in LINEITEM_NUMERIC] + [summary_sql(c, t, False) for c, t in LINEITEM_OTHER]
    ),
    "profile_numeric": union_all(
        [numeric_sql("lineitem", c) for c, _ in LINEITEM_NUMERIC]
        + [numeric_sql("events", c) for c in ("event_id", "user_id", "value")]
    ),
    "profile_top_values": with_views("orders_dirty")
    + union_all(top_sql(c) for c in ("o_orderstatus", "o_orderpriority")),
    "profile_describe": union_all(
        [describe_numeric_sql(c) for c in ("p_partkey", "p_size", "p_retailprice")]
        + [describe_text_sql(c) for c in ("p_name", "p_brand", "p_type")]
    ),
    "profile_correlation": union_all(
        f"SELECT 'lineitem' AS dataset_name, '{a}' AS column_a, '{b}' AS column_b, {r4(f'corr({a}, {b})')} AS correlation"
        " FROM lineitem"
        for a, b in pairs([c for c, _ in LINEITEM_NUMERIC])
    ),
    "profile_temporal": """SELECT 'events' AS dataset_name, 'ts' AS "column",
  strftime(day, '%Y-%m-%d %H:%M:%S') AS bucket, n AS row_count,
  CAST(date_diff('day', lag(day) OVER (ORDER BY day), day) AS BIGINT) AS gap_days
  FROM (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, count(*) AS n FROM events GROUP BY 1)""",
    "profile_missing_patterns": with_views("orders_dirty")
    + f"""SELECT 'orders_dirty' AS dataset_name, missing_columns, count(*) AS row_count FROM (
  SELECT concat_ws(',', {", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in DIRTY)}) AS missing_columns
  FROM orders_dirty) GROUP BY missing_columns""",
    "profile_rare_pairs": f"""WITH p AS (SELECT l_quantity AS a, l_linenumber AS b, count(*) AS observed
  FROM lineitem GROUP BY 1, 2),
  e AS (SELECT a, b, observed, CAST(sum(observed) OVER (PARTITION BY a) AS DOUBLE)
    * sum(observed) OVER (PARTITION BY b) / sum(observed) OVER () AS expected FROM p)
SELECT 'lineitem' AS dataset_name, 'l_quantity' AS column_a, 'l_linenumber' AS column_b,
  CAST(CAST(a AS BIGINT) AS VARCHAR) AS value_a, CAST(b AS VARCHAR) AS value_b, observed,
  {r4("expected")} AS expected, {r4("observed / expected")} AS ratio FROM e WHERE observed / expected < 0.9""",
    "profile_format_fit": with_views("orders_dirty")
    + union_all(
        [
            fit_sql("events", "event_type", "event_type"),
            fit_sql("events", "props", "props"),
            fit_sql("events", "k", "json_extract_string(props, '$.k')"),
            fit_sql("orders_dirty", "o_orderstatus", "o_orderstatus"),
            fit_sql("orders_dirty", "o_orderpriority", "o_orderpriority"),
            fit_sql("orders_dirty", "day", "strftime(o_orderdate, '%Y-%m-%d')"),
        ]
    ),
    "flag_missing": with_views("orders_dirty")
    + f"""SELECT dataset_name, "column", total_records, missing_count, {r4("missing_percentage")} AS missing_percentage
  FROM ({union_all(high_missing_sql("orders_dirty", c) for c in DIRTY)})""",
    "flag_uniqueness": f"""SELECT dataset_name, "column", unique_count, non_null,
  {r4("unique_percentage")} AS unique_percentage
  FROM ({union_all(uniqueness_sql("lineitem", c) for c, _ in LINEITEM_NUMERIC)})""",
    "flag_outliers": with_views("orders_dirty")
    + f"""SELECT dataset_name, "column", total_records, outliers, {r4("outlier_percentage")} AS outlier_percentage,
  {r4("smallest")} AS smallest, {r4("largest")} AS largest
  FROM ({union_all([outliers_sql("orders_dirty", c) for c in DIRTY_NUMERIC]
                   + [outliers_sql("events", c) for c in ("event_id", "user_id", "value")])})""",
    "outlier_rows": f"""SELECT event_id, user_id, event_type, {r4("value")} AS value FROM events,
  (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
  WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
    "flag_list": with_views("orders_dirty", FLAGS_SQL)
    + """SELECT dataset_name, "column", string_agg(message, '; ' ORDER BY flag_order) AS issues
  FROM flags GROUP BY dataset_name, "column" """,
    "flag_inputs": with_views("orders_dirty")
    + f"""SELECT dataset_name, total_records, {r4("missing_percentage")} AS missing_data_percentage,
  {r4("duplicate_percentage")} AS duplicate_percentage FROM ({BASIC_SQL})""",
    "flag_rules": union_all(
        f"""SELECT 'lineitem' AS dataset_name, '{r}' AS rule_id, '{c}' AS "column",
    count(*) FILTER (WHERE NOT ({p})) AS violations,
    {r4(f"count(*) FILTER (WHERE NOT ({p})) / count(*) * 100")} AS violation_percentage FROM lineitem"""
        for r, c, p in LINEITEM_RULES
    ),
}
