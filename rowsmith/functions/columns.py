"""Column helpers: missing values, type classes, text clean-up, rounding, row reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRACTIONAL = (T.FloatType, T.DoubleType)
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMERIC = FRACTIONAL + WHOLE + (T.DecimalType,)
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def col(name: str) -> Column:
    """Column by its literal name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def type_class(data_type: T.DataType) -> str:
    """numeric, text, datetime or other (booleans and nested types)."""
    if isinstance(data_type, NUMERIC):
        return "numeric"
    if isinstance(data_type, T.StringType):
        return "text"
    if isinstance(data_type, TEMPORAL):
        return "datetime"
    return "other"


def columns_of(df: DataFrame, wanted: str) -> list[str]:
    """Names of the columns of one type class, in schema order."""
    return [f.name for f in df.schema.fields if type_class(f.dataType) == wanted]


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column."""
    if isinstance(df.schema[name].dataType, FRACTIONAL):
        return col(name).isNull() | F.isnan(col(name))
    return col(name).isNull()


def known(df: DataFrame, name: str) -> Column:
    """The value with NaN turned into null, so that aggregates and groups treat both alike."""
    if isinstance(df.schema[name].dataType, FRACTIONAL):
        return F.when(~F.isnan(col(name)), col(name))
    return col(name)


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds; 0, not null, on an empty table."""
    return F.count(F.when(condition, F.lit(1)))


def percentage(part: Column, whole: Column) -> Column:
    """part / whole * 100, null when the whole is 0."""
    return part / F.nullif(whole.cast("double"), F.lit(0.0)) * 100.0


def fixed(value: Column, digits: int = 4) -> Column:
    """Half-up rounding that gives the same digits in every engine."""
    scale = float(10**digits)
    return (F.floor(value * scale + 0.5) / scale).cast("double")


def one_decimal(value: Column) -> Column:
    """Text of a non-negative number with one digit after the point, rounded on the exact value of the double.

    Ten times the value is the sum of two exact multiples; what the sum rounds off decides seeming ties, as in
    C and Python (0.15 is a little less than its decimal form and gives 0.1).
    """
    ten = value * 8 + value * 2
    lost = value * 2 - (ten - value * 8)
    tie = (ten - F.floor(ten)) == 0.5
    tenths = (
        F.when(tie & (lost < 0), F.floor(ten))
        .when(tie & (lost > 0), F.floor(ten) + 1)
        .otherwise(F.rint(ten).cast("bigint"))
    )
    whole = F.floor(tenths / 10).cast("bigint")
    return F.concat(whole.cast("string"), F.lit("."), (tenths - whole * 10).cast("string"))


def strip_space(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def title_case(text: Column) -> Column:
    """First letter of every run of letters in upper case, the rest in lower case."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """True when the text contains at least one of the words as a substring.

    Plain searches one after the other are about three times faster than one pattern of all words.
    """
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(word)) for word in words])


def computed_once(df: DataFrame, keep: Sequence[str], **values: Column) -> DataFrame:
    """Columns whose costly expressions must not be repeated by filters and projections above.

    The optimizer writes the expression of a column into every filter on it. A one-element inline is not
    looked through, so a text is extracted, or an answer parsed, once per row.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*[v.alias(n) for n, v in values.items()]))))


def outcome(value: Column) -> Column:
    """What an expression gives on a row, as text that never raises: `=` and the value, `-` for null, and null where the
    expression fails (division by zero, overflow, a cast of odd text).

    It rests on try_to_binary, which turns whatever its argument raises into null."""
    text = F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))
    return F.try_to_binary(text, F.lit("utf-8")).cast("string")


def quoted(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def aggregated(df: DataFrame, expressions: Sequence[str]) -> DataFrame:
    """Whole-table aggregate of SQL expressions; one text per figure keeps wide aggregates quick to build."""
    return df.agg(*[F.expr(e) for e in expressions])


def long_rows(wide: DataFrame, names: dict[int, str], fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Turn one row of per-column aggregates named ``field_ordinal`` into one row per column."""
    rows = ", ".join(
        f"named_struct('column', {quoted(name)}, 'ordinal', {i}, "
        + ", ".join(f"'{field}', {field}_{i}" for field in fields)
        + ")"
        for i, name in names.items()
    )
    return wide.selectExpr(*keep, f"inline(array({rows}))")


# Aggregates of one scan stay below this sum of costs: generated code beyond it is too long to be compiled to
# machine code, and runs several times slower.
ROOM = 32


def column_figures(
    df: DataFrame,
    names: Sequence[str],
    fields: dict[str, str],
    cast: str | None = None,
    cost: int = 1,
    constants: dict[str, dict[str, str]] | None = None,
) -> DataFrame:
    """Aggregates per column in long form: column, ordinal, total_records and the fields.

    A field is an SQL aggregate over {v}, the value of the column without NaN, and the constants of its
    column. Columns are spread over several scans when one scan would aggregate too much; each scan reads only its columns.
    """
    per_scan = max(1, ROOM // (cost * len(fields)))
    parts = []
    numbered = list(enumerate(names))
    for start in range(0, len(numbered), per_scan):
        chunk = dict(numbered[start : start + per_scan])
        values = [known(df, c).cast(cast) if cast else known(df, c) for c in chunk.values()]
        rows = df.select(*[v.alias(f"v_{i}") for i, v in zip(chunk, values)])
        figures = [
            f"{sql.format(v=f'v_{i}', **(constants or {}).get(c, {}))} AS {field}_{i}"
            for i, c in chunk.items()
            for field, sql in fields.items()
        ]
        wide = aggregated(rows, ["count(*) AS total_records", *figures])
        parts.append(long_rows(wide, chunk, list(fields), keep=["total_records"]))
    if not parts:
        typed = [f"CAST(NULL AS DOUBLE) AS {field}" for field in fields]
        return df.sparkSession.range(0).selectExpr(
            "id AS total_records", "CAST(NULL AS STRING) AS column", "CAST(NULL AS INT) AS ordinal", *typed
        )
    return reduce(DataFrame.unionByName, parts)


def control_table(spark: SparkSession, rows: Sequence[Sequence], **columns: pa.DataType) -> DataFrame:
    """A small literal table. Its size is known to the optimizer, which then may broadcast it."""
    names = list(columns)
    schema = pa.schema([pa.field(n, columns[n]) for n in names])
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(names, r)) for r in rows], schema=schema))
