"""Repeatable synthetic rows from a column specification.

Every cell is a hash of seed, column name and row key, so tables of any size are generated in parallel with
no shuffle, and come out the same on every run and for every partitioning. A specification is a short list
of (column, type) pairs; types are string, int, float, date, categorical, boolean, id.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.functions import json_text
from rowsmith.functions.columns import col, computed_once, contains_any
from rowsmith.functions.hashing import digest, hash_int, pick, slot

# Name parts that select a rule, value ranges, categories and id formats.
ID_WORDS = ["id"]
PERSON_WORDS = ["patient", "person"]
PERSON_FORMAT, ID_FORMAT = "PAT_%06d", "ID_%06d"
AGE_WORDS, AGE_RANGE = ["age"], (18, 90)
YEAR_WORDS, YEAR_RANGE = ["year"], (1950, 2023)
INT_RANGE = (0, 100)
METRIC_WORDS = ["score", "index", "ratio", "rate"]
SEX_WORDS, SEX_VALUES = ["sex", "gender"], ["Male", "Female"]
ORIGIN_WORDS, ORIGIN_VALUES = ["ethnicity", "race"], ["White", "Black", "Asian", "Hispanic", "Other"]
FREQUENCY_WORDS, FREQUENCY_VALUES = ["frequency"], ["Never", "Rarely", "Monthly", "Weekly", "Daily"]
OTHER_VALUES = ["Value_1", "Value_2", "Value_3", "Value_4", "Value_5"]
BATCH_SIZE = 10
DAYS_BACK = 1826
TEXT_LENGTH = 50
ABSENT = "Unknown"

# Constant samples by domain, first matching name part wins.
CONSTANT_SAMPLES = {
    "medical": [
        (["age"], "45"),
        (["patient", "id"], "P001"),
        (["gender", "sex"], "Male"),
        (["alcohol"], "Yes"),
        (["liver"], "Cirrhosis"),
    ],
    "financial": [(["price"], "100.5"), (["date"], "2024-01-01"), (["symbol"], "STOCK")],
}
OTHER_SAMPLE = "Sample Value"

# Words of generated texts and names (ours).
WORDS = [
    "amber", "basin", "cedar", "delta", "ember", "field", "grain", "harbor", "island", "juniper", "kettle",
    "lantern", "meadow", "north", "orchard", "pebble", "quarry", "river", "saddle", "timber", "upland", "valley",
    "willow", "yarrow",
]
FIRST_NAMES = ["Ada", "Ben", "Cara", "Dan", "Eva", "Finn", "Gina", "Hugo", "Ines", "Jon"]
LAST_NAMES = ["Archer", "Baker", "Cooper", "Dyer", "Fisher", "Glover", "Harper", "Mason", "Porter", "Weaver"]

SPEC_SCHEMA = (
    "struct<dataset_name:string, description:string, columns:array<string>,"
    " column_details:map<string,struct<type:string>>, row_count:double, domain_specific_rules:array<string>>"
)


def named(name: str, words: Sequence[str], whole_parts: bool = False) -> bool:
    """Does a column name hold one of the words: anywhere in it, or only as a whole part of it."""
    if whole_parts:
        split = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
        parts = [p for p in re.split(r"[^a-z0-9]+", split.lower()) if p]
        return any(w in parts for w in words)
    return any(w in name.lower() for w in words)


def between(number: Column, low: int, high: int) -> Column:
    """Integer of an inclusive range."""
    return (F.pmod(number, F.lit(high - low + 1)) + low).cast("int")


def text_of(cell_digest: Column, words: int = 8) -> Column:
    """Words picked by the pairs of digits of a digest, first letter in upper case."""
    options = F.array(*[F.lit(w) for w in WORDS])
    picked = [
        F.element_at(
            options,
            (F.pmod(F.conv(F.substring(cell_digest, 2 * i + 1, 2), 16, 10).cast("int"), F.lit(len(WORDS))) + 1),
        )
        for i in range(words)
    ]
    text = F.array_join(F.array(*picked), " ")
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 1_000))


def cell(
    name: str, kind: str, key: Column, seed: int, anchor: Column, whole_parts: bool = False
) -> Column:
    """Value of one column for a zero-based row key. The first rule that fits the name or type applies."""
    number = hash_int(seed, name, key)
    if kind == "id" or named(name, ID_WORDS, whole_parts):
        form = PERSON_FORMAT if named(name, PERSON_WORDS, whole_parts) else ID_FORMAT
        return F.format_string(form, key.cast("bigint") + 1)
    if kind == "int" or named(name, AGE_WORDS + YEAR_WORDS, whole_parts):
        if named(name, AGE_WORDS, whole_parts):
            return between(number, *AGE_RANGE)
        if named(name, YEAR_WORDS, whole_parts):
            return between(number, *YEAR_RANGE)
        return between(number, *INT_RANGE)
    if kind == "float" or named(name, METRIC_WORDS, whole_parts):
        return F.pmod(number, F.lit(10_001)) / F.lit(100.0)
    if kind == "date":
        return F.date_format(F.date_sub(anchor, F.pmod(number, F.lit(DAYS_BACK + 1)).cast("int")), "yyyy-MM-dd")
    if kind == "boolean":
        return F.pmod(number, F.lit(2)) == 0
    if kind == "categorical":
        if named(name, SEX_WORDS, whole_parts):
            return pick(number, SEX_VALUES)
        if named(name, ORIGIN_WORDS, whole_parts):
            return pick(number, ORIGIN_VALUES)
        if named(name, FREQUENCY_WORDS, whole_parts):
            return pick(number, FREQUENCY_VALUES)
        return pick(number, OTHER_VALUES)
    return F.substring(text_of(digest(seed, name, key)), 1, TEXT_LENGTH)


def anchor_date(anchor: str | None) -> Column:
    """The day that dates count back from: a given one, or today."""
    return F.current_date() if anchor is None else F.lit(anchor).cast("date")


def generate_table(
    keys: DataFrame,
    key: str,
    spec: Sequence[tuple[str, str]],
    seed: int = 0,
    anchor: str | None = None,
    whole_parts: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per key with all columns of the specification."""
    day = anchor_date(anchor)
    cells = [cell(n, k, col(key), seed, day, whole_parts).alias(n) for n, k in spec]
    return keys.select(*[col(c) for c in keep], *cells)


def generate_rows(
    spark: SparkSession,
    n: int,
    spec: Sequence[tuple[str, str]],
    seed: int = 0,
    anchor: str | None = None,
    whole_parts: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """n rows of a specification."""
    return generate_table(spark.range(0, n, 1, partitions), "id", spec, seed, anchor, whole_parts)


def with_batches(keys: DataFrame, key: str, size: int = BATCH_SIZE) -> DataFrame:
    """Batch number and offset of the first id of the batch, from the zero-based row key."""
    batch = F.floor(col(key) / size).cast("bigint")
    return keys.withColumns({"batch": batch, "id_offset": batch * size})


def read_specs(
    answers: DataFrame, answer_id: str, response: str = "response", expected: str = "expected_columns"
) -> DataFrame:
    """Specification rows (answer, dataset_name, ordinal, column, type) out of free text answers.

    An answer without a JSON object falls back to the expected columns of its request, all of them texts.
    """
    json = json_text.valid_json(json_text.object_span(col(response)))
    parsed = answers.select(
        col(answer_id), col(expected).alias("_expected"), json_text.parse_as(json, SPEC_SCHEMA).alias("spec")
    )
    columns = F.coalesce("spec.columns", "_expected")
    rows = parsed.select(
        answer_id,
        F.coalesce("spec.dataset_name", F.lit("SyntheticDataset")).alias("dataset_name"),
        F.col("spec.column_details").alias("_details"),
        F.posexplode(columns).alias("ordinal", "column"),
    )
    kind = F.when(F.col("_details").isNotNull(), F.try_element_at("_details", F.col("column"))["type"])
    return rows.select(
        answer_id, "dataset_name", "ordinal", "column", F.coalesce(kind, F.lit("string")).alias("type")
    )


def sample_value(name: Column, key: Column, seed: int, anchor: Column) -> Column:
    """Sample value, as text, for a column whose name is data: the first name part that fits decides."""
    lower = F.lower(name)
    d = F.md5(F.concat(F.lit(f"{seed}:"), name, F.lit(":"), key.cast("string")))
    n0, n1 = slot(d, 0), slot(d, 1)
    uuid = F.concat_ws(
        "-", F.substring(d, 1, 8), F.substring(d, 9, 4), F.substring(d, 13, 4), F.substring(d, 17, 4), F.substring(d, 21, 12)
    )
    first, last = pick(n0, FIRST_NAMES), pick(n1, LAST_NAMES)
    day = F.date_format(F.date_sub(anchor, F.pmod(n0, F.lit(DAYS_BACK + 1)).cast("int")), "yyyy-MM-dd")
    cents = F.pmod(n0, F.lit(100_000))
    amount = F.concat(F.floor(cents / 100).cast("bigint").cast("string"), F.lit("."), F.lpad(F.pmod(cents, F.lit(100)).cast("string"), 2, "0"))
    return (
        F.when(F.contains(lower, F.lit("id")), uuid)
        .when(F.contains(lower, F.lit("name")), F.concat_ws(" ", first, last))
        .when(F.contains(lower, F.lit("age")), between(n0, *AGE_RANGE).cast("string"))
        .when(F.contains(lower, F.lit("date")), day)
        .when(F.contains(lower, F.lit("email")), F.concat(F.lower(first), F.lit("."), F.lower(last), F.lit("@example.com")))
        .when(contains_any(lower, ["description", "text"]), F.concat(text_of(d, 6), F.lit(".")))
        .when(contains_any(lower, ["value", "amount"]), amount)
        .otherwise(pick(n0, WORDS))
    )


def sample_rows(
    descriptors: DataFrame, key: str, columns: str = "columns", n: int = 3, seed: int = 0, anchor: str | None = None
) -> DataFrame:
    """Adds sample_data: n maps of column name to sample value. Built on the row, without a shuffle."""
    day = anchor_date(anchor)
    rows = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda r: F.map_from_arrays(
            col(columns),
            F.transform(
                col(columns),
                lambda c: sample_value(c, F.concat_ws("/", col(key).cast("string"), r.cast("string")), seed, day),
            ),
        ),
    )
    empty = F.array().cast("array<map<string,string>>")
    return descriptors.withColumn("sample_data", F.when(F.size(columns) > 0, rows).otherwise(empty))


def constant_sample(name: Column, domain: Column) -> Column:
    """Constant sample value of a column name in a domain."""
    lower = F.lower(name)
    value = F.lit(OTHER_SAMPLE)
    for d, rules in CONSTANT_SAMPLES.items():
        chosen = F.lit(OTHER_SAMPLE)
        for words, sample in reversed(rules):
            chosen = F.when(contains_any(lower, words), F.lit(sample)).otherwise(chosen)
        value = F.when(domain == d, chosen).otherwise(value)
    return value


def constant_samples(descriptors: DataFrame, domain: str, columns: str = "columns") -> DataFrame:
    """Adds sample_data: one map of column name to the constant of its domain."""
    row = F.map_from_arrays(col(columns), F.transform(col(columns), lambda c: constant_sample(c, col(domain))))
    empty = F.array().cast("array<map<string,string>>")
    return descriptors.withColumn("sample_data", F.when(F.size(columns) > 0, F.array(row)).otherwise(empty))


def align_schema(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The wanted columns in order: absent ones hold Unknown, extra ones are dropped."""
    return df.select(*[(col(c) if c in df.columns else F.lit(ABSENT)).alias(c) for c in columns])


def parse_generated_rows(
    responses: DataFrame,
    batch: str,
    spec: Sequence[tuple[str, str]],
    response: str = "response",
    seed: int = 0,
    anchor: str | None = None,
    size: int = BATCH_SIZE,
) -> DataFrame:
    """Rows of all batches: parsed from the answers, generated by rule where an answer is not usable.

    Parsed and generated rows come out of one pass, as texts in the order of the specification. A column
    that no row of any batch has is Unknown, one that only some rows lack stays null there.
    """
    day = anchor_date(anchor)
    json = json_text.valid_json(json_text.array_span(col(response)))
    parsed = json_text.parse_as(json, "array<map<string,string>>")

    def by_rule(position: Column) -> Column:
        key = F.col("_batch") * size + position
        pairs = [F.lit(x) if i % 2 == 0 else x for n, k in spec for i, x in enumerate((n, cell(n, k, key, seed, day).cast("string")))]
        return F.create_map(*pairs)

    ruled = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), by_rule)
    rows = (
        computed_once(responses, [col(batch).cast("bigint").alias("_batch")], _parsed=parsed)
        .withColumn("_good", F.col("_parsed").isNotNull())
        .select("_batch", "_good", F.posexplode(F.when(F.col("_good"), F.col("_parsed")).otherwise(ruled)).alias("_pos", "_row"))
        .filter(F.col("_row").isNotNull())
    )
    seen = rows.agg(
        *[F.max(F.map_contains_key("_row", F.lit(n))).alias(f"seen_{i}") for i, (n, _) in enumerate(spec)]
    ).select(F.struct("*").alias("all"))
    return rows.withColumn("_seen", seen.scalar()).select(
        F.col("_batch").alias("batch"),
        F.col("_pos").alias("position"),
        F.when(F.col("_good"), "answer").otherwise("rule").alias("source"),
        *[
            F.when(F.col(f"_seen.seen_{i}"), F.try_element_at("_row", F.lit(n))).otherwise(F.lit(ABSENT)).alias(n)
            for i, (n, _) in enumerate(spec)
        ],
    )


def repeated_ids(df: DataFrame, column: str) -> DataFrame:
    """Ids that occur more than once, with their counts."""
    return df.groupBy(col(column).alias("id")).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
