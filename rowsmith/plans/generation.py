"""Generation run: from answers that hold specifications to many written tables, their manifest and their check.

All tables come out of one job over (specification, range of row keys): columns, types, ranges and sizes are data, so the plan
does not grow with the number of tables, and a table of any size is spread over as many tasks as it has ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.functions import json_text
from rowsmith.functions.columns import col, computed_once, contains_any
from rowsmith.functions.hashing import pick, slot
from rowsmith.operators import generate as rules

SPEC_SCHEMA = (
    "struct<dataset_name:string, description:string, columns:array<string>,"
    " column_details:map<string,struct<type:string, value_range:string>>, row_count:double>"
)
#: Rows of a table whose specification names no number, and rows that one task makes of a table at a time.
ROWS, RANGE = 50, 100_000
#: Two numbers with a dash, a comma, dots or a word between them.
NUMBERS = r"(-?[0-9]+(?:\.[0-9]+)?)\s*(?:-|,|\.\.|to|and)\s*(-?[0-9]+(?:\.[0-9]+)?)"
WRITTEN = "row_no bigint, row map<string,string>, dataset string"


def specifications(answers: DataFrame, answer_id: str, response: str = "response", expected: str = "expected_columns") -> DataFrame:
    """One row per answer: answer id, dataset, name, description, row_count, and fields: an array of (column, type, low, high,
    choices).

    The first two numbers of a value range are its ends, whatever their order; a range without two numbers that names
    several values, parted by commas, lists the choices of a categorical column. Repeated columns count once. An answer without a JSON
    object falls back to the expected columns of its request, all of them texts, and ROWS rows. A negative size is 0."""
    json = json_text.valid_json(json_text.object_span(col(response)))
    parsed = computed_once(answers, [col(answer_id), col(expected).alias("_expected")], spec=json_text.parse_as(json, SPEC_SCHEMA))
    names = F.array_distinct(F.filter(F.coalesce("spec.columns", "_expected"), lambda c: c.isNotNull()))

    def field(name: Column) -> Column:
        details = F.try_element_at("spec.column_details", name)
        span = details["value_range"]
        ends = [F.regexp_extract(span, NUMBERS, i).try_cast("double") for i in (1, 2)]
        listed = F.transform(F.split(span, ","), lambda v: F.trim(F.translate(v, '"[]', "")))
        choices = F.when(ends[0].isNull() & F.contains(span, F.lit(",")), listed)
        return F.struct(
            name.alias("column"),
            F.coalesce(details["type"], F.lit("string")).alias("type"),
            F.least(*ends).alias("low"),
            F.greatest(*ends).alias("high"),
            choices.alias("choices"),
        )

    name = F.coalesce("spec.dataset_name", F.lit("SyntheticDataset"))
    size = F.greatest(F.coalesce(F.floor("spec.row_count"), F.lit(ROWS)), F.lit(0)).cast("bigint")
    return parsed.select(
        answer_id,
        F.concat_ws("-", col(answer_id).cast("string"), name).alias("dataset"),
        name.alias("name"),
        F.coalesce("spec.description", F.lit("")).alias("description"),
        size.alias("row_count"),
        F.transform(names, field).alias("fields"),
    )


def value_of(field: Column, dataset: Column, key: Column, seed: int, anchor: Column) -> Column:
    """Value, as text, of a column whose name, type and range are data. The rules are those of `generate.cell`; a range
    replaces the rule's own."""
    name, kind = F.lower(field["column"]), field["type"]
    digest = F.md5(F.concat(F.lit(f"{seed}:"), dataset, F.lit("/"), field["column"], F.lit(":"), key.cast("string")))
    number = slot(digest)
    ranged = field["low"].isNotNull()

    def whole(low: int, high: int) -> Column:
        first, last = F.when(ranged, F.ceil(field["low"])).otherwise(low), F.when(ranged, F.floor(field["high"])).otherwise(high)
        return (first + number % (F.greatest(last - first, F.lit(0)) + 1)).cast("bigint").cast("string")

    cents = [F.when(ranged, F.round(field[end] * 100)).otherwise(other).cast("bigint") for end, other in (("low", 0), ("high", 10_000))]
    amount = cents[0] + number % (cents[1] - cents[0] + 1)
    places = F.concat(F.floor(F.abs(amount) / 100).cast("string"), F.lit("."), F.lpad((F.abs(amount) % 100).cast("string"), 2, "0"))
    day = F.date_format(F.date_sub(anchor, (number % (rules.DAYS_BACK + 1)).cast("int")), "yyyy-MM-dd")
    form = F.when(contains_any(name, rules.PERSON_WORDS), rules.PERSON_FORMAT[:4]).otherwise(rules.ID_FORMAT[:3])
    serial = (key + 1).cast("string")
    chosen = F.try_element_at(field["choices"], (number % F.size(field["choices"]) + 1).cast("int"))
    category = (
        F.when(F.size(field["choices"]) > 0, chosen)
        .when(contains_any(name, rules.SEX_WORDS), pick(number, rules.SEX_VALUES))
        .when(contains_any(name, rules.ORIGIN_WORDS), pick(number, rules.ORIGIN_VALUES))
        .when(contains_any(name, rules.FREQUENCY_WORDS), pick(number, rules.FREQUENCY_VALUES))
        .otherwise(pick(number, rules.OTHER_VALUES))
    )
    integer = (
        F.when(contains_any(name, rules.AGE_WORDS), whole(*rules.AGE_RANGE))
        .when(contains_any(name, rules.YEAR_WORDS), whole(*rules.YEAR_RANGE))
        .otherwise(whole(*rules.INT_RANGE))
    )
    return (
        F.when(is_id(field), F.concat(form, F.lpad(serial, F.greatest(F.length(serial), F.lit(6)), F.lit("0"))))
        .when((kind == "int") | contains_any(name, rules.AGE_WORDS + rules.YEAR_WORDS), integer)
        .when((kind == "float") | contains_any(name, rules.METRIC_WORDS), F.concat(F.when(amount < 0, "-").otherwise(""), places))
        .when(kind == "date", day)
        .when(kind == "boolean", (number % 2 == 0).cast("string"))
        .when(kind == "categorical", category)
        .otherwise(F.substring(rules.text_of(digest), 1, rules.TEXT_LENGTH))
    )


def is_id(field: Column) -> Column:
    return (field["type"] == "id") | contains_any(F.lower(field["column"]), rules.ID_WORDS)


def generated(specs: DataFrame, seed: int = 0, anchor: str | None = None) -> DataFrame:
    """(dataset, row_no, row): all rows of all specifications, a row as a map of column to text.

    Ranges of RANGE keys are dealt over tasks, so a table with most of the rows is made by many of them."""
    day = rules.anchor_date(anchor)
    ranges = specs.filter("row_count > 0").select("dataset", "fields", "row_count", F.explode(F.sequence(F.lit(0), F.floor((F.col("row_count") - 1) / RANGE))).alias("part"))
    ranges = ranges.repartition("dataset", "part")
    last = F.least((F.col("part") + 1) * RANGE, F.col("row_count")) - 1
    rows = ranges.select("dataset", "fields", F.explode(F.sequence(F.col("part") * RANGE, last)).alias("row_no"))
    entry = lambda f: F.struct(f["column"], value_of(f, F.col("dataset"), F.col("row_no"), seed, day))
    return rows.select("dataset", "row_no", F.map_from_entries(F.transform("fields", entry)).alias("row"))


def write_run(rows: DataFrame, path: str) -> None:
    """The rows as JSON lines, a folder for each dataset."""
    rows.write.partitionBy("dataset").json(path)


def read_run(spark: SparkSession, path: str) -> DataFrame:
    """(dataset, row_no, row): the rows of a written run."""
    return spark.read.schema(WRITTEN).json(path)


def aligned(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(dataset, row_no, position, column, value): the cells of rows in the order of the wanted columns, wanted:
    (dataset, columns). A column that no row of its dataset has is Unknown, one that only some lack stays null there,
    others are dropped."""
    seen = rows.select("dataset", F.explode(F.map_keys("row")).alias("column")).distinct().groupBy("dataset").agg(F.collect_set("column").alias("seen"))
    asked = wanted.join(seen, "dataset", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    cells = rows.join(asked, "dataset").select("dataset", "row_no", "row", "seen", F.posexplode("columns").alias("position", "column"))
    value = F.when(F.array_contains("seen", F.col("column")), F.try_element_at("row", F.col("column"))).otherwise(rules.ABSENT)
    return cells.select("dataset", "row_no", "position", "column", value.alias("value"))


def manifest(specs: DataFrame, rows: DataFrame, path: str) -> DataFrame:
    """(name, description, columns, file_path, row_count, asked_rows, repeated_ids): what a run has written for each
    specification, counted in its files, and how many ids of id columns occur more than once."""
    counts = rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("row_count"))
    ids = specs.select("dataset", F.explode(F.filter("fields", is_id)).alias("f")).select("dataset", "f.column")
    cells = rows.select("dataset", F.explode("row").alias("column", "value")).join(ids, ["dataset", "column"])
    repeated = cells.groupBy("dataset", "column", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = repeated.groupBy("dataset").agg(F.count(F.lit(1)).alias("repeated_ids"))
    found = specs.withColumnRenamed("row_count", "asked_rows").join(counts, "dataset", "left").join(repeated, "dataset", "left")
    return found.na.fill(0, ["row_count", "repeated_ids"]).select(
        "name",
        "description",
        F.col("fields.column").alias("columns"),
        F.concat(F.lit(path.rstrip("/") + "/dataset="), "dataset").alias("file_path"),
        "row_count",
        "asked_rows",
        "repeated_ids",
    )


def generation_run(answers: DataFrame, answer_id: str, path: str, seed: int = 0, anchor: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(specifications, rows as read back from the files, manifest) of a run written at path."""
    specs = specifications(answers, answer_id)
    write_run(generated(specs, seed, anchor), path)
    rows = read_run(answers.sparkSession, path)
    return specs, rows, manifest(specs, rows, path)
