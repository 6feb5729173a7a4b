"""Tables in files: typed CSV reading, folders of tables, catalog, preview, writing."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.functions.columns import col, column_figures, columns_of

logger = logging.getLogger(__name__)

# Texts that stand for a missing value in a CSV file.
NULL_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Types are tried in this order; a column takes the first that all its values fit. Whole numbers beyond bigint keep
# all their digits as decimal(38,0). {v} is a text, and each test holds for the texts that do not fit.
WHOLE_NUMBER = r"^\\s*[+-]?[0-9]+\\s*$"
TYPE_TESTS = {
    "boolean": "NOT rlike({v}, '^(?i:true|false)$')",
    "bigint": f"NOT rlike({{v}}, '{WHOLE_NUMBER}') OR try_cast({{v}} AS bigint) IS NULL",
    "decimal(38,0)": f"NOT rlike({{v}}, '{WHOLE_NUMBER}') OR try_cast({{v}} AS decimal(38,0)) IS NULL",
    "double": r"NOT rlike({v}, '^\\s*[+-]?(([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\\s*$')",
    "date": "NOT rlike({v}, '^[0-9]{{4}}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$')",
    "timestamp_ntz": r"NOT rlike({v}, '^[0-9]{{4}}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])[ T][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}(\\.[0-9]+)?)?$')",
}


def read_texts(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header, all columns as text, null texts as null.

    Large files are split among tasks, so fields must not hold line breaks. With multi_line they may, and each file is
    read by one task.
    """
    raw = spark.read.csv(
        path, header=True, inferSchema=False, quote='"', escape='"', multiLine=multi_line, encoding="UTF-8"
    )
    return raw.select(*[F.when(~col(c).isin(NULL_TEXTS), col(c)).alias(c) for c in raw.columns])


def infer_types(texts: DataFrame) -> dict[str, str]:
    """Narrowest type per text column, from one scan for every few columns; one row per column reaches the driver.

    A column without any value is double.
    """
    misfits = {f"t{i}": f"count_if({{v}} IS NOT NULL AND ({test}))" for i, test in enumerate(TYPE_TESTS.values())}
    types = {}
    for row in column_figures(texts, texts.columns, {"filled": "count({v})"} | misfits, cost=2).collect():
        fits = [t for i, t in enumerate(TYPE_TESTS) if row[f"t{i}"] == 0]
        types[row["column"]] = "double" if row["filled"] == 0 else (fits[0] if fits else "string")
    return types


def read_table(
    spark: SparkSession, path: str, types: dict[str, str] | None = None, multi_line: bool = False
) -> DataFrame | None:
    """Typed table of a CSV file or folder; None, with a warning, when it does not exist.

    Types not given are inferred from all values. A value that does not fit its type becomes null.
    """
    try:
        texts = read_texts(spark, path, multi_line)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        logger.warning("no file at %s", path)
        return None
    open_columns = [c for c in texts.columns if c not in (types or {})]
    found = infer_types(texts.select(*[col(c) for c in open_columns])) if open_columns else {}
    chosen = {**found, **(types or {})}
    return texts.select(
        *[(col(c) if chosen[c] == "string" else F.trim(col(c)).try_cast(chosen[c])).alias(c) for c in texts.columns]
    )


def table_names(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[str]:
    """Names of the tables in a folder: files, or folders of part files, that end in the suffix.

    Only paths are read. The names that reach the driver are as many as there are tables.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        logger.warning("no folder at %s", folder)
        return []
    last = folder.rstrip("/").split("/")[-1]
    below = F.element_at(F.split("path", F.lit("/" + last.replace(".", r"\.") + "/")), -1)
    top = files.select(F.split(below, "/")[0].alias("top")).filter(F.endswith("top", F.lit(suffix))).distinct()
    return sorted(r["top"].removesuffix(suffix) for r in top.collect())


def load_tables(spark: SparkSession, folder: str, multi_line: bool = False) -> dict[str, DataFrame]:
    """All CSV tables of a folder by name; empty and unreadable ones are skipped."""
    tables = {}
    for name in table_names(spark, folder):
        try:
            df = read_table(spark, f"{folder}/{name}.csv", multi_line=multi_line)
            if df is not None and not df.isEmpty():
                tables[name] = df
        except Exception as e:  # a bad file must not stop the others
            logger.error("could not load %s: %s", name, e)
    return tables


def write_table(df: DataFrame, path: str, file_format: str = "csv", mode: str = "errorifexists", multi_line: bool = False) -> None:
    """CSV with a header, or parquet, that read_table reads back unchanged.

    A text with a line break would become two rows of a CSV file that is read in parts: writing it fails, unless `multi_line`
    says that the file will be read with that option."""
    if file_format == "csv":
        broken = F.raise_error(F.lit("a text has a line break: write and read with multi_line, or write parquet"))
        texts = [] if multi_line else columns_of(df, "text")
        safe = [F.when(F.contains(col(c), F.lit("\n")) | F.contains(col(c), F.lit("\r")), broken).otherwise(col(c)).alias(c) if c in texts else col(c) for c in df.columns]
        df.select(*safe).write.mode(mode).csv(
            path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    else:
        df.write.mode(mode).format(file_format).save(path)


def catalog_row(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns and size in KB of a table read from files.

    Rows are counted per file, without reading any column where the format allows it.
    """
    files = df.groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("n"))
    return files.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        (F.coalesce(F.sum("file_size"), F.lit(0)) / 1024.0).alias("size_kb"),
    ).select(F.lit(name).alias("dataset_name"), "row_count", F.lit(len(df.columns)).cast("bigint").alias("column_count"), "size_kb")


def preview(df: DataFrame, n: int, order_by: str) -> DataFrame:
    """First n rows in key order. Rows of files have no order of their own."""
    ties = [col(c) for c in df.columns if c != order_by and c not in columns_of(df, "other")]
    return df.orderBy(col(order_by), *ties).limit(n)
