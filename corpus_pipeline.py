"""The training-data pipeline over documents: toxic texts go, then near-duplicates and benchmark leaks, then sources
are mixed into a curriculum, and the result is written as token ids.

Each stage reads what its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.llm import decontaminate, minhash, mixing, tokens, toxicity
from rowsmith.sources.shared import new_path, stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject.

    Null, empty and wordless texts score like the median clean text and stay. Whole texts are read, however long. Equal rows
    score alike; rows without doc_id are scored like others. Other columns pass through. An empty table stays empty, and
    without labels of both classes nothing is rejected."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id: 5 words, similarity 0.8.

    Null, empty and wordless texts are like no other and stay; a shorter text is one shingle of all its words. Rows
    of one doc_id stay or go together; rows without doc_id stay. Other columns pass through."""
    return minhash.without_near_duplicates(docs, n=5, percent=80)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that aligns with a test item.

    Null and empty texts hold no passage and stay; null and empty items match nothing, repeated items match once. Whole texts are
    searched. Equal rows go or stay together. Other columns pass through; without items nothing goes."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as the mix takes it.

    Null and empty texts have size 0 and are taken as often as their place among the others says. A null source is a source like others, the last. Ties of position are settled by
    the hash of the id, so that other partitionings give the same order. Other columns pass through."""
    return mixing.curriculum(docs)


def in_written_order(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """The rows of docs as they lie in files, and columns that put them in the order they were written in: part
    number, file and row. A frame that is not read from files is written first, which keeps the order of its rows."""
    try:
        docs.select("_metadata.file_name", "_metadata.row_index")
    except AnalysisException:
        docs = stored(docs, "ordered")
    file = F.col("_metadata.file_name")
    return docs, [F.regexp_extract(file, r"^part-(\d+)", 1).try_cast("bigint"), file, F.col("_metadata.row_index")]


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): the documents as read back from the written token files, which hold them
    in the order of the rows of docs.

    A null or empty text is the end id alone. Repeated rows are written as often as they occur. Other columns do not matter. An empty table gives no rows."""
    path = new_path(spark, "tokens")
    rows, order = in_written_order(docs)
    tokens.write_tokens(rows, path, TOKENIZER, order=order)
    return tokens.read_tokens(spark, path, with_ids=False)


STAGES = [
    ("toxicity", toxic),
    ("near-duplicates", near_duplicates),
    ("decontamination", leaks),
    ("mixing", mixed),
    ("tokens", encoded),
]

#: Fitted classifiers, alignment and the tokenizer are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
