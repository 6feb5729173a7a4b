"""Substring dedup: runs of consecutive sentences that occur before are removed from later texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm import words
from rowsmith.sources.shared import stored

RUN = 2
LEAST = 10
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?")] = True


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[words.Words, np.ndarray, np.ndarray]:
    """Words of the rows, the first word of each sentence (and the number of words), sentences before each row.

    A sentence ends after a word that ends in . ! or ?, before a line break, and with its text."""
    table = words.word_table(data, offsets)
    begins = np.zeros(len(table.hashes) + 1, bool)
    begins[table.before] = True
    begins[1:][_ENDS[data[table.stops - 1]]] = True
    lines = np.flatnonzero(data[offsets[0] : offsets[-1]] == 10) + offsets[0]
    begins[np.searchsorted(table.starts, lines)] = True
    begins[-1] = True
    first = np.flatnonzero(begins)
    return table, first, np.searchsorted(first, table.before)


def run_hashes(table: words.Words, first: np.ndarray, before: np.ndarray, run: int, least: int, extend: bool) -> tuple[np.ndarray, ...]:
    """(hash, row, sentence, sentences) of the runs of a row: from each sentence on, and up to each sentence, as many
    consecutive sentences as it takes to have `least` words, `run` at least. Unless extend, only those of just `run`."""
    row = np.repeat(np.arange(len(before) - 1), np.diff(before))
    at = np.arange(len(row))
    stop = np.maximum(np.searchsorted(first, first[at] + least), at + run)
    begin = np.minimum(np.searchsorted(first, first[at + 1] - least, side="right") - 1, at + 1 - run)
    onward, back = stop <= before[row + 1], begin >= before[row]
    pairs = np.concatenate([np.stack([at, stop], axis=1)[onward], np.stack([begin, at + 1], axis=1)[back]])
    start, stop = np.unique(pairs if extend else pairs[pairs[:, 1] - pairs[:, 0] == run], axis=0).T
    length = len(table.hashes) + 1
    base = words.BASE
    summed = np.concatenate([[np.uint64(0)], np.cumsum(table.hashes * words.powers(base, max(length, words.WINDOW + 1))[: len(table.hashes)])])
    inverse = words.powers(pow(base, -1, 1 << 64), max(length, words.WINDOW + 1))
    begin, end = first[start], first[stop]
    hashes = words.mix((summed[end] - summed[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    return hashes, row[start], start - before[row[start]], stop - start


def repeated(docs: DataFrame, run: int = RUN, least: int = LEAST, extend: bool = True) -> DataFrame:
    """(doc_id, removed): the sentences, numbered from 0, that a repeated run other than the run's first covers.

    The first run is that of the smallest doc_id, and in it the earliest. Runs meet by a 64-bit hash of their
    lower-cased words. How often a run occurs and where first is aggregated before it is shuffled, so a passage that
    a third of all texts have is one row per task; the runs then join with the repeated ones only, which adaptive
    execution splits where one run has many places.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in words.slices(whole):
                table, first, before = sentences(*words.texts_of(batch.column("text")))
                hashes, row, place, many = run_hashes(table, first, before, run, least, extend)
                ids = batch.column("doc_id").to_numpy(zero_copy_only=False)[row]
                columns = [pa.array(hashes.view(np.int64)), pa.array(ids), pa.array(place), pa.array(many)]
                yield pa.RecordBatch.from_arrays(columns, ["run", "doc_id", "place", "sentences"])

    rows = docs.filter(F.col("doc_id").isNotNull())
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    runs = rows.mapInArrow(task, "run bigint, doc_id bigint, place bigint, sentences bigint")
    many = runs.groupBy("run").agg(F.count(F.lit(1)).alias("times"), F.min("doc_id").alias("first_doc")).filter("times > 1")
    found = stored(runs.join(many.select("run", "first_doc"), "run"), "runs")
    own = found.filter("doc_id = first_doc").groupBy("run").agg(F.min("place").alias("first_place"))
    later = found.join(own, "run").filter("doc_id != first_doc or place != first_place")
    covered = later.select("doc_id", F.explode(F.sequence("place", F.col("place") + F.col("sentences") - 1)).alias("sentence")).distinct()
    return covered.groupBy("doc_id").agg(F.sort_array(F.collect_list("sentence")).alias("removed"))


def without_repeats(docs: DataFrame, run: int = RUN, least: int = LEAST, extend: bool = True) -> DataFrame:
    """(doc_id, n_sentences, n_removed, text), one row per input row; text is what is left of it.

    Sentences end after . ! ?, at line breaks and with the text. From each sentence on and
    up to each sentence, the run of as many sentences as have `least` words, `run` at least, is looked up in the whole
    table, so every sentence of a repeated stretch of that length or any greater one is covered. Unless `extend`, only
    runs of just `run` sentences are, and repeated passages of shorter sentences stay.
    Kept sentences keep the white space after them.

    Null texts stay null and empty ones empty, without sentences. Rows without doc_id are returned as they are and
    are no one's first. Rows that share a doc_id are read as one document each, numbered from 0: of equal rows the
    runs repeat within the id, so the sentences after the first place go from all of them. Other columns do not
    matter. Empty tables give no rows.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in words.slices(whole):
                data, offsets = words.texts_of(batch.column("text"))
                table, first, before = sentences(data, offsets)
                starts = np.append(table.starts, offsets[-1])[first]
                texts, gone = batch.column("text").to_pylist(), []
                for r, removed in enumerate(batch.column("removed").to_pylist()):
                    many = int(before[r + 1] - before[r])
                    drop = [i for i in removed or [] if i < many]
                    gone.append(len(drop))
                    if drop:
                        edges = [*starts[before[r] : before[r + 1]].tolist(), int(offsets[r + 1])]
                        out = set(drop)
                        kept = [data[edges[i] : edges[i + 1]].tobytes() for i in range(many) if i not in out]
                        texts[r] = (data[offsets[r] : edges[0]].tobytes() + b"".join(kept)).decode()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.diff(before)), pa.array(gone, pa.int64()), pa.array(texts, pa.string())],
                    ["doc_id", "n_sentences", "n_removed", "text"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = rows.join(repeated(docs, run, least, extend), "doc_id", "left").select("doc_id", "text", "removed")
    return joined.mapInArrow(task, "doc_id bigint, n_sentences bigint, n_removed bigint, text string")
