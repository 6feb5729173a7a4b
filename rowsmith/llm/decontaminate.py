"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm import words
from rowsmith.sources.shared import stored

#: ASCII letters and digits, and every character beyond ASCII, make words.
LETTERED = words.alphabet(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
#: Item n-grams held by a task at a time; a larger benchmark is searched in several such blocks.
HELD = 1 << 20
MATCH, MISMATCH, GAP = 2, -1, 1
FILTER_BITS = 22
#: Cells of an alignment row over all pairs that are aligned together.
CELLS = 1 << 16
_PLACES = 1 << 24


@dataclass
class Items:
    """A block of test items: words of all items, where each item's begin, and the n-grams to look for."""

    item_id: np.ndarray
    words: np.ndarray
    before: np.ndarray
    grams: np.ndarray
    item: np.ndarray
    place: np.ndarray

    def __post_init__(self):
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.grams & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in grams that the block has, and the index of each one's first entry in the block."""
        at = np.flatnonzero(self.filter[(grams & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
        if not len(self.grams) or not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = np.searchsorted(self.grams, grams[at])
        same = self.grams[np.minimum(first, len(self.grams) - 1)] == grams[at]
        return at[same], first[same]


def blocks(items: DataFrame, n: int) -> Iterator[Items]:
    """The distinct test items, in as many parts as it takes to hold about HELD n-grams at a time."""
    texts = items.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    texts = stored(texts.distinct(), "items")
    size = texts.agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) / 4 + 1)).first()[0] or 0
    parts = -int(-size // HELD)
    for part in range(parts):
        table = texts.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").toArrow()
        data, offsets = words.texts_of(table.column("text").combine_chunks())
        hashes, before = words.word_hashes(data, offsets, LETTERED)
        grams, starts, rows = runs(hashes, before, n)
        order = np.lexsort((starts, rows, grams))
        yield Items(table.column("item_id").to_numpy(), hashes, before, grams[order], rows[order], (starts - before[rows])[order])


def runs(hashes: np.ndarray, before: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of n words of each row: hash, first word, row. Rows of fewer words have none."""
    row = np.repeat(np.arange(len(before) - 1), np.diff(before))
    start = np.arange(max(len(hashes) - n + 1, 0))
    start = start[row[start] == row[start + n - 1]] if len(start) else start
    total = np.zeros(len(start), np.uint64)
    for i in range(n):
        total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[start + i]
    return words.mix(total), start, row[start]


def align(items: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smith-Waterman over many pairs at once: best score, and first and last word of the text's part.

    items: pairs x words, padded with 0; texts: pairs x words, padded with 1. A cell holds the score and, below it,
    where its alignment begins, so the larger of two cells has the higher score and then the earlier beginning.
    """
    pairs, width = texts.shape
    column = np.arange(width, dtype=np.int64)
    fresh = np.broadcast_to(_PLACES - 1 - column, (pairs, width))
    slope = column * (GAP * _PLACES)
    above = np.broadcast_to(fresh, (pairs, width)).copy()
    best = np.zeros(pairs, np.int64)
    last = np.zeros(pairs, np.int64)
    for i in range(items.shape[1]):
        step = np.where(items[:, i : i + 1] == texts, MATCH * _PLACES, MISMATCH * _PLACES)
        corner = np.concatenate([fresh[:, :1], np.where(above[:, :-1] >= _PLACES, above[:, :-1], fresh[:, 1:])], axis=1)
        row = np.maximum(np.maximum(corner + step, above - GAP * _PLACES), fresh)
        row = np.maximum.accumulate(row + slope, axis=1) - slope
        above = np.maximum(row, fresh)
        at = above.argmax(axis=1)
        top = above[np.arange(pairs), at]
        better = top // _PLACES > best // _PLACES
        best, last = np.where(better, top, best), np.where(better, at, last)
    return best // _PLACES, _PLACES - 1 - best % _PLACES, last


def shared_words(items: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """How many words of each item its text has anywhere: an alignment matches no more. Padded as for align()."""
    total = np.zeros(len(items), np.int64)
    for i in range(items.shape[1]):
        total += (items[:, i : i + 1] == texts).any(axis=1)
    return total


def windows(item: np.ndarray, doc: np.ndarray, shift: np.ndarray, length: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Stretches of text to align, from seeds: overlapping stretches of the same document and item are merged.

    shift: the text word where the item's first word would lie; low and high: the document's words.
    """
    spare = length // 4 + 4
    begin, end = np.maximum(shift - spare, low), np.minimum(shift + length + spare, high)
    order = np.lexsort((begin, item, doc))
    item, doc, begin, end = item[order], doc[order], begin[order], end[order]
    head = np.ones(len(item), bool)
    head[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1])
    apart = np.cumsum(head) * (int(high.max()) + 1)
    head[1:] |= (begin + apart)[1:] > np.maximum.accumulate(end + apart)[:-1]
    first = np.flatnonzero(head)
    return item[first], doc[first], begin[first], np.maximum.reduceat(end, first), np.diff(np.append(first, len(item)))


def matches(batch: pa.RecordBatch, items: Items, n: int, least: float):
    """(row, item, score, seeds, first word, last word) of the batch's texts that align with an item."""
    hashes, before = words.word_hashes(*words.texts_of(batch.column(batch.schema.get_field_index("text"))), LETTERED)
    grams, starts, rows = runs(hashes, before, n)
    at, entry = items.hits(grams)
    many = np.searchsorted(items.grams, grams[at], side="right") - entry
    which = np.repeat(np.arange(len(at)), many)
    entry = np.repeat(entry, many) + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
    if not len(which):
        return [np.zeros(0, t) for t in (np.int64, np.int64, float, np.int64, np.int64, np.int64)]
    row, item = rows[at][which], items.item[entry]
    length = np.diff(items.before)[item]
    found = windows(item, row, starts[at][which] - items.place[entry], length, before[row], before[row + 1])
    item, row, begin, end, seeds = found
    length, width = np.diff(items.before)[item], end - begin
    out = np.zeros((len(item), 3), np.int64)
    order = np.argsort(width, kind="stable")
    ascending = width[order]
    at = 0
    while at < len(order):
        alike = np.searchsorted(ascending, 2 * ascending[at] + 32, side="right")
        some = order[at : min(alike, at + max(1, CELLS // int(2 * ascending[at] + 32)))]
        wide, long = int(width[some].max()), int(length[some].max())
        a = np.where(np.arange(long) < length[some][:, None], hashes_at(items.words, items.before[item[some]], long), 0)
        b = np.where(np.arange(wide) < width[some][:, None], hashes_at(hashes, begin[some], wide), 1)
        able = shared_words(a, b) >= least * length[some]
        if able.any():
            out[some[able]] = np.stack(align(a[able], b[able]), axis=1)
        at += len(some)
    score = out[:, 0] / (MATCH * length)
    good = score >= least
    place = begin - before[row]
    return [x[good] for x in (row, item, score, seeds, place + out[:, 1], place + out[:, 2])]


def hashes_at(hashes: np.ndarray, begin: np.ndarray, width: int) -> np.ndarray:
    return hashes[np.minimum(begin[:, None] + np.arange(width), len(hashes) - 1)]


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 3, least: float = 0.5) -> DataFrame:
    """(doc_id, item_id, score, seeds, first_word, last_word): the best aligned passage for each text and item whose
    score, as a part of the score of a whole and exact copy, is at least `least`. Words are numbered from 0.

    A match adds 2, a word changed, added or left out costs 1. Every n-gram of an item is a seed, however
    often it occurs: texts that share one with an item are aligned, over the stretches that the n-grams point to.
    Stretches that have too few of the item's words for the score, in any order, are not. Items are held by the tasks in blocks of bounded
    size, and all documents are read for each block, so neither side is shuffled and frequent passages stay where
    they are.

    Null and empty texts, and items of fewer than n words or without item_id, match nothing. Rows with a null doc_id
    are reported with it. Equal doc_ids or item_ids are reported for each row. Other columns do not matter.
    """
    schema = "doc_id bigint, item_id bigint, score double, seeds bigint, first_word bigint, last_word bigint"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = ["doc_id", "item_id", "score", "seeds", "first_word", "last_word"]
    found = []
    for block in blocks(benchmark, n):

        def task(batches: Iterator[pa.RecordBatch], items=block) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in words.slices(whole):
                    row, item, *figures = matches(batch, items, n, least)
                    best = np.lexsort((figures[2], -figures[0], item, row))
                    best = best[np.unique(row[best] * len(items.item_id) + item[best], return_index=True)[1]]
                    ids = [batch.column("doc_id").take(pa.array(row[best])), pa.array(items.item_id[item[best]])]
                    yield pa.RecordBatch.from_arrays([*ids, *(pa.array(x[best]) for x in figures)], names)

        found.append(rows.mapInArrow(task, schema))
    out = found[0] if found else docs.sparkSession.createDataFrame([], schema)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, n: int = 3, least: float = 0.5) -> DataFrame:
    """The rows of docs, with all their columns, that contaminated() would not report."""
    for block in blocks(benchmark, n):

        def task(batches: Iterator[pa.RecordBatch], items=block) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in words.slices(whole):
                    keep = np.ones(batch.num_rows, bool)
                    keep[matches(batch, items, n, least)[0]] = False
                    yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(task, docs.schema)
    return docs
