"""Spelling variants: words that differ by one letter, found by probing generated edits against Bloom filters.

Every word's deletions, and its substitutions by later letters, are hashed without being spelled out and probed against
filters of the vocabulary, one shard for each word length. So each pair of near words is proposed once: by the longer
word's deletion, or by the substitution of the smaller letter. Only positives shuffle, as 64-bit keys, to two joins
with the vocabulary; the edit is then spelled out and compared, which removes false positives and equal keys.

The filters are broadcast. A round of probing holds at most FILTER_BYTES of them, whatever the size of the vocabulary: a larger
one is probed in several rounds, each with the filters of a part of the keys, and no word is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.llm.words import mix, powers
from rowsmith.sources.shared import stored

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of a filter for each word, words of 64 bits in a block, bytes of filters held at a time, shards by length.
BITS, LANES, FILTER_BYTES, SHARDS = 24, 4, 1 << 25, 64
#: Letters of words laid out at a time.
SLICE = 1 << 19
BASE = 0x9E3779B97F4A7C15
INVERSE = np.uint64(pow(BASE, -1, 1 << 64))


def runs(docs: DataFrame) -> DataFrame:
    """(doc_id, run): the maximal runs of Latin letters of whole texts, A-Z read as a-z, in any order. Null and empty
    texts have none."""
    each = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    plain = F.octet_length("run") == F.char_length("run")
    return each.select("doc_id", F.when(plain, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))


def keys_of(words: list[str]) -> np.ndarray:
    """The polynomial in BASE of the code points of each word, lowest power first, modulo 2^64."""
    out = np.zeros(len(words), np.uint64)
    for rows, codes in laid_out(words):
        out[rows] = (codes * powers(BASE, codes.shape[1])).sum(axis=1, dtype=np.uint64)
    return out


def laid_out(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length at a time: their numbers and a matrix of their code points."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths[lengths > 0]):
        same = np.flatnonzero(lengths == length)
        step = max(1, SLICE // int(length))
        for at in range(0, len(same), step):
            rows = same[at : at + step]
            codes = np.frombuffer("".join([words[i] for i in rows]).encode("utf-32-le"), "<u4")
            yield rows, codes.reshape(len(rows), length).astype(np.uint64)


def vocabulary(words: DataFrame, least_length: int, least_count: int) -> DataFrame:
    """(word, n, length, key): the different words of at least that many code points and occurrences."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("key", pa.array(keys_of(batch.column("word").to_pylist()).view(np.int64)))

    counts = words.filter(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.filter(F.col("n") >= least_count).withColumn("length", F.char_length("word"))
    return stored(counts.mapInArrow(keyed, "word string, n bigint, length int, key bigint"), "vocabulary")


class Filters:
    """Where the blocks of each shard lie, and which bits a key has."""

    def __init__(self, sizes: dict[int, int], most: int = FILTER_BYTES):
        """sizes: words of each shard."""
        self.rounds = min(256, max(1, -(-sum(sizes.values()) * BITS // (8 * most))))
        self.blocks = np.zeros(SHARDS + 1, np.uint64)
        for shard, words in sizes.items():
            self.blocks[shard] = -(-words * BITS // (64 * LANES * self.rounds))
        self.first = np.cumsum(self.blocks) - self.blocks
        self.bits = np.zeros((0, LANES), np.uint64)

    def places(self, keys: np.ndarray, shards: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Round, block and bit in each of the block's words."""
        x = mix(keys)
        block = self.first[shards] + ((x >> np.uint64(32)) * self.blocks[shards] >> np.uint64(32))
        part = (x >> np.uint64(24) & np.uint64(255)) % np.uint64(self.rounds)
        return part, block.astype(np.int64), [x >> np.uint64(6 * lane) & np.uint64(63) for lane in range(LANES)]

    def hits(self, keys: np.ndarray, shard: int, turn: int) -> np.ndarray:
        """Numbers of the keys that the shard may hold."""
        if not self.blocks[shard]:
            return np.zeros(0, np.int64)
        part, block, bits = self.places(keys, np.full(1, shard))
        left = np.flatnonzero(part == turn) if self.rounds > 1 else np.arange(len(keys))
        for lane in range(LANES):
            left = left[(self.bits[block[left], lane] >> bits[lane][left] & np.uint64(1)).astype(bool)]
        return left


def filled(words: DataFrame, plan: Filters, turn: int) -> np.ndarray:
    """The filters of a round: bits of words merged by block, at most FILTER_BYTES of them brought to the driver."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            part, block, bits = plan.places(keys, np.minimum(batch.column("length").to_numpy(zero_copy_only=False), SHARDS))
            mine = part == turn
            lanes = [pa.array((np.uint64(1) << b[mine]).view(np.int64)) for b in bits]
            yield pa.RecordBatch.from_arrays([pa.array(block[mine]), *lanes], names)

    names = ["block", *[f"lane{i}" for i in range(LANES)]]
    rows = words.select("key", "length").mapInArrow(task, ", ".join(f"{n} bigint" for n in names))
    merged = rows.groupBy("block").agg(*[F.bit_or(n).alias(n) for n in names[1:]]).toArrow()
    out = np.zeros((int(plan.blocks.sum()), LANES), np.uint64)
    for i, name in enumerate(names[1:]):
        out[merged["block"].to_numpy(), i] = merged[name].to_numpy().view(np.uint64)
    return out


def positives(words: DataFrame, plan: Filters, turn: int, letters: np.ndarray) -> DataFrame:
    """(length, key, at, letter, edit, edit_length): edits of the words that pass the filters: the letter at a place
    (from 0) replaced, or left out where `letter` is empty."""
    filters = words.sparkSession.sparkContext.broadcast(filled(words, plan, turn))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan.bits = filters.value
        for batch in batches:
            for _, codes in laid_out(batch.column("word").to_pylist()):
                found = list(edits(codes))
                if found:
                    row, at, letter, edit, size = (np.concatenate(part) for part in zip(*found, strict=True))
                    key = (codes * powers(BASE, codes.shape[1])).sum(axis=1, dtype=np.uint64)[row]
                    spelled = pa.array([chr(c) if c else "" for c in letter], pa.string())
                    same = pa.array(np.full(len(row), codes.shape[1], np.int32))
                    columns = [same, pa.array(key.view(np.int64)), pa.array(at.astype(np.int32)), spelled, pa.array(edit.view(np.int64)), pa.array(size)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    def edits(codes: np.ndarray):
        count, length = codes.shape
        power = powers(BASE, length)
        terms = codes * power
        upto = np.cumsum(terms, axis=1, dtype=np.uint64)
        whole = upto[:, -1:]

        def passing(keys: np.ndarray, valid: np.ndarray, letter: int, size: int):
            flat = np.flatnonzero(valid.ravel())
            edit = keys.ravel()[flat]
            hit = plan.hits(edit, min(size, SHARDS), turn)
            row, at = np.divmod(flat[hit], length)
            return row, at, np.full(len(hit), letter, np.int64), edit[hit], np.full(len(hit), size, np.int32)

        runs_ = np.ones(codes.shape, bool)
        runs_[:, 1:] = codes[:, 1:] != codes[:, :-1]
        yield passing((upto - terms) + (whole - upto) * INVERSE, runs_, 0, length - 1)
        for letter in letters:
            yield passing(whole + (letter - codes) * power, codes < letter, int(letter), length)

    names = ["length", "key", "at", "letter", "edit", "edit_length"]
    schema = "length int, key bigint, at int, letter string, edit bigint, edit_length int"
    return stored(words.select("word").mapInArrow(task, schema), "edits")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every two words of a vocabulary that differ by one inserted, deleted or replaced code
    point, both ways round."""
    shard = F.least("length", F.lit(SHARDS))
    plan = Filters({r.shard: r.n for r in words.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()})
    used = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct()
    letters = np.array(sorted(ord(r.letter) for r in used.collect()), np.uint64)
    found = None
    for turn in range(plan.rounds):
        part = positives(words, plan, turn, letters)
        found = part if found is None else found.unionByName(part)
    target = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("length").alias("edit_length"), F.col("key").alias("edit"))
    pairs = found.join(target, ["edit_length", "edit"]).join(words, ["length", "key"])
    spelled = F.concat(F.expr("substring(word, 1, at)"), "letter", F.expr("substring(word, at + 2)"))
    pairs = stored(pairs.filter(spelled == F.col("near")).select("word", "n", "near", "near_n"), "near")
    return pairs.unionByName(pairs.selectExpr("near AS word", "near_n AS n", "word AS near", "n AS near_n"))


def followed(links: DataFrame) -> DataFrame:
    """(word, root): where links (word, root), at most one for each word and in no circle, lead to in the end. Each
    round doubles the length of the known ways."""
    links = stored(links, "ways")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = stored(links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.isnotnull("further").alias("went")), "ways")
        if longer.filter("went").isEmpty():
            return longer.drop("went")
        links = longer.drop("went")


def variants(words: DataFrame, least_length: int = 5, least_count: int = 3, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the different words of a table (word) of occurrences.

    form is the near word with the most occurrences (ties: the first in code point order) if it has at least `ratio` (2 or more) times as
    many, else null; root is the end of the way from form to form, the word itself if it has none. Null and shorter words,
    and those with fewer occurrences, take no part. An empty table gives no rows. Repeated rows are occurrences."""
    known = vocabulary(words, least_length, least_count)
    best = near_words(known).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    near = known.select("word", "n").join(best, "word", "left")
    more = F.col("best.less") * -1 >= F.col("n") * ratio
    found = near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(more, F.col("best.near")).alias("form"), F.when(more, -F.col("best.less")).alias("form_n"))
    found = stored(found, "forms")
    ends = followed(found.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def shortened(each: DataFrame, rate: int = 97) -> DataFrame:
    """(word): a trial of the grouping: runs (doc_id, run) with one code point left out where `rate` divides the crc32 of
    `<doc_id>:<run>`, at the place the crc32 names. A null doc_id is read as empty."""
    number = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary"))
    rows = each.filter(F.char_length("run") > 0).select("run", number.alias("h"))
    place: Column = (F.col("h") % F.char_length("run")).cast("int")
    left_out = F.concat(F.col("run").substr(F.lit(1), place), F.col("run").substr(place + 2, F.char_length("run")))
    return rows.select(F.when(F.col("h") % rate == 0, left_out).otherwise(F.col("run")).alias("word"))
