"""Token ids in patched frame-of-reference blocks.

The files are Parquet, so that Spark writes, commits and reads them on any store; a row is one segment, which
holds whole documents in order (about SEGMENT ids; a longer document has a segment of its own):

    shard, segment       place in the order (by doc_id if no other is asked for): shards, segments within their shard
    first                ids of the shard before this segment
    doc_ids, lengths     the documents of the segment and the number of ids of each
    block_starts         byte at which each block begins in the payload
    payload              the blocks, each of BLOCK ids, the last one filled up with its minimum

A block is one byte for the bit width, one for the number of exceptions, four for the minimum (all little-endian),
BLOCK * width / 8 bytes of packed differences from the minimum (first id in the lowest bits), a byte for the place
of each exception, and four bytes for the difference of each exception. The width is the one that holds the given
percentile of the block's differences; larger differences are exceptions, whose packed bits are zero.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, normalizers, pre_tokenizers

from rowsmith.llm.words import slices
from rowsmith.sources.shared import settled

BLOCK = 128
SEGMENT = 1 << 16
PERCENTILE = 90
HEADER = 6
#: Words a task remembers the ids of before it starts anew.
REMEMBERED = 700_000
#: A normalizer's step that leaves words without white space as they are.
SPACES = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
#: An expression by which letters are one piece, and any other sign after them is another one.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Python's str.split() parts at these, the tokenizer does not.
_SEPARATORS = regex.compile("[\x1c-\x1f]")


class WordEncoder:
    """Ids of texts by a tokenizer file whose pre-tokenizer drops white space: the ids of a text are those of its
    words one after the other, so each word is encoded once and remembered. Other files encode whole texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.whole = Tokenizer.from_file(path)
        self.added = [token["content"] for token in spec["added_tokens"]]
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [spec["pre_tokenizer"] or {}])
        drops = steps[0].get("type") == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        suffix = spec["model"].get("end_of_word_suffix")
        self.pieces = regex.compile(steps[0]["pattern"]["Regex"]) if drops and suffix else None
        if self.pieces is not None:
            self.split = pre_tokenizers.Split(Regex(self.pieces.pattern), "removed", invert=True)
            named = [step["type"] for step in (spec["normalizer"] or {}).get("normalizers", [])]
            self.lowers = named == ["NFC", "Replace", "Lowercase"] and spec["normalizer"]["normalizers"][1] == SPACES
            self.plain = self.pieces.pattern == PIECES
            self.bare = Tokenizer.from_file(path)
            self.bare.normalizer = normalizers.Sequence([])
            rest = [_step(step) for step in steps[1:]]
            self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), *rest])
            self.ends = np.zeros(self.whole.get_vocab_size(), bool)
            self.ends[[i for token, i in self.whole.get_vocab().items() if token.endswith(suffix)]] = True
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, each as four little-endian bytes."""
        if self.pieces is None:
            return [self._whole(text) for text in texts]
        if max(len(self.words), len(self.parts)) > REMEMBERED:
            self.words, self.parts = {}, {}
        apart = [None if _SEPARATORS.search(text) or any(token in text for token in self.added) else text.split() for text in texts]
        get, missing = self.words.get, set()
        codes = [None if words is None else list(map(get, words)) for words in apart]
        gaps = [[at for at, code in enumerate(known or ()) if code is None] for known in codes]
        for words, at in zip(apart, gaps, strict=True):
            missing.update([words[i] for i in at])
        self._learn(list(missing))
        for words, known, at in zip(apart, codes, gaps, strict=True):
            for i in at:
                known[i] = self.words[words[i]]
        return [self._whole(text) if known is None else b"".join(known) for text, known in zip(texts, codes, strict=True)]

    def _whole(self, text: str) -> bytes:
        return _packed(self.whole.encode(text, add_special_tokens=False).ids)

    def _parted(self, word: str) -> list[str]:
        """The pieces of a normalized word. Letters, and letters before one other sign, need no expression. Beyond
        the Latin letters the tokenizer's own expression is asked, as it may know another version of Unicode."""
        if self.plain and word.isascii():
            if word.isalpha():
                return [word]
            if word[:-1].isalpha() and not word[-1].isalnum():
                return [word[:-1], word[-1]]
        if max(word, default="") < "\u0250":
            return self.pieces.findall(word)
        return [part for part, _ in self.split.pre_tokenize_str(word)]

    def _learn(self, words: list[str]) -> None:
        normal = {}
        if self.whole.normalizer:
            other = [word for word in words if not word.isascii()] if self.lowers else words
            normal = dict(zip(other, self.whole.normalizer.normalize_str(" ".join(other)).split(" "), strict=True)) if other else {}
        found = [self._parted(normal[word] if word in normal else word.lower() if self.lowers else word) for word in words]
        new = list(set().union(*found).difference(self.parts))
        for at in range(0, len(new), 2000):
            some = new[at : at + 2000]
            ids = np.array(self.bare.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            stops = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(stops) == len(some) and " " not in "".join(some):
                stream, begin = ids.tobytes(), 0
                for part, stop in zip(some, stops.tolist(), strict=True):
                    self.parts[part] = stream[begin:stop]
                    begin = stop
            else:
                self.parts |= {part: _packed(self.bare.encode(part, add_special_tokens=False).ids) for part in some}
        known = self.parts
        for word, parts in zip(words, found, strict=True):
            self.words[word] = known[parts[0]] if len(parts) == 1 else b"".join([known[part] for part in parts])


def _step(spec: dict) -> pre_tokenizers.PreTokenizer:
    """A later step of a pre-tokenizer, which sees pieces already parted."""
    if spec["type"] != "ByteLevel":
        raise ValueError(f"no step {spec['type']} is known after a split")
    return pre_tokenizers.ByteLevel(add_prefix_space=spec["add_prefix_space"], use_regex=spec["use_regex"])


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@cache
def encoder(path: str) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's own core is all there is
    return WordEncoder(path)


def pack(ids: np.ndarray, percentile: int = PERCENTILE) -> tuple[np.ndarray, bytes]:
    """Where each block begins, and the blocks."""
    if not len(ids):
        return np.zeros(0, np.int64), b""
    filled = np.full(-(-len(ids) // BLOCK) * BLOCK, ids[-(len(ids) % BLOCK) :].min() if len(ids) % BLOCK else 0, np.uint32)
    filled[: len(ids)] = ids
    blocks = filled.reshape(-1, BLOCK)
    least = blocks.min(axis=1)
    rest = blocks - least[:, None]
    limit = np.sort(rest, axis=1)[:, -(-BLOCK * percentile // 100) - 1]
    width = np.ceil(np.log2(limit.astype(np.float64) + 1)).astype(np.int64)
    odd = rest.astype(np.uint64) >> width[:, None].astype(np.uint64) > 0
    many = odd.sum(axis=1)
    size = HEADER + BLOCK // 8 * width + 5 * many
    starts = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    out[starts], out[starts + 1] = width, many
    out[starts[:, None] + np.arange(2, HEADER)] = least.astype("<u4").view(np.uint8).reshape(-1, 4)
    inner = np.where(odd, 0, rest)
    for w in np.unique(width[width > 0]):
        mine = np.flatnonzero(width == w)
        bits = (inner[mine][:, :, None] >> np.arange(w, dtype=np.uint32) & np.uint32(1)).astype(np.uint8)
        out[starts[mine][:, None] + HEADER + np.arange(BLOCK // 8 * w)] = np.packbits(bits.reshape(len(mine), -1), axis=1, bitorder="little")
    block, place = np.nonzero(odd)
    rank = np.arange(len(block)) - (np.cumsum(many) - many)[block]
    at = starts[block] + HEADER + BLOCK // 8 * width[block]
    out[at + rank] = place
    out[(at + many[block] + 4 * rank)[:, None] + np.arange(4)] = rest[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    return starts, out.tobytes()


def unpack(starts: np.ndarray, payload: bytes, n: int) -> np.ndarray:
    """The first n ids of the blocks; starts may name any blocks of the payload, in any order."""
    data = np.frombuffer(payload, np.uint8)
    width, many = data[starts].astype(np.int64), data[starts + 1].astype(np.int64)
    least = np.ascontiguousarray(data[starts[:, None] + np.arange(2, HEADER)]).view("<u4")[:, 0]
    rest = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        mine = np.flatnonzero(width == w)
        packed = data[starts[mine][:, None] + HEADER + np.arange(BLOCK // 8 * w)]
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(mine), BLOCK, w)
        for i in range(w):
            rest[mine] |= bits[:, :, i].astype(np.uint32) << np.uint32(i)
    block = np.repeat(np.arange(len(starts)), many)
    rank = np.arange(len(block)) - (np.cumsum(many) - many)[block]
    at = starts[block] + HEADER + BLOCK // 8 * width[block]
    values = data[(at + many[block] + 4 * rank)[:, None] + np.arange(4)]
    rest[block, data[at + rank]] = np.ascontiguousarray(values).view("<u4")[:, 0] if len(block) else 0
    return (rest + least[:, None]).reshape(-1)[:n]


SEGMENTS = (
    "shard int, segment int, first bigint, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, "
    "block_starts array<bigint>, payload binary"
)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, percentile: int = PERCENTILE, order: list[Column] | None = None) -> None:
    """Encode every text with the tokenizer file, end_id after each, and write the segments at path.

    One shuffle deals the rows by ranges of `order`, columns of docs that say which document comes first, or else of
    doc_id; rows with equal values are ordered, and if need be parted, by doc_id and text. A null or empty text is end_id alone; without `order`, rows without doc_id come first. The tokenizer file must be
    readable on the executors. Other columns of docs do not matter. Special tokens that occur in a text are
    read as the tokenizer reads them. An empty table writes no segment.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(tokenizer).ids, TaskContext.get().partitionId()
        end = _packed([end_id])
        segment, first = 0, 0
        ids, codes, lengths, held = [], [], [], 0

        def flushed():
            stream = np.frombuffer(b"".join(codes), "<u4")
            starts, payload = pack(stream, percentile)
            row = {"shard": [shard], "segment": [segment], "first": [first], "n_tokens": [len(stream)], "doc_ids": [list(ids)]}
            row |= {"lengths": [list(lengths)], "block_starts": [starts], "payload": [payload]}
            return pa.RecordBatch.from_pydict(row, schema)

        parts = (part for batch in batches for part in slices(batch))
        rows = (row for part in parts for row in zip(part.column("doc_id").to_pylist(), encode(pc.fill_null(part.column("text"), "").to_pylist()), strict=True))
        for doc_id, code in rows:
            ids.append(doc_id)
            codes.append(code + end)
            lengths.append(len(code) // 4 + 1)
            held += lengths[-1]
            if held >= SEGMENT:
                yield flushed()
                segment, first, held = segment + 1, first + held, 0
                ids.clear(), codes.clear(), lengths.clear()
        if ids:
            yield flushed()

    lists = pa.list_(pa.int64())
    schema = pa.schema(
        [("shard", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64())]
        + [("doc_ids", lists), ("lengths", lists), ("block_starts", lists), ("payload", pa.binary())]
    )
    ranks = {f"order{i}": column for i, column in enumerate(order or [])}
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *[c.alias(name) for name, c in ranks.items()])
    rows = rows.withColumn("tie", F.xxhash64("text"))
    by = [*ranks, "doc_id", "tie"]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "text")
    ordered.mapInArrow(task, SEGMENTS).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids): the documents of written segments, decoded from their blocks.
    Without with_ids they are decoded all the same, but only the checksum leaves the task.

    start counts the ids of all documents before. Segments are decoded where they are read, without a shuffle;
    only one total per shard is added up over the whole. Those totals are broadcast: a shard is what one task has
    written, so there are never more of them than tasks that Spark's driver has kept track of.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                value = {name: batch.column(name)[row] for name in batch.schema.names}
                lengths = value["lengths"].values.to_numpy()
                ids = unpack(value["block_starts"].values.to_numpy(), value["payload"].as_buffer(), value["n_tokens"].as_py())
                ends = np.cumsum(lengths)
                starts = ends - lengths
                raw = ids.astype("<u4")
                check = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
                at = pa.array(starts + value["base"].as_py() + value["first"].as_py())
                columns = [value["doc_ids"].values, at, pa.array(lengths), pa.array(check, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids]
    segments = spark.read.schema(SEGMENTS).parquet(path)
    totals = settled(segments.groupBy("shard").agg(F.sum("n_tokens").alias("total")))
    base = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("shard", F.coalesce(base, F.lit(0)).alias("base"))
    columns = ["base", "first", "n_tokens", "doc_ids", "lengths", "block_starts", "payload"]
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    return segments.join(F.broadcast(bases), "shard").select(columns).mapInArrow(task, schema)
