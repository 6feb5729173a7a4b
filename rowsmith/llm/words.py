"""Words of whole Arrow text columns as 64-bit hashes, computed on the byte buffers without a loop over rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text hashed at a time. Longer texts are hashed in windows, so memory does not follow the longest text,
#: only the longest word.
WINDOW = 1 << 20
BASE = 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@cache
def powers(base: int, length: int) -> np.ndarray:
    """base to the power of 0, 1, 2, ... modulo 2^64."""
    out = np.full(length, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@dataclass(frozen=True)
class Alphabet:
    """Which bytes belong to words, and what each byte is read as."""

    inside: np.ndarray
    folded: np.ndarray


def alphabet(separators: bytes) -> Alphabet:
    """A-Z are read as a-z; the given bytes separate words. Bytes of non-ASCII characters never separate."""
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    folded = np.arange(256, dtype=np.uint64) + np.uint64(1)
    folded[65:91] += np.uint64(32)
    return Alphabet(inside, folded)


#: Words `[^\x20\x09-\x0D]+`.
SPACED = alphabet(b" \t\n\x0b\x0c\r")


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offset of each row's text, with null read as the empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), at


@dataclass(frozen=True)
class Words:
    """Words of the rows of a text column: hash, first byte, byte after the last, and the number before each row."""

    hashes: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    before: np.ndarray


def word_table(data: np.ndarray, offsets: np.ndarray, kind: Alphabet = SPACED) -> Words:
    """The words of the rows. Windows end between words; a word longer than a window makes one of its own."""
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    at, end = int(offsets[0]), int(offsets[-1])
    breaks = offsets[1:-1]
    while at < end:
        stop = min(at + WINDOW, end)
        if stop < end:
            stop = _cut(data, at, stop, offsets, kind)
        part = data[at:stop]
        length = WINDOW + 1 if len(part) <= WINDOW else len(part) + 1
        inside = kind.inside[part]
        local = breaks[np.searchsorted(breaks, at) : np.searchsorted(breaks, stop)] - at
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[local] = inside[local]
        ends[:-1] &= ~inside[1:]
        ends[local[local > 0] - 1] = inside[local[local > 0] - 1]
        first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        if len(first):
            summed = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(np.where(inside, kind.folded[part], np.uint64(0)) * powers(BASE, length)[: len(part)], out=summed[1:])
            hashes = mix((summed[last] - summed[first]) * powers(pow(BASE, -1, 1 << 64), length)[first])
            found.append((hashes, first + at, last + at))
        at = stop
    hashes, starts, stops = map(np.concatenate, zip(*found, strict=True))
    return Words(hashes, starts, stops, np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, offsets: np.ndarray, kind: Alphabet = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of the rows and, for each row, the number of words before it (one more at the end)."""
    table = word_table(data, offsets, kind)
    return table.hashes, table.before


def _cut(data: np.ndarray, at: int, stop: int, offsets: np.ndarray, kind: Alphabet) -> int:
    """The last place up to stop where no word is cut, or else the end of the word that begins at `at`."""
    outside = np.flatnonzero(~kind.inside[data[at:stop]])
    row = np.searchsorted(offsets, stop, side="right")
    found = max(at + int(outside[-1]) + 1 if len(outside) else at, int(offsets[row - 1]))
    if found > at:
        return found
    limit = int(offsets[row])
    while stop < limit:
        after = np.flatnonzero(~kind.inside[data[stop : min(stop + WINDOW, limit)]])
        if len(after):
            return stop + int(after[0])
        stop = min(stop + WINDOW, limit)
    return limit


def shingle_hashes(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words of each row, and the number of runs before each row.

    counts: words before each row. A row of fewer words, but not none, has its whole sequence as one run.
    """
    sizes = np.diff(counts)
    short = (sizes > 0) & (sizes < n)
    many = np.where(short, 1, np.maximum(sizes - n + 1, 0))
    before = np.concatenate([[0], np.cumsum(many)])
    if not before[-1]:
        return np.zeros(0, np.uint64), before
    first = np.arange(before[-1]) + np.repeat(counts[:-1] - before[:-1], many)
    length = np.repeat(np.where(short, sizes, n), many)
    total = np.zeros(len(first), np.uint64)
    for i in range(n):
        has = i < length
        total = np.where(has, total * np.uint64(0xD6E8FEB86659FD93) + words[np.where(has, first + i, 0)], total)
    return mix(total + length.astype(np.uint64)), before


def distinct(values: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each row in ascending order, and the number before each row."""
    row = np.repeat(np.arange(len(before) - 1), np.diff(before))
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[keep], np.searchsorted(row[keep], np.arange(len(before)))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = WINDOW) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about that many bytes of text together, at least one row each."""
    if not batch.num_rows:
        return
    data = batch.column(batch.schema.get_field_index(column))
    size = pc.fill_null(pc.binary_length(data), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(size) - size) // most
    edges = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
        yield batch.slice(a, b - a)
