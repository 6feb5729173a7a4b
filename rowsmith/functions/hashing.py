"""Repeatable random integers: a function of seed, name and row key only.

The value of a row does not depend on partitioning, retries or the row count.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOTS = 4


def digest(seed: int, name: str, key: Column) -> Column:
    """32 hexadecimal digits for one cell."""
    return F.md5(F.concat(F.lit(f"{seed}:{name}:"), key.cast("string")))


def slot(cell_digest: Column, i: int = 0) -> Column:
    """One of the four integers 0 .. 2^32-1 held by a digest."""
    return F.conv(F.substring(cell_digest, i * 8 + 1, 8), 16, 10).cast("bigint")


def hash_int(seed: int, name: str, key: Column) -> Column:
    """Integer 0 .. 2^32-1 for one cell."""
    return slot(digest(seed, name, key))


def pick(number: Column, choices: list[str]) -> Column:
    """One of the choices, selected by an integer."""
    options = F.array(*[F.lit(c) for c in choices])
    return F.element_at(options, (F.pmod(number, F.lit(len(choices))) + 1).cast("int"))


def cell_digest(value: Column) -> Column:
    """64 bits that stand for a cell, null included; -0.0 is 0.0. Different cells have the same with a chance of 1 in 2^64."""
    return F.xxhash64(value, value.isNull())
