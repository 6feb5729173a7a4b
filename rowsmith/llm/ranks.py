"""Bitmap-rank index: the place of each row in the order of a whole number, without sorting rows.

The numbers of a group are kept as a compressed bitmap: words of 64 bits, of which only those with a bit set are rows.
Partial words are merged by `bit_or`. A popcount directory says how many rows lie before each word; it is a tree of
RADIX bits a level, so no window ever holds more than 2^RADIX entries, however many rows a group has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.sources.shared import stored

WORD = 6
RADIX = 16
#: The word before all others stands for null.
NULL_WORD = -(1 << 57) - 1


def word_of(key: Column) -> Column:
    return F.coalesce(F.shiftright(key, WORD), F.lit(NULL_WORD))


def bit_of(key: Column) -> Column:
    return F.coalesce(key.bitwiseAND((1 << WORD) - 1), F.lit(0)).cast("int")


def bitmap(rows: DataFrame, group: str, key: str) -> DataFrame:
    """(group, word, bits, n, extra): the words with a bit set, rows in each, and what numbers that several rows
    have add to a popcount. Equal numbers are counted first, so a hot one is a row per task."""
    numbers = rows.groupBy(group, F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    more = F.when(F.col("_n") > 1, F.struct(F.col("_bit").alias("bit"), (F.col("_n") - 1).alias("n")))
    words = numbers.select(group, word_of(F.col("_key")).alias("word"), bit_of(F.col("_key")).alias("_bit"), "_n").groupBy(group, "word")
    return words.agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("bits"), F.sum("_n").alias("n"), F.collect_list(more).alias("extra"))


def directory(words: DataFrame, group: str) -> DataFrame:
    """The words with the number of rows of the group before each, and the number of rows of the group."""
    levels, shift = [words.withColumn("part", F.shiftright("word", RADIX))], 58
    while shift > RADIX:
        shift -= RADIX
        above = levels[-1].groupBy(group, F.col("part").alias("word")).agg(F.sum("n").alias("n"))
        levels.append(above.withColumn("part", F.shiftright("word", RADIX) if shift > RADIX else F.lit(0).cast("bigint")))
    before = Window.partitionBy(group, "part").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    counted = [level.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))) for level in levels]
    total = levels[-1].groupBy(group).agg(F.sum("n").alias("total"))
    found = counted.pop().drop("part").join(total, group)
    while counted:
        base = found.select(group, F.col("word").alias("part"), F.col("before").alias("base"), "total")
        found = counted.pop().join(base, [group, "part"]).withColumn("before", F.expr("before + base")).drop("part", "base")
    return found


def index(rows: DataFrame, group: str, key: str) -> DataFrame:
    """The words of the rows' bitmaps with their directory. The group is a text that is not null."""
    return stored(directory(bitmap(rows, group, key), group).drop("n"), "words")


def has_repeated(words: DataFrame) -> bool:
    """Whether any number occurs twice in its group."""
    return not words.filter(F.size("extra") > 0).isEmpty()


def ranked(rows: DataFrame, words: DataFrame, group: str, key: str) -> DataFrame:
    """The rows with `rank`, how many rows of their group have a smaller number (null is the smallest), `same`, how many
    have the same, and `total`, how many the group has."""
    found = rows.withColumns({"word": word_of(F.col(key)), "_bit": bit_of(F.col(key))}).join(words, [group, "word"])
    lower = F.expr("bit_count(bits & ~shiftleft(-1L, _bit))")
    extra = F.expr("aggregate(extra, 0L, (s, x) -> s + if(x.bit < _bit, x.n, 0L))")
    same = F.expr("aggregate(extra, 1L, (s, x) -> s + if(x.bit = _bit, x.n, 0L))")
    return found.select(*rows.columns, (F.col("before") + lower + extra).alias("rank"), same.alias("same"), "total")
