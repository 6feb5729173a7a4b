"""Mixing sources to target weights as a curriculum whose weights change over the course of training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.sources.shared import settled, stored

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Relative weight at equally spaced times from the start to the end of training, straight lines between them.
#: Sources take these in turn, as they take the weights: early, even, late.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0), (0.5, 1.0, 1.5))
MOST = 3
#: Bits of monotonically_increasing_id() that count the rows of a task.
_ROWS = 33


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, turn, target) for a table of (source, source_size), one row per source.

    Sources in code point order, null last, take the weights in turn and share the sum of all sizes by weight.
    No target exceeds `most` times its source's size; what is above goes to the others by weight. With sources
    ordered by size / weight, those at their limit come first, and the share of one weight is the largest of
    what each number of such sources would leave to the rest. The windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    shared = sizes.withColumn("turn", turn.cast("int"))
    shared = shared.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("turn") + 1).cast("double"))
    limit = most * F.col("source_size")
    by_need = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total, weight = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    left = total - F.coalesce(F.sum(limit).over(by_need), F.lit(0))
    share = left / (weight - F.coalesce(F.sum("weight").over(by_need), F.lit(0)))
    shared = shared.withColumn("share", share)
    unit = F.max("share").over(everything)
    return shared.withColumn("target", F.least(limit.cast("double"), unit * F.col("weight"))).select("source", "source_size", "turn", "target")


def ordered_sizes(docs: DataFrame, seed: int = 1) -> DataFrame:
    """(doc_id, source, size, h, tie, part, nth, before, source_size, turn, target): each row with the words of its
    source that come before it in a repeatable random order. Source, part and nth name a row.

    The running sums are in two steps: within ranges of (source, h), each a part of one task's rows, and over one
    row per source and range. A source that holds most rows is spread over as many ranges as the shuffle has.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("bigint").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("h"),
        F.xxhash64("text").alias("tie"),
    )
    rows = stored(rows, "sizes")
    dealt = rows.repartitionByRange(F.col("source").asc_nulls_last(), "h", "tie").withColumn("part", F.spark_partition_id())
    within = Window.partitionBy("part", "source").orderBy("h", "tie")
    inner = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1))
    dealt = stored(dealt.withColumns({"inner": F.coalesce(inner, F.lit(0)), "nth": F.row_number().over(within)}), "ranges")
    parts = dealt.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("outer", F.coalesce(F.sum("part_size").over(ahead), F.lit(0)))
    goals = targets(parts.groupBy("source").agg(F.sum("part_size").alias("source_size")))
    figures = parts.alias("p").join(goals.alias("g"), F.col("p.source").eqNullSafe(F.col("g.source")))
    figures = figures.select(F.col("p.source").alias("_source"), F.col("part").alias("_part"), "outer", "source_size", "turn", "target")
    joined = dealt.join(figures, (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source")))
    before = (F.col("inner") + F.col("outer")).alias("before")
    return joined.select("doc_id", "source", "size", "h", "tie", "part", "nth", before, "source_size", "turn", "target")


def assignments(docs: DataFrame, seed: int = 1) -> DataFrame:
    """One row per input row: what ordered_sizes gives, and copies and taken.

    Rounds through a source follow one another; a copy is taken while the middle of its words lies before the
    source's target, so the words taken miss the target by at most half a document. A source without any word has
    no target to meet, and its rows are taken once.

    Null texts have size 0, a null source is a source of its own, null and repeated doc_ids are rows like others.
    Other columns of docs do not matter. Empty tables give no rows.
    """
    rows = ordered_sizes(docs, seed)
    rounds = F.ceil((F.col("target") - F.col("before") - F.col("size") / 2) / F.nullif(F.col("source_size"), F.lit(0)))
    copies = F.greatest(F.coalesce(rounds, F.lit(1)), F.lit(0)).cast("bigint")
    return rows.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))


def time_of(fraction: Column, schedule: tuple) -> Column:
    """When a source whose weight follows the schedule has given this fraction of its words, from 0 to 1."""
    steps = len(schedule) - 1
    areas = [(a + b) / 2 / steps for a, b in zip(schedule, schedule[1:], strict=False)]
    need = fraction * sum(areas)
    out, done = F.lit(1.0), sum(areas)
    for i in reversed(range(steps)):
        done -= areas[i]
        slope = (schedule[i + 1] - schedule[i]) * steps
        rest = need - F.lit(done)
        root = F.sqrt(F.greatest(F.lit(schedule[i] ** 2) + 2 * slope * rest, F.lit(0.0)))
        inside = F.lit(i / steps) + 2 * rest / (schedule[i] + root)
        out = F.when(need <= F.lit(done + areas[i]), inside).otherwise(out)
    return F.coalesce(out, F.lit(0.0))


def positions(rows: DataFrame, schedules: tuple = SCHEDULES) -> DataFrame:
    """One row per copy taken, with copy (from 0) and position (0 to 1) in training: the inverse of the words that
    its source's schedule asks for by then, at the middle of the copy's words."""
    taken = rows.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    fraction = (F.col("copy") * F.col("source_size") + F.col("before") + F.col("size") / 2) / F.nullif(F.col("target"), F.lit(0.0))
    position = F.lit(None).cast("double")
    for i, schedule in enumerate(schedules):
        position = F.when(F.col("turn") % len(schedules) == i, time_of(fraction, schedule)).otherwise(position)
    return taken.withColumn("position", F.coalesce(position, F.lit(0.0)))


def placed(rows: DataFrame, schedules: tuple = SCHEDULES) -> DataFrame:
    """The copies of positions(), with place: how many copies come before it in training order.

    Copies are sorted by ranges of position, ties as in curriculum(), and numbered within the task that writes them;
    one count per task is added up over the whole. Those counts are broadcast: there is one for each written task.
    """
    order = ["position", "h", "tie", "copy"]
    dealt = positions(rows, schedules).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), "places")
    task = F.shiftright("_at", _ROWS)
    counts = settled(dealt.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("many")))
    ahead = F.sum("many").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(F.col("_task").alias("_of"), F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    joined = dealt.join(F.broadcast(counts), task == F.col("_of"))
    place = F.col("_ahead") + F.col("_at").bitwiseAND(F.lit((1 << _ROWS) - 1))
    return joined.withColumn("place", place).drop("_at", "_of", "_ahead")


def order_of(docs: DataFrame, seed: int = 1, schedules: tuple = SCHEDULES) -> DataFrame:
    """(doc_id, source, size, copy, position, place): one row per copy taken. See placed() and assignments()."""
    return placed(assignments(docs, seed), schedules).select("doc_id", "source", "size", "copy", "position", "place")


def totals(docs: DataFrame, seed: int = 1, schedules: tuple = SCHEDULES) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies), one row per input row, counted in the training order."""
    rows = assignments(docs, seed)
    columns = ["doc_id", "size", "source_size", "target"]
    counted = placed(rows, schedules).groupBy("source", "part", "nth", *columns).agg(F.sum("size").alias("taken"), F.count(F.lit(1)).alias("copies"))
    return counted.select(*columns, "taken", "copies").unionByName(rows.filter("copies = 0").select(*columns, "taken", "copies"))


def curriculum(docs: DataFrame, seed: int = 1, schedules: tuple = SCHEDULES) -> DataFrame:
    """The documents in training order, each as often as the mix takes it, with the columns of docs.

    Places are found on a few numbers per row and joined back by doc_id and text. Rows with equal doc_id, source
    and text are one document here that has the places of all of them. Texts are shuffled once for the join and
    once for the order.
    """
    placed = positions(assignments(docs, seed), schedules)
    key = F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("i"), F.coalesce(F.col("source").cast("string"), F.lit("\0")).alias("s"))
    places = placed.withColumn("_key", F.xxhash64(key, "tie"))
    places = places.groupBy("_key", "h", "tie").agg(F.collect_list("position").alias("_places"), (F.count_if(F.col("copy") == 0) > 1).alias("_several"))
    places = places.select("_key", F.col("h").alias("_h"), F.col("tie").alias("_tie"), "_places", "_several")
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    label = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = docs.select(row, F.xxhash64(key, F.xxhash64("text")).alias("_k"), label.alias("_i"), F.xxhash64("text").alias("_t"))
    joined = keyed.join(places, (F.col("_k") == F.col("_key")) & (F.col("_i") == F.col("_h")) & (F.col("_t") == F.col("_tie")))
    rows = joined.filter("not _several").unionByName(joined.filter("_several").dropDuplicates(["_key", "_h", "_tie"]))
    rows = rows.withColumn("_place", F.explode("_places"))
    return rows.orderBy("_place", "_h", "_tie").select("_row.*")
