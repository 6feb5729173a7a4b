"""Exact quantiles of many columns, and of the groups of a column, without gathering a column anywhere.

``percentile`` keeps every distinct value of a column in one buffer. Here one pass makes a mergeable sketch of each
column, which says between which two values a wanted rank must lie; a second pass counts what lies below, and counts the
values between the two. Counts are exact, so the result is. The values in between are some 5 in 10,000 of the table's: up to
AT_ONCE of them are looked through on the driver, more are written out and narrowed down by rounds of small histograms. A
rank that a sketch has missed is found by such rounds over the table itself.

Quantiles by group never reach the driver: a histogram of each group over BUCKETS common buckets says which bucket holds a
rank, and only the values of that bucket are put in order.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.functions.columns import col, control_table, known
from rowsmith.sources.shared import stored

BINS = 512
LARGEST = f"{sys.float_info.max!r}D"
# No table needs this many rounds: each splits every open range by BINS.
MOST_ROUNDS = 200
# A sketch's rank is off by one row in ACCURACY at most; ranks are looked for within SPREAD times that.
ACCURACY, SPREAD = 10_000, 2.5
# Values between the ends of ranks that the driver looks through.
AT_ONCE = 200_000
# Buckets of the histograms of groups: COARSE ranges of as many.
COARSE = 64
BUCKETS = COARSE * COARSE


def number(x: float) -> str:
    """SQL literal of a double."""
    return f"double('{x}')" if math.isinf(x) else f"{x!r}D"


def bin_of() -> str:
    """Bin of v between low and high: 0 .. BINS-1, infinities beside them; larger values never get a smaller bin.

    The widening scale of the first round keeps far outliers from squeezing all other values into one bin. On
    the plain scale the two ends always fall into different bins, so every further round brings them closer.
    """

    def share(scale: str) -> str:
        v, low, high = (scale.format(x=x) for x in ("v", f"greatest(low, -{LARGEST})", f"least(high, {LARGEST})"))
        return f"({v} - {low}) / nullif({high} - {low}, 0D)"

    wide, plain = share("sign({x}) * log1p(abs({x}))"), share("{x}")
    finite = f"coalesce(CAST(floor(least({BINS - 1}D, IF(widening, {wide}, {plain}) * {BINS}D)) AS INT), 0)"
    return f"CASE WHEN v > {LARGEST} THEN {BINS} WHEN v < -{LARGEST} THEN -1 ELSE {finite} END"


def next_ends(bins: list, rank: int, below: int) -> tuple[float, float, int]:
    """Ends of the bin that holds a rank, and how many values lie below it."""
    for row in sorted(bins, key=lambda r: r["bin"]):
        if rank < below + row["copies"]:
            return row["low"], row["high"], below
        below += row["copies"]
    raise ValueError("the table changed between two rounds")


def cells_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(c, v, copies): the known values of columns as doubles, c the number of the column as text."""
    values = df.select(*[known(df, c).cast("double").alias(str(i)) for i, c in enumerate(columns)])
    cells = values.unpivot([], [F.col(str(i)) for i in range(len(columns))], "c", "v").filter("v IS NOT NULL")
    return cells.withColumn("copies", F.lit(1).cast("bigint"))


def rank_values(cells: DataFrame, wanted: dict[str, tuple[float, float, set[int]]]) -> dict[tuple[str, int], float]:
    """The values at zero-based ranks of cells (c, v, copies): wanted maps c to its smallest and largest value and
    the ranks."""
    columns = list(wanted)
    if not columns:
        return {}
    # (column, rank) to (low, high, values below low)
    open_ranks = {(i, r): (*wanted[c][:2], 0) for i, c in enumerate(columns) for r in wanted[c][2]}
    found = {}
    widening = True
    for _ in range(MOST_ROUNDS):
        for key, (low, high, _) in list(open_ranks.items()):
            if low == high:
                found[columns[key[0]], key[1]] = low
                del open_ranks[key]
        spans = sorted({(i, low, high) for (i, _), (low, high, _) in open_ranks.items()})
        if not spans:
            return found
        # A few rows per column: the join is a lookup of the ends that a value may lie between.
        ends = control_table(
            cells.sparkSession,
            [(columns[i], s, low, high, widening) for s, (i, low, high) in enumerate(spans)],
            c=pa.string(),
            span=pa.int32(),
            low=pa.float64(),
            high=pa.float64(),
            widening=pa.bool_(),
        )
        bins = (
            cells.join(F.broadcast(ends), "c")
            .filter("v BETWEEN low AND high")
            .selectExpr("span", f"{bin_of()} AS bin", "v", "copies")
            .groupBy("span", "bin")
            .agg(F.expr("sum(copies) AS copies"), F.expr("min(v) AS low"), F.expr("max(v) AS high"))
            .collect()
        )
        by_span = {}
        for row in bins:
            by_span.setdefault(spans[row["span"]], []).append(row)
        open_ranks = {
            (i, r): next_ends(by_span[i, low, high], r, below) for (i, r), (low, high, below) in open_ranks.items()
        }
        widening = False
    raise ArithmeticError("quantiles did not settle")


def sketched(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, dict]:
    """Known values, smallest and largest, and for each probability the two values that its rank lies between; one
    pass over all columns."""
    around = [min(max(p + side * SPREAD / ACCURACY, 0.0), 1.0) for p in probs for side in (-1, 1)]
    shares = f"array({', '.join(f'{p!r}D' for p in around)})"
    figures = {"n": "count({v})", "low": "min({v})", "high": "max({v})", "ends": f"approx_percentile({{v}}, {shares}, {ACCURACY})"}
    values = df.select(*[known(df, c).cast("double").alias(f"v_{i}") for i, c in enumerate(columns)])
    row = values.agg(*[F.expr(f"{sql.format(v=f'v_{i}')} AS {name}_{i}") for i in range(len(columns)) for name, sql in figures.items()]).first()
    return {c: {name: row[f"{name}_{i}"] for name in figures} for i, c in enumerate(columns)}


def between(cells: DataFrame, spans: list[tuple[str, float, float]]) -> DataFrame:
    """(span, side, v, copies, low, high): for each span (c, low, high) the values within it (side 0) with their copies, and
    how many lie below (-1) and above (1), with the smallest and largest of them; one pass."""
    ends = control_table(
        cells.sparkSession, [(c, s, low, high) for s, (c, low, high) in enumerate(spans)], c=pa.string(), span=pa.int32(), from_v=pa.float64(), to_v=pa.float64()
    )
    # A few rows per column: the join is a lookup of the ends that a value may lie between.
    sided = cells.join(F.broadcast(ends), "c").selectExpr("span", "CASE WHEN v < from_v THEN -1 WHEN v > to_v THEN 1 ELSE 0 END AS side", "v", "copies")
    sides = sided.withColumn("value", F.when(F.col("side") == 0, F.col("v")))
    return sides.groupBy("span", "side", "value").agg(F.sum("copies").alias("copies"), F.min("v").alias("low"), F.max("v").alias("high"))


def settled_ranks(cells: DataFrame, spans: list[tuple[str, float, float]], ranks: list[set[int]]) -> dict[tuple[int, int], float]:
    """The values at ranks that lie within a span or right beside it; others are not found."""
    if not spans:
        return {}
    counted = between(cells, spans)
    rows = counted.limit(AT_ONCE + 1).collect()
    if len(rows) > AT_ONCE:
        counted = stored(counted, "between")
        rows = counted.filter("side <> 0").collect()
        inner = counted.filter("side = 0").select(F.col("span").cast("string").alias("c"), F.col("value").alias("v"), "copies")
        inside = {r["c"]: r for r in inner.groupBy("c").agg(F.sum("copies").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()}
    else:
        inside = None
    sides: dict[tuple[int, int], list] = {}
    for r in rows:
        sides.setdefault((r["span"], r["side"]), []).append(r)
    found, wanted, shift = {}, {}, {}
    for s in range(len(spans)):
        below, above = (sides.get((s, side), [None])[0] for side in (-1, 1))
        first = below["copies"] if below else 0
        own = sorted(sides.get((s, 0), []), key=lambda r: r["value"])
        many = sum(r["copies"] for r in own) if inside is None else inside[str(s)]["n"] if str(s) in inside else 0
        for rank in sorted(ranks[s]):
            if below and rank == first - 1:
                found[s, rank] = below["high"]
            elif above and rank == first + many:
                found[s, rank] = above["low"]
            elif first <= rank < first + many and inside is None:
                at = first
                for r in own:
                    at += r["copies"]
                    if rank < at:
                        found[s, rank] = r["value"]
                        break
            elif first <= rank < first + many:
                r = inside[str(s)]
                wanted.setdefault(str(s), (r["low"], r["high"], set()))[2].add(rank - first)
                shift[s] = first
    if wanted:
        for (c, rank), v in rank_values(inner, wanted).items():
            found[int(c), rank + shift[int(c)]] = v
    return found


def quantile_values(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, tuple[int, list]]:
    """Known values and quantiles per column, by linear interpolation; None for a column without values."""
    if not columns:
        return {}
    figures = sketched(df, columns, probs)
    cells = cells_of(df, columns)
    positions, spans, ranks, at = {}, [], [], {}
    for i, c in enumerate(columns):
        n = figures[c]["n"]
        positions[c] = [(n - 1) * float(p) for p in probs] if n else []
        for k, x in enumerate(positions[c]):
            wanted = {math.floor(x), min(math.floor(x) + 1, n - 1)}
            at |= {(c, r): figures[c][end] for r, end in ((0, "low"), (n - 1, "high")) if r in wanted}
            spans.append((str(i), *figures[c]["ends"][2 * k : 2 * k + 2]))
            ranks.append({r for r in wanted if (c, r) not in at})
    asked = [s for s in range(len(spans)) if ranks[s]]
    found = settled_ranks(cells, [spans[s] for s in asked], [ranks[s] for s in asked])
    at |= {(columns[int(spans[asked[s]][0])], rank): v for (s, rank), v in found.items()}
    missed: dict[str, tuple[float, float, set[int]]] = {}
    for s in asked:
        c = columns[int(spans[s][0])]
        for rank in ranks[s]:
            if (c, rank) not in at:
                missed.setdefault(spans[s][0], (figures[c]["low"], figures[c]["high"], set()))[2].add(rank)
    at |= {(columns[int(c)], rank): v for (c, rank), v in rank_values(cells, missed).items()}
    result = {}
    for c in columns:
        values = []
        for x in positions[c]:
            low, high = at[c, math.floor(x)], at[c, min(math.floor(x) + 1, figures[c]["n"] - 1)]
            values.append(low if low == high or x == math.floor(x) else low + (high - low) * (x - math.floor(x)))
        result[c] = (figures[c]["n"], values or [None] * len(probs))
    return result


def group_quantiles(df: DataFrame, column: str, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(by, non_null, quantiles): exact quantiles of a column in each group that has known values, as an array of doubles.

    Equal values of a group are counted first. BUCKETS common buckets are cut at approximate quantiles of the whole
    column, so a bucket has about one value in BUCKETS even of a group that holds most rows: no task orders more than a
    bucket of a group. Null is a group like others."""
    keys = [f"_g{i}" for i in range(len(by))]
    values = df.select(*[col(b).alias(k) for b, k in zip(by, keys, strict=True)], known(df, column).cast("double").alias("v")).filter("v IS NOT NULL")
    shares = ", ".join(repr(i / BUCKETS) + "D" for i in range(1, BUCKETS))
    edges = values.agg(F.expr(f"approx_percentile(v, array({shares}), {10 * BUCKETS})").alias("e")).first()["e"] or []
    edges = [*edges, *[math.inf] * (BUCKETS - 1 - len(edges))]
    listed = lambda part: f"array({', '.join(map(number, part))})"
    fine = [listed(edges[i * COARSE : (i + 1) * COARSE - 1]) for i in range(COARSE)]
    cells = values.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("copies"))
    cells = cells.withColumn("range", F.expr(f"size(filter({listed(edges[COARSE - 1 :: COARSE])}, e -> e <= v))"))
    cells = cells.withColumn("bucket", F.expr(f"range * {COARSE} + size(filter(array({', '.join(fine)})[range], e -> e <= v))"))
    cells = stored(cells.select(*keys, "v", "copies", "bucket"), "cells")
    whole = Window.partitionBy(*keys)
    running = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = cells.groupBy(*keys, "bucket").agg(F.sum("copies").alias("many"))
    counts = counts.withColumns({"below": F.coalesce(F.sum("many").over(running), F.lit(0)), "non_null": F.sum("many").over(whole)})
    spots = F.transform(F.array(*[F.lit(float(p)) for p in probs]), lambda p: (F.col("non_null") - 1) * p)
    ranks = F.flatten(F.transform(spots, lambda x: F.array(F.floor(x), F.least(F.floor(x) + 1, F.col("non_null") - 1))))
    inside = F.filter(F.array_distinct(ranks), lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("many")))
    needed = counts.withColumn("ranks", inside).filter(F.size("ranks") > 0)
    right = needed.select(*[F.col(k).alias(f"_r{k}") for k in keys], F.col("bucket").alias("_bucket"), "below", "non_null", "ranks")
    same = F.col("bucket") == F.col("_bucket")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_r{k}"))
    upto = F.sum("copies").over(Window.partitionBy(*keys, "bucket").orderBy("v")) + F.col("below")
    held = cells.join(right, same).withColumn("upto", upto)
    hits = held.withColumn("rank", F.explode("ranks")).filter("rank < upto AND rank >= upto - copies")
    found = hits.groupBy(*keys).agg(F.first("non_null").alias("non_null"), F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))

    def placed(x):
        low, high = F.col("at")[F.floor(x)], F.col("at")[F.least(F.floor(x) + 1, F.col("non_null") - 1)]
        return F.when((low == high) | (F.floor(x) == x), low).otherwise(low + (high - low) * (x - F.floor(x)))

    return found.select(*[F.col(k).alias(b) for b, k in zip(by, keys, strict=True)], "non_null", F.transform(spots, placed).alias("quantiles"))


def quantile_columns(df: DataFrame, columns: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """One row per column with the number of known values and one named field per quantile."""
    found = quantile_values(df, columns, list(probs.values()))
    return control_table(
        df.sparkSession,
        [(c, n, *q) for c, (n, q) in found.items()],
        column=pa.string(),
        non_null=pa.int64(),
        **{name: pa.float64() for name in probs},
    )
