"""Rules found in data: columns that all but determine another one, and the rows that break them.

A rule X -> Y is an approximate functional dependency. Its error is the share of rows that would have to go for every
value of X to have one value of Y: counted exactly, from the numbers of rows by (X, Y). Null is a value like others, NaN
counts as null. Rules are searched level by level: single columns first, then pairs of which neither column will do.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.functions.columns import col, computed_once, control_table, known
from rowsmith.functions.hashing import cell_digest
from rowsmith.sources.shared import stored

#: Rows that rules are tried on first, and the chance that a rule is left out for it.
SAMPLE, MISSED = 20_000, 1e-12
#: Rules counted in one scan of the table.
RULES_PER_SCAN = 128
#: Rows, at least, of the sampled groups of determinants that rules are tried on next, and sets of determinants sampled in one scan.
GROUP_SAMPLE, SETS_PER_SCAN = 65_536, 48
#: A sampled group counts with at most one of these numbers of rows; whichever tells most is taken.
CAPS = [4**i for i in range(12)]


class Rule(NamedTuple):
    """Columns that determine a target."""

    by: tuple[str, ...]
    target: str

    @property
    def name(self) -> str:
        return f"{', '.join(self.by)} -> {self.target}"


class Figures(NamedTuple):
    """Rows, groups of equal determinants, different values of determinants and target together, rows that keep to the rule."""

    rows: int
    groups: int
    combinations: int
    kept: int

    @property
    def error(self) -> float:
        return (self.rows - self.kept) / self.rows


def group_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.xxhash64(*[cell_digest(known(df, c)) for c in columns]) if columns else F.lit(0).cast("bigint")


def cells_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(h): the digests of a row's cells."""
    return df.select(F.array(*[cell_digest(known(df, c)) for c in columns]).alias("h"))


def rule_figures(cells: DataFrame, columns: Sequence[str], rules: Sequence[Rule]) -> dict[Rule, Figures]:
    """The figures of rules over the cells of columns. Each row gives one pair of digests for each rule; equal pairs are added
    up before they are shuffled, so a value that a third of the rows have is a row per task."""
    place = {c: i for i, c in enumerate(columns)}
    found = {}
    for start in range(0, len(rules), RULES_PER_SCAN):
        part = rules[start : start + RULES_PER_SCAN]
        listed = ", ".join(f"struct({i} AS rule, {literal([place[c] for c in r.by])} AS of, {place[r.target]} AS y)" for i, r in enumerate(part))
        # Rules are data, not code: generated code for as many digests would be too long to be compiled.
        entry = "struct(r.rule AS rule, aggregate(r.of, 0L, (d, i) -> xxhash64(d, h[i])) AS x, h[r.y] AS y)"
        counts = cells.selectExpr(f"inline(transform(array({listed}), r -> {entry}))").groupBy("rule", "x", "y").agg(F.count(F.lit(1)).alias("n"))
        groups = counts.groupBy("rule", "x").agg(F.sum("n").alias("rows"), F.max("n").alias("kept"), F.count(F.lit(1)).alias("values"))
        sums = groups.groupBy("rule").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("groups"), F.sum("values").alias("values"), F.sum("kept").alias("kept"))
        found |= {part[r["rule"]]: Figures(r["rows"], r["groups"], r["values"], r["kept"]) for r in sums.collect()}
    return found


def beyond(limit: float, totals: dict[int, int], sampled: int) -> bool:
    """Whether a sum over groups is beyond a limit, but for a chance of MISSED, when one group in `sampled` was taken and the taken
    ones come to totals, by the most that a group was let count. It is the bound of Chernoff for a sum of independent terms."""
    for cap, total in totals.items():
        mean, seen = limit / sampled / cap, total / cap
        if seen > mean and (mean == 0 or seen - mean - seen * math.log(seen / mean) <= math.log(MISSED / len(CAPS))):
            return True
    return False


def tried_on_groups(cells: DataFrame, columns: Sequence[str], limits: dict[Rule, float], sampled: int, most_groups: float) -> list[Rule]:
    """The rules that may have at most as many breaking rows as `limits` says, of determinants with at most `most_groups` groups.

    One group of determinants in `sampled` (a power of two) is looked at, with all its rows: a sample of rows holds groups of a few
    rows in single rows, which break no rule."""
    place = {c: i for i, c in enumerate(columns)}
    sets = sorted({r.by for r in limits})
    kept = []
    for start in range(0, len(sets), SETS_PER_SCAN):
        part = sets[start : start + SETS_PER_SCAN]
        rules = [r for r in limits if r.by in part]
        wide = cells.select("h", *[F.col("h")[i].alias(f"h_{i}") for i in range(len(columns))])
        taken = [F.when(F.xxhash64(*[F.col(f"h_{place[c]}") for c in by]).bitwiseAND(F.lit(sampled - 1)) == 0, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, by in enumerate(part)]
        marked = computed_once(wide, ["h"], taken=reduce(lambda a, b: a.bitwiseOR(b), taken)).filter("taken <> 0")
        own = [f"array({', '.join(f'struct({n} AS rule, {place[r.target]} AS y)' for n, r in enumerate(rules) if r.by == by)})" for by in part]
        listed = ", ".join(f"struct(shiftleft(1L, {i}) AS bit, {literal([place[c] for c in by])} AS of, {own[i]} AS rules)" for i, by in enumerate(part))
        groups_of = marked.selectExpr("h", f"inline(filter(array({listed}), s -> taken & s.bit <> 0))")
        entries = groups_of.selectExpr("h", "aggregate(of, 0L, (d, i) -> xxhash64(d, h[i])) AS x", "rules").selectExpr("x", "inline(transform(rules, r -> struct(r.rule AS rule, h[r.y] AS y)))")
        counts = entries.groupBy("rule", "x", "y").agg(F.count(F.lit(1)).alias("n"))
        groups = counts.groupBy("rule", "x").agg((F.sum("n") - F.max("n")).alias("broken"))
        sums = groups.groupBy("rule").agg(F.count(F.lit(1)).alias("groups"), *[F.sum(F.least("broken", F.lit(c))).alias(f"broken_{c}") for c in CAPS])
        seen = {r["rule"]: r for r in sums.collect()}
        for n, rule in enumerate(rules):
            r = seen.get(n)
            if r is None or not (beyond(most_groups, {1: r["groups"]}, sampled) or beyond(limits[rule], {c: r[f"broken_{c}"] for c in CAPS}, sampled)):
                kept.append(rule)
    return kept


def literal(numbers: Sequence[int]) -> str:
    return f"CAST(array({', '.join(map(str, numbers))}) AS ARRAY<INT>)"


def find_rules(df: DataFrame, most_error: float = 0.05, most_keys: float = 0.5, gain: float = 0.5, levels: int = 2) -> dict[Rule, tuple[Figures, float]]:
    """Rules with an error of at most `most_error` and at most `gain` times the error of guessing the target's most frequent
    value, with their figures and that other error.

    Determinants with more groups than `most_keys` times the rows are keys, not rules. A pair is tried only where neither of its
    columns gives a rule for the target, and only where counts leave it a chance: each value of the target beyond the groups costs
    a row. Rules are tried on about SAMPLE rows first: the rows of a sample that break the rule are no more than those that
    break it with the values of the whole table, so but for a chance of MISSED a rule whose error in the sample is beyond the limit by
    a margin is beyond it in the table. What is left is tried on whole groups, GROUP_SAMPLE rows of them or more: that rules
    out keys, and determinants with few rows a group. Only then are rules counted in full: one scan for each level
    and RULES_PER_SCAN rules, and one for the keys of a level."""
    columns = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))]
    cells = cells_of(df, columns)
    alone = {r.target: f for r, f in rule_figures(cells, columns, [Rule((), c) for c in columns]).items()}
    if not alone:
        return {}
    rows = next(iter(alone.values())).rows
    groups = {(c,): f.combinations for c, f in alone.items()}
    sample = stored(cells.sample(min(1.0, SAMPLE / rows), seed=1), "sample") if rows > SAMPLE else None
    sampled = 2 ** max(0, int(math.log2(rows / GROUP_SAMPLE))) if rows > GROUP_SAMPLE else 1
    determinants = [c for c in columns if groups[c,] <= most_keys * rows]
    targets = [c for c in columns if alone[c].error > 0]
    found: dict[Rule, tuple[Figures, float]] = {}
    for level in range(1, levels + 1):
        tried = []
        for by in combinations(determinants, level):
            most = 1
            for c in by:
                most *= groups[c,]
            for target in targets:
                implied = target in by or any(set(r.by) < set(by) and r.target == target for r in found)
                if not implied and (groups[target,] - most) / rows <= most_error:
                    tried.append(Rule(by, target))
        if sample is not None:
            seen = rule_figures(sample, columns, tried)
            tried = [r for r, f in seen.items() if f.error <= most_error + math.sqrt(math.log(1 / MISSED) / 2 / f.rows)]
        if sampled > 1 and tried:
            limits = {r: rows * min(most_error, gain * alone[r.target].error) for r in tried}
            tried = tried_on_groups(cells, columns, limits, sampled, most_keys * rows)
        if level > 1:
            # Keys are told by their groups alone, before any target is counted.
            keys = rule_figures(cells, columns, [Rule(by, by[0]) for by in sorted({r.by for r in tried})])
            tried = [r for r in tried if keys[Rule(r.by, r.by[0])].groups <= most_keys * rows]
        for rule, figures in rule_figures(cells, columns, tried).items():
            base = alone[rule.target].error
            if figures.error <= min(most_error, gain * base):
                found[rule] = figures, base
    return found


def rules_found(df: DataFrame, name: str, **limits: float) -> DataFrame:
    """The found rules of a table: determinants, target, rows, groups, rows that break the rule, their share, and the share that
    guessing gets wrong."""
    rows = [(name, ", ".join(r.by), r.target, f.rows, f.groups, f.rows - f.kept, f.error, base) for r, (f, base) in find_rules(df, **limits).items()]
    text, whole, share = pa.string(), pa.int64(), pa.float64()
    return control_table(
        df.sparkSession, rows, dataset_name=text, determinants=text, target=text, total_records=whole, groups=whole, violations=whole, error_share=share, base_error=share
    )


def rule_breaks(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per row and found rule that it breaks: key, rule, determinants and target, its value, the value that most rows
    of its group have (ties: the first in order, null first), and how many rows the group has and how many have that value.

    The groups' values are added up first; a row looks its own group up."""
    if not rules:
        return df.limit(0).select(col(key).alias("key"), *[F.lit(None).cast(t).alias(n) for n, t in BREAKS.items()])
    entries = [
        F.struct(F.lit(i).alias("rule_no"), group_digest(df, r.by).alias("x"), known(df, r.target).cast("string").alias("value"))
        for i, r in enumerate(rules)
    ]
    cells = df.select(col(key).alias("key"), F.inline(F.array(*entries)))
    counts = cells.groupBy("rule_no", "x", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("less"), "value"))
    groups = counts.groupBy("rule_no", "x").agg(F.sum("n").alias("group_rows"), best.alias("best"), F.count(F.lit(1)).alias("values"))
    usual = groups.filter("values > 1").select("rule_no", "x", "group_rows", F.col("best.value").alias("expected"), (-F.col("best.less")).alias("expected_rows"))
    names = control_table(df.sparkSession, [(i, r.name) for i, r in enumerate(rules)], rule_no=pa.int32(), rule=pa.string())
    broken = cells.join(usual, ["rule_no", "x"]).filter(~F.col("value").eqNullSafe(F.col("expected")))
    return broken.join(F.broadcast(names), "rule_no").select("key", *BREAKS)


BREAKS = {"rule": "string", "value": "string", "expected": "string", "expected_rows": "bigint", "group_rows": "bigint"}
