"""Found rules beside a search through all of them."""

from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from rowsmith.operators import dependencies
from rowsmith.operators.dependencies import Rule


def plain(rows, columns, most_error=0.05, most_keys=0.5, gain=0.5):
    n, found = len(rows), {}
    for level in (1, 2):
        for by in combinations(columns, level):
            for y in columns:
                if y in by or any((c,) in [b for b, t in found if t == y] for c in by):
                    continue
                groups = defaultdict(Counter)
                for r in rows:
                    groups[tuple(r[c] for c in by)][r[y]] += 1
                kept = sum(max(g.values()) for g in groups.values())
                base = 1 - max(Counter(r[y] for r in rows).values()) / n
                error = (n - kept) / n
                if base > 0 and len(groups) <= most_keys * n and error <= min(most_error, gain * base):
                    found[by, y] = (len(groups), n - kept)
    return found


def table(spark, n=900):
    rng = np.random.default_rng(15)
    rows = []
    for i in range(n):
        city = int(rng.zipf(1.6) % 40)
        a, b = int(rng.integers(6)), int(rng.integers(7))
        country = None if city % 9 == 0 else f"c{city % 5}"
        if rng.random() < 0.03:
            country = "odd"
        total = float("nan") if (a * 7 + b) % 11 == 0 else float((a * 7 + b) % 11)
        rows.append((i, city, country, a, b, total if rng.random() > 0.02 else -1.0, "one", i % 3))
    return rows, ["k", "city", "country", "a", "b", "total", "same", "turn"], spark.createDataFrame(rows, "k int, city int, country string, a int, b smallint, total double, same string, turn bigint")


@pytest.mark.parametrize(("per_scan", "sample"), [(128, 20_000), (3, 20_000), (128, 400)])
def test_rules(spark, monkeypatch, per_scan, sample):
    monkeypatch.setattr(dependencies, "RULES_PER_SCAN", per_scan)
    monkeypatch.setattr(dependencies, "SAMPLE", sample)
    rows, columns, df = table(spark)
    dicts = [{c: (None if isinstance(v, float) and v != v else v) for c, v in zip(columns, r, strict=True)} for r in rows]
    want = plain(dicts, columns)
    found = {(r.by, r.target): (f.groups, f.rows - f.kept) for r, (f, _) in dependencies.find_rules(df.repartition(5)).items()}
    assert found == want
    assert (("city",), "country") in found and (("a", "b"), "total") in found


def test_breaks(spark):
    rows, _, df = table(spark)
    found = dependencies.rule_breaks(df, "k", [Rule(("city",), "country"), Rule(("a", "b"), "total")]).collect()
    usual = defaultdict(Counter)
    for r in rows:
        usual[r[1]][r[2]] += 1
    want = {}
    for r in rows:
        counts = usual[r[1]]
        best = min(counts, key=lambda v: (-counts[v], v is not None, v or ""))
        if r[2] != best:
            want[r[0]] = (r[2], best, counts[best], sum(counts.values()))
    got = {r.key: (r.value, r.expected, r.expected_rows, r.group_rows) for r in found if r.rule == "city -> country"}
    assert got == want and len({r.rule for r in found}) == 2


def test_tables_without_rules(spark):
    assert dependencies.rules_found(spark.range(20), "keys").count() == 0
    assert dependencies.rules_found(spark.range(0).selectExpr("id", "id AS other"), "none").count() == 0
    nested = spark.range(9).selectExpr("array(id) AS list", "id % 2 AS a", "id % 2 = 1 AS b")
    assert {(r.determinants, r.target) for r in dependencies.rules_found(nested, "t").collect()} == {("a", "b"), ("b", "a")}
    assert dependencies.rule_breaks(nested, "a", []).count() == 0


def test_rules_of_small_groups_are_not_counted_in_full(spark, monkeypatch):
    """Determinants with a few rows a group break no rule in a sample of rows; whole groups tell."""
    monkeypatch.setattr(dependencies, "SAMPLE", 300)
    monkeypatch.setattr(dependencies, "GROUP_SAMPLE", 1_000, raising=False)
    rng = np.random.default_rng(3)
    rows = [(i // 4, i % 1_000, int(rng.integers(50)), int(rng.integers(9)), f"g{i // 4 % 7}" if i % 50 else None) for i in range(8_000)]
    columns = ["order", "part", "quantity", "tax", "group"]
    df = spark.createDataFrame(rows, "order int, part int, quantity int, tax int, group string").repartition(3)
    counted, figures = [], dependencies.rule_figures

    def recorded(cells, names, rules):
        counted.append((cells, len(rules)))
        return figures(cells, names, rules)

    monkeypatch.setattr(dependencies, "rule_figures", recorded)
    found = {(r.by, r.target): (f.groups, f.rows - f.kept) for r, (f, _) in dependencies.find_rules(df).items()}
    assert found == plain([dict(zip(columns, r, strict=True)) for r in rows], columns) and (("order",), "group") in found
    whole = counted[0][0]
    assert sum(n for cells, n in counted if cells is whole) - len(columns) <= 12


def test_bound_on_sampled_groups():
    """A sum over groups is told to be beyond a limit only where that is all but sure."""
    assert dependencies.beyond(1_000, {1: 500, 4: 500}, 8)
    assert not dependencies.beyond(1_000, {1: 130, 4: 130}, 8)
    assert not dependencies.beyond(1_000, {1: 4, 4_096: 2_000}, 8)
    assert dependencies.beyond(0, {1: 1}, 8) and not dependencies.beyond(0, {1: 0}, 8)
