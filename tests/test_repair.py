"""Fixes, plans, logs and audits on toy frames."""

import pytest
from pyspark.sql import functions as F

from rowsmith.functions.columns import one_decimal, outcome, title_case
from rowsmith.operators import repair


def toy(spark):
    return spark.createDataFrame(
        [(1, None, "o'neil SMITH-jones", -3), (2, 2.5, None, 4), (2, 2.5, None, 4), (3, float("nan"), " x\t", None)],
        "k int, d double, t string, n int",
    )


def column(df, name):
    return [r[0] for r in df.orderBy("k").select(name).collect()]


def test_title_case_equals_python(spark):
    words = ["o'neil SMITH-jones", "éCOLE x2y", "ab_cd 3RD", "", "ÜBER straße"]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    assert [r[0] for r in df.select(title_case(F.col("t"))).collect()] == [w.title() for w in words]


def test_one_decimal_equals_python(spark):
    numbers = [i / 6000 * 100 for i in range(0, 6000, 3)] + [0.25, 0.75, 12.25, 99.95, 100.0, 0.05, 0.15, 0.35]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    assert [r[0] for r in df.select(one_decimal(F.col("x"))).collect()] == [f"{x:.1f}" for x in numbers]


def test_fill_missing_takes_nan_and_types(spark):
    assert column(repair.fill_missing(toy(spark), "d", "0"), "d") == [0.0, 2.5, 2.5, 0.0]
    assert column(repair.fill_missing(toy(spark), "t", 7), "t")[1] == "7"
    widened = repair.fill_missing(toy(spark), "n", "1.5")
    assert column(widened, "n") == [-3.0, 4.0, 4.0, 1.5]
    unchanged = repair.fill_missing(toy(spark), "n", "none")
    assert unchanged.schema == toy(spark).schema and column(unchanged, "n") == [-3, 4, 4, None]


def test_format_keeps_null_and_trims_all_white_space(spark):
    assert column(repair.standardize_format(toy(spark), "t"), "t") == ["O'Neil Smith-Jones", None, None, "X"]


def test_fixes_are_idempotent(spark):
    for fix in (
        lambda df: repair.fill_missing(df, "d", "0"),
        lambda df: repair.standardize_format(df, "t"),
        lambda df: repair.add_validation(df, "n"),
        repair.remove_duplicates,
        lambda df: repair.impute(df, "n", "median"),
    ):
        once = fix(toy(spark))
        assert sorted(map(str, fix(once).collect())) == sorted(map(str, once.collect()))


def test_duplicates_with_nan_and_null(spark):
    df = spark.createDataFrame([(1, None), (1, float("nan")), (1, 2.0)], "k int, d double")
    assert repair.remove_duplicates(df).count() == 2


def test_impute_methods(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", None), (4, "b", 10), (5, None, None)], "k int, g string, n int")
    assert column(repair.impute(df, "n", "median"), "n") == [1.0, 2.0, 2.0, 10.0, 2.0]
    assert column(repair.impute(df, "n", "mean", by=["g"]), "n") == pytest.approx([1, 2, 10, 10, 13 / 3])
    assert column(repair.impute(df, "n", "median", by=["g"]), "n") == [1.0, 2.0, 10.0, 10.0, 2.0]
    assert column(repair.impute(df, "g", "mode"), "g") == ["a", "a", "b", "b", "a"]


PLAN = [
    {"fix_type": "fill_missing", "target_column": "d", "new_values": ["1"], "confidence": 0.5},
    {"fix_type": "remove_duplicates"},
    {"fix_type": "add_validation", "target_column": "n"},
    {"fix_type": "remove_duplicates"},
    {"fix_type": "fill_missing", "target_column": "n", "new_values": ["x"]},
    {"fix_type": "standardize_format", "target_column": "gone"},
    {"target_column": "n"},
    {"fix_type": "recalculate_values", "target_column": "n", "formula": "n * 2"},
    {"fix_type": "fill_missing", "target_column": "n", "implementation_method": "statistical_imputation"},
]


def test_log_tells_what_each_fix_did(spark):
    log = {r.step: r for r in repair.resolution_log(toy(spark), "toy", PLAN).collect()}
    assert [log[i].status for i in range(9)] == [
        "resolved", "resolved", "resolved", "no_change", "failed", "no_change", "failed", "resolved", "resolved",
    ]
    assert [log[i].cells_changed for i in range(9)] == [2, 0, 1, 0, 0, 0, 0, 2, 1]
    assert [log[i].rows_removed for i in range(9)] == [0, 1, 0, 0, 0, 0, 0, 0, 0]
    assert log[1].confidence == 0.8


def test_report_counts_resolved_only(spark):
    report = repair.enhancement_report(toy(spark), "toy", PLAN).first()
    after = repair.apply_fix_plan(toy(spark), PLAN)
    assert (report.rows_before, report.rows_after) == (4, after.count())
    assert (report.fixes_applied, report.fixes_failed, report.fixes_without_effect) == (5, 2, 2)


def test_audit_with_repeated_and_lost_keys(spark):
    before = spark.createDataFrame([(1, "a")] * 5 + [(2, "b"), (3, "c"), (4, "d")], "k int, t string")
    after = spark.createDataFrame([(1, "A")] * 3 + [(2, "b"), (4, "d"), (4, "e")], "k int, t string")
    row = repair.cell_changes(before, after, ["k"]).first()
    assert (row.rows_compared, row.rows_gone, row.rows_unclear, row.changed) == (8, 1, 1, 5)


def test_plan_from_a_table(spark):
    answers = spark.createDataFrame(
        [(1, 'x {"fix_type": "add_validation", "target_column": "n"} y'), (2, '{"a": 1} and {"b": 2}'), (3, "none")],
        "id int, response string",
    )
    plan = repair.plan_rows(repair.parse_fix_plan(answers))
    assert [p["fix_type"] for p in plan] == ["add_validation"]
    assert column(repair.apply_fix_plan(toy(spark), plan), "n") == [3, 4, 4, None]


def test_rules_ignore_unknown(spark):
    rules = [{"rule_id": "r", "validation_type": "range", "columns": ["n"], "predicate": "n > 0"}]
    rows = repair.rule_violations(toy(spark), "k", rules).collect()
    assert [(r.k, r.rule_id, r.confidence) for r in rows] == [(1, "r", 0.8)]


def test_fixes_that_can_not_be_done_leave_the_table(spark):
    df = spark.createDataFrame([(1, None, -(2**31)), (2, 5, 7), (3, 1, 2**31 - 1)], "k int, v int, n int")
    wide = repair.fill_missing(df, "v", "3000000000")
    assert wide.schema["v"].dataType.simpleString() == "bigint" and column(wide, "v") == [3000000000, 5, 1]
    assert column(repair.fill_missing(df, "v", "nan"), "v") == [None, 5, 1]
    assert column(repair.add_validation(df, "n"), "n") == [-(2**31), 7, 2**31 - 1]
    plan = [
        {"fix_type": "fill_missing", "target_column": "v", "new_values": ["nan"]},
        {"fix_type": "fill_missing", "target_column": "v", "new_values": ["3000000000"]},
        {"fix_type": "replace_values", "target_column": "v", "new_values": ["0"], "conditions": "v > 4 and v < 100"},
        {"fix_type": "replace_values", "target_column": "v", "new_values": ["9"], "conditions": "all the odd ones"},
        {"fix_type": "replace_values", "target_column": "v", "new_values": ["9"], "predicate": "nowhere > 1"},
        {"fix_type": "recalculate_values", "target_column": "v", "formula": "absent + 1"},
        {"fix_type": "recalculate_values", "target_column": "v", "formula": "v + k"},
        {"fix_type": "polish", "target_column": "v"},
        {"fix_type": "add_validation", "target_column": "n"},
    ]
    log = {r.step: (r.status, r.cells_changed) for r in repair.resolution_log(df, "t", plan).collect()}
    assert [log[i][0] for i in range(9)] == [
        "failed", "resolved", "resolved", "no_change", "error", "error", "resolved", "failed", "no_change",
    ]
    assert log[2][1] == 1 and column(repair.apply_fix_plan(df, plan), "v") == [3000000001, 2, 4]


def test_audit_compares_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (2, 2)], "k int, v int")
    row = repair.cell_changes(df, repair.with_column(df, "v", F.col("v") + 1), ["k"]).first()
    assert (row.rows_compared, row.rows_gone, row.changed) == (2, 0, 2)


def odd(spark):
    rows = [(1, 6, 3, "1"), (2, 5, 0, "2"), (3, None, 0, "x"), (4, 2**31 - 1, 1, None)]
    return spark.createDataFrame(rows, "k int, v int, q int, t string")


def test_an_expression_that_fails_is_null_for_outcome(spark):
    """try_to_binary takes the errors of its argument; transactions rest on that."""
    found = [r[0] for r in odd(spark).orderBy("k").select(outcome(F.expr("10 / q"))).collect()]
    assert found == ["=3.3333333333333335", None, None, "=10.0"]
    assert column(odd(spark).withColumn("o", outcome(F.expr("CAST(t AS INT)"))), "o") == ["=1", "=2", None, "-"]
    assert column(odd(spark).withColumn("o", outcome(F.expr("v + 1"))), "o") == ["=7", "=6", "-", None]
    assert column(odd(spark).withColumn("o", outcome(F.expr("raise_error(t)"))), "o") == [None] * 4


def test_steps_that_fail_leave_the_table(spark):
    plan = [
        {"fix_type": "recalculate_values", "target_column": "v", "formula": "v / q"},
        {"fix_type": "recalculate_values", "target_column": "v", "formula": "v + 1"},
        {"fix_type": "replace_values", "target_column": "v", "new_values": ["7"], "predicate": "CAST(t AS INT) = 2"},
        {"fix_type": "replace_values", "target_column": "t", "new_values": ["3"], "predicate": "t = 'x'"},
        {"fix_type": "remove_duplicates"},
        {"fix_type": "replace_values", "target_column": "v", "new_values": ["7"], "predicate": "CAST(t AS INT) = 2"},
        {"fix_type": "recalculate_values", "target_column": "q", "formula": "IF(k = 1, raise_error('no'), 5)"},
        {"fix_type": "recalculate_values", "target_column": "q", "formula": "q + v"},
    ]
    log = {r.step: (r.status, r.cells_changed, r.rows_failed) for r in repair.resolution_log(odd(spark), "t", plan).collect()}
    assert [log[i] for i in range(8)] == [
        ("error", 0, 1),
        ("error", 0, 1),
        ("error", 0, 1),
        ("resolved", 1, 0),
        ("no_change", 0, 0),
        ("resolved", 1, 0),
        ("error", 0, 1),
        ("error", 0, 1),
    ]
    after = repair.apply_fix_plan(odd(spark), plan)
    assert (column(after, "v"), column(after, "q"), column(after, "t")) == ([6, 7, None, 2**31 - 1], [3, 0, 0, 1], ["1", "2", "3", None])


def test_single_fixes_are_transactions(spark):
    assert column(repair.recalculate(odd(spark), "v", "v / q"), "v") == [6, 5, None, 2**31 - 1]
    assert column(repair.replace_values(odd(spark), "v", 1, predicate="CAST(t AS INT) = 1"), "v") == [6, 5, None, 2**31 - 1]
    assert column(repair.recalculate(odd(spark), "q", "q * 2"), "q") == [6, 0, 0, 2]
    assert repair.recalculate(odd(spark).limit(0), "q", "1 / q").count() == 0


def test_rules_that_fail_are_reported_apart(spark):
    rule = lambda name, predicate: {"rule_id": name, "validation_type": "x", "columns": ["v"], "predicate": predicate}
    rules = [rule("a", "v / q > 3"), rule("b", "CAST(t AS INT) > 1"), rule("c", "nothing"), rule("d", "k > 1")]
    broken = sorted((r.k, r.rule_id) for r in repair.rule_violations(odd(spark), "k", rules).collect())
    assert broken == [(1, "a"), (1, "b"), (1, "d")]
    errors = {r.rule_id: (r.reason, r.failed_rows, r.first_key, r.last_key) for r in repair.rule_errors(odd(spark), "k", rules).collect()}
    assert errors == {"a": ("fails", 1, 2, 2), "b": ("fails", 1, 3, 3), "c": ("unresolved", 0, None, None)}
    assert repair.rule_violations(odd(spark), "k", rules[2:3]).count() == 0


def test_failing_steps_are_counted_in_one_pass(spark, monkeypatch):
    """However many steps fail, rows are counted once for the log and not at all for the table."""
    passes, traced = [], repair.traced

    def recorded(*args):
        passes.append(args)
        return traced(*args)

    monkeypatch.setattr(repair, "traced", recorded)
    df = spark.createDataFrame([(i, float(i % 3), str(i) if i % 2 else "x") for i in range(12)] * 2, "k bigint, v double, t string").repartition(3)
    plan = [
        {"fix_type": "recalculate_values", "target_column": "v", "formula": "v + 1"},
        {"fix_type": "recalculate_values", "target_column": "v", "formula": "k / (v - 1)"},
        {"fix_type": "replace_values", "target_column": "v", "new_values": ["9"], "predicate": "CAST(t AS INT) = 1"},
        {"fix_type": "remove_duplicates"},
        {"fix_type": "recalculate_values", "target_column": "k", "formula": "k / (v - 3)"},
        {"fix_type": "recalculate_values", "target_column": "v", "formula": "10 / v"},
    ]
    log = {r.step: (r.status, r.cells_changed, r.rows_removed, r.rows_failed) for r in repair.resolution_log(df, "t", plan).collect()}
    assert log == {
        0: ("resolved", 24, 0, 0),
        1: ("error", 0, 0, 8),
        2: ("error", 0, 0, 12),
        3: ("resolved", 0, 12, 0),
        4: ("error", 0, 0, 4),
        5: ("resolved", 12, 0, 0),
    }
    assert len(passes) == 1
    table = {(r.k, r.v, r.t) for r in repair.apply_fix_plan(df, plan).collect()}
    assert table == {(i, 10.0 / (i % 3 + 1), str(i) if i % 2 else "x") for i in range(12)} and len(passes) == 1


@pytest.mark.parametrize("method", ["mean", "mode", "median"])
def test_grouped_imputation_is_not_repeated_for_other_columns(spark, capsys, method):
    """What reads only other columns of the result does without the groups' figures; null groups are groups."""
    rows = [(1, None, 4.0), (2, None, 4.0), (3, None, None), (4, "a", 7.0), (5, "a", None), (6, "b", None), (7, "a", 7.0)]
    df = spark.createDataFrame(rows, "k int, g string, v double")
    filled = repair.impute(df, "v", method, by=["g"])
    whole = {"mean": 5.5, "mode": 4.0, "median": 5.5}[method]
    assert {r.k: r.v for r in filled.collect()} == {1: 4.0, 2: 4.0, 3: 4.0, 4: 7.0, 5: 7.0, 6: whole, 7: 7.0}
    filled.select("k", "g").explain()
    assert "Join" not in capsys.readouterr().out
