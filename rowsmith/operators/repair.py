"""Repair: single fixes, an ordered plan of fixes, the log of what they did, and the change audit.

A fix is a dict with the fields of FIX_FIELDS. A plan is a short list of fixes: control data, held by the
driver. Fixes on columns are expressions, so neighbouring ones melt into one projection over the scan; only
the removal of duplicates shuffles.

Steps are transactions: one with an expression that fails on any row (a zero divisor, an overflow, a cast of odd text) is
an error and leaves the table as it was, and the steps after it see that table. Such steps are tried before they are
taken, in a scan that can not fail and ends at a row that shows it; plans without formulas and predicates need none.
"""

from __future__ import annotations

from collections.abc import Container, Sequence
from decimal import Decimal, InvalidOperation
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.functions import json_text
from rowsmith.functions.columns import (
    WHOLE,
    col,
    columns_of,
    computed_once,
    control_table,
    count_where,
    is_missing,
    known,
    outcome,
    strip_space,
    title_case,
    type_class,
)
from rowsmith.functions.hashing import cell_digest
from rowsmith.operators.profile import modes
from rowsmith.operators.quantiles import group_quantiles, quantile_values
from rowsmith.sources.shared import settled

# The kinds of fix that an instruction may ask for.
FIX_TYPES = [
    "replace_values",
    "fill_missing",
    "remove_duplicates",
    "standardize_format",
    "add_validation",
    "recalculate_values",
]
DEFAULT_CONFIDENCE = 0.8
FIX_SCHEMA = (
    "struct<fix_type:string, target_column:string, fix_logic:string, implementation_method:string,"
    " new_values:array<string>, conditions:string, expected_outcome:string, medical_reasoning:string,"
    " confidence:double, predicate:string, formula:string>"
)
PLAN_LIMIT = 10_000
VIOLATION = (
    "struct<rule_id:string, validation_type:string, columns_involved:string, severity:string, fix_suggestion:string, confidence:double>"
)


def with_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Replace one column, keeping the order of columns."""
    return df.select(*[value.alias(c) if c == name else col(c) for c in df.columns])


#: Bits of the whole types.
BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def number_of(value) -> Decimal | None:
    """A finite number, or None."""
    try:
        number = Decimal(str(value).strip())
    except InvalidOperation:
        return None
    return number if number.is_finite() else None


def holding(data_type: T.DataType, number: Decimal) -> T.DataType:
    """The column's type where it can hold the number, else the next wider one: bigint, then double."""
    whole = number == number.to_integral_value()
    if isinstance(data_type, WHOLE):
        for wider in (data_type, T.LongType()):
            limit = 2 ** (BITS[wider.simpleString()] - 1)
            if whole and -limit <= number < limit:
                return wider
        return T.DoubleType()
    if isinstance(data_type, T.DecimalType):
        room = Decimal(10) ** (data_type.precision - data_type.scale)
        exact = number == round(number, data_type.scale) if abs(number) < room else False
        return data_type if exact else T.DoubleType()
    return data_type


def filled(df: DataFrame, column: str, value, where: Column | None = None) -> Column | None:
    """The column with a value put in where it is missing (or where asked); None if the value does not fit.

    A number that the column's type can not hold widens the column. A number that is not finite does not fit, as it
    would still be missing.
    """
    data_type = df.schema[column].dataType
    hit = is_missing(df, column) if where is None else where
    if type_class(data_type) == "numeric":
        number = number_of(value)
        if number is None:
            return None
        target = holding(data_type, number)
        return F.when(hit, F.lit(str(number)).cast(target)).otherwise(col(column).cast(target))
    if isinstance(data_type, T.StringType):
        return F.when(hit, F.lit(str(value))).otherwise(col(column))
    return F.when(hit, F.coalesce(F.lit(str(value)).try_cast(data_type), col(column))).otherwise(col(column))


def fill_missing(df: DataFrame, column: str, value) -> DataFrame:
    """Put a value where the column is missing; a table that can not take the value is returned unchanged."""
    new = filled(df, column, value)
    return df if new is None else with_column(df, column, new)


def replace_values(df: DataFrame, column: str, value, predicate: str | None = None) -> DataFrame:
    """Fill missing values, or replace the values of the rows for which an SQL predicate holds. A predicate that fails on
    any row leaves the table as it is."""
    new = filled(df, column, value, F.expr(predicate) if predicate else None)
    return df if new is None or (predicate and fails(df, new)) else with_column(df, column, new)


def fails(df: DataFrame, value: Column) -> bool:
    """Whether an expression fails on any row; one aggregate."""
    return df.agg(count_where(outcome(value).isNull())).first()[0] > 0


def remove_duplicates(df: DataFrame) -> DataFrame:
    """One row of each set of equal rows; null equals null, and NaN counts as null."""
    return df.select(*[known(df, c).alias(c) for c in df.columns]).dropDuplicates()


def standardize_format(df: DataFrame, column: str) -> DataFrame:
    """Trim and title-case a text column; null stays null."""
    if type_class(df.schema[column].dataType) != "text":
        return df
    return with_column(df, column, title_case(strip_space(col(column))))


def add_validation(df: DataFrame, column: str) -> DataFrame:
    """Absolute value of a numeric column; the smallest whole number, which has none in its type, stays."""
    if type_class(df.schema[column].dataType) != "numeric":
        return df
    return with_column(df, column, absolute(df, column))


def absolute(df: DataFrame, column: str) -> Column:
    data_type = df.schema[column].dataType
    if isinstance(data_type, WHOLE):
        smallest = F.lit(-(2 ** (BITS[data_type.simpleString()] - 1))).cast(data_type)
        return F.when(col(column) == smallest, col(column)).otherwise(F.abs(col(column)))
    return F.abs(col(column))


def recalculate(df: DataFrame, column: str, formula: str) -> DataFrame:
    """Replace a column by an SQL expression over the row, in the type of the column. A formula that fails on any row leaves
    the table as it is."""
    new = F.expr(formula).cast(df.schema[column].dataType)
    return df if fails(df, new) else with_column(df, column, new)


def center(df: DataFrame, column: str, method: str) -> Column:
    """mean, median or mode of a column, as one value for all rows."""
    if method == "mean":
        return df.agg(F.avg(known(df, column)).alias("v")).scalar()
    if method == "median":
        return F.lit(quantile_values(df, [column], [0.5])[column][1][0]).cast("double")
    if method == "mode":
        return modes(df, [column]).select("top").scalar()
    raise ValueError(f"unknown method {method}")


def impute(df: DataFrame, column: str, method: str, by: Sequence[str] = ()) -> DataFrame:
    """Fill missing values with the mean, median or mode of the column.

    With ``by`` the figure is taken per group: computed by partial aggregates (the median by histograms, see
    ``group_quantiles``) and joined back, so a large group is never gathered in one task. Groups without a known value use
    the whole column.
    """
    whole = center(df, column, method)
    value = whole
    rows = df
    if by:
        if method == "mean":
            groups = df.groupBy(*[col(b) for b in by]).agg(F.avg(known(df, column)).alias("_center"))
        elif method == "mode":
            counts = (
                df.filter(~is_missing(df, column))
                .groupBy(*[col(b) for b in by], col(column))
                .agg(F.count(F.lit(1)).alias("_n"))
            )
            best = F.min(F.struct((-F.col("_n")).alias("less"), col(column).alias("v")))["v"]
            groups = counts.groupBy(*[col(b) for b in by]).agg(best.alias("_center"))
        else:
            groups = group_quantiles(df, column, by, [0.5]).withColumn("_center", F.col("quantiles")[0])
        # Grouped by the join's key, a struct (its nulls are equal): known to be unique, so that figures of other columns of the
        # result are taken without this join.
        keyed = groups.groupBy(F.struct(*[col(b) for b in by]).alias("_key")).agg(F.first("_center").alias("_center"))
        rows = df.join(keyed, F.struct(*[col(b) for b in by]) == F.col("_key"), "left")
        value = F.coalesce(F.col("_center"), whole)
    new = put_in(df, column, method, value)
    return rows.select(*[new.alias(c) if c == column else col(c) for c in df.columns])


def put_in(df: DataFrame, column: str, method: str, value: Column) -> Column:
    """The column with a figure in place of missing values; a mean or median makes a whole column double."""
    data_type = df.schema[column].dataType
    target = "double" if method != "mode" and isinstance(data_type, WHOLE) else data_type
    return F.when(is_missing(df, column), value.cast(target)).otherwise(col(column).cast(target))


def imputed(df: DataFrame, column: str, method: str) -> Column:
    """The column with the mean, median or mode of all its rows in place of missing values."""
    return put_in(df, column, method, center(df, column, method))


def condition_of(df: DataFrame, fix: dict) -> str | None:
    """The predicate of a fix, or its conditions where they read as a predicate over the table; None without any.
    Conditions that do not, such as prose, raise AnalysisException."""
    text = fix.get("predicate") or fix.get("conditions")
    if text and df.limit(0).select(F.expr(text).alias("holds")).schema["holds"].dataType != T.BooleanType():
        raise AnalysisException(f"no condition: {text}")
    return text or None


def new_value(df: DataFrame, fix: dict) -> tuple[Column | None, str | None]:
    """What a fix of one column puts into it, or a status (failed, no_change, error) that leaves the table as it is.

    An expression that can not be resolved over the table is an error of that fix alone.
    """
    kind, column = fix.get("fix_type"), fix.get("target_column")
    values = fix.get("new_values") or []
    if kind not in FIX_TYPES:
        return None, "failed"
    if column not in df.columns:
        return None, "no_change"
    data_type = df.schema[column].dataType
    if kind in ("fill_missing", "replace_values"):
        if not values and fix.get("implementation_method") == "statistical_imputation":
            return imputed(df, column, "median" if column in columns_of(df, "numeric") else "mode"), None
        if not values:
            return None, "no_change"
        where = None
        if kind == "replace_values":
            try:
                where = condition_of(df, fix)
            except AnalysisException:
                return None, "error" if fix.get("predicate") else "no_change"
        new = filled(df, column, values[0], F.expr(where) if where else None)
        return new, None if new is not None else "failed"
    if kind == "standardize_format" and type_class(data_type) == "text":
        return title_case(strip_space(col(column))), None
    if kind == "add_validation" and type_class(data_type) == "numeric":
        return absolute(df, column), None
    if kind == "recalculate_values" and fix.get("formula"):
        try:
            new = F.expr(fix["formula"]).cast(data_type)
            df.limit(0).select(new)
        except AnalysisException:
            return None, "error"
        return new, None
    return None, "no_change"


def step(df: DataFrame, fix: dict) -> tuple[DataFrame, str | None]:
    """Apply one fix. The second value is failed, no_change or error with the table unchanged, or None when the data
    decides."""
    if fix.get("fix_type") == "remove_duplicates":
        return remove_duplicates(df), None
    new, status = new_value(df, fix)
    return (df, status) if new is None else (with_column(df, fix["target_column"], new), None)


def can_fail(fix: dict) -> bool:
    """Whether a fix evaluates an expression of its author on the rows."""
    kind = fix.get("fix_type")
    return bool(kind == "recalculate_values" and fix.get("formula") or kind == "replace_values" and (fix.get("predicate") or fix.get("conditions")))


def apply_fix_plan(df: DataFrame, plan: Sequence[dict]) -> DataFrame:
    """All fixes in order, each on the result of the one before, without the steps that fail."""
    return carried_out(df, plan)[0]


def carried_out(df: DataFrame, plan: Sequence[dict]) -> tuple[DataFrame, set[int]]:
    """The table after the steps that do not fail, and the steps that do.

    Steps between two removals of duplicates are tried together. A task stops at its first row that any of them fails on, as
    a failing row costs far more than a good one. The first step that failed on the row found is left out once no step before it
    fails on any row, and the steps after it are tried on what they will see."""
    failed: set[int] = set()
    part: list[int] = []
    for i, fix in enumerate(plan):
        if fix.get("fix_type") == "remove_duplicates":
            df = remove_duplicates(without_failing(df, plan, part, failed))
            part = []
        else:
            part.append(i)
    return without_failing(df, plan, part, failed), failed


def without_failing(df: DataFrame, plan: Sequence[dict], steps: list[int], failed: set[int]) -> DataFrame:
    """The table after those of the steps that do not fail; adds the others to `failed`."""
    while steps:
        first, before = None, steps
        while any(can_fail(plan[i]) for i in before):
            found = failing_step(df, plan, before)
            if found is None:
                break
            first, before = found, [i for i in steps if i < found]
        if first is not None:
            failed.add(first)
        for i in before:
            df, _ = step(df, plan[i])
        steps = [] if first is None else [i for i in steps if i > first]
    return df


def failing_step(df: DataFrame, plan: Sequence[dict], steps: Sequence[int]) -> int | None:
    """The first step that fails on a row, whichever row is found first; None if none fails on any. A row on which a step fails
    keeps its value."""
    data, current = list(df.columns), df.select("*", F.lit(None).cast("int").alias("_failed"))
    for i in steps:
        plain = current.select(*[col(c) for c in data])
        new, _ = new_value(plain, plan[i])
        if new is None:
            continue
        target = plan[i]["target_column"]
        if can_fail(plan[i]):
            new_type = plain.select(new.alias("new")).schema["new"].dataType
            current = computed_once(current, [*map(col, data), "_failed"], _good=outcome(new).isNotNull())
            new = F.when(F.col("_good"), new).otherwise(col(target).cast(new_type))
            mark = F.coalesce("_failed", F.when(~F.col("_good"), F.lit(i)))
        else:
            mark = F.col("_failed")
        current = current.select(*[(new if c == target else col(c)).alias(c) for c in data], mark.alias("_failed"))
    return current.filter("_failed IS NOT NULL").select("_failed").limit(1).agg(F.min("_failed")).first()[0]


def plan_rows(plan: DataFrame) -> list[dict]:
    """A plan held in a table, brought to the driver; refuses anything that is not a short control table."""
    rows = plan.limit(PLAN_LIMIT + 1).collect()
    if len(rows) > PLAN_LIMIT:
        raise ValueError(f"a fix plan has at most {PLAN_LIMIT} steps")
    return [r.asDict(recursive=True) for r in rows]


def traced(df: DataFrame, plan: Sequence[dict], failed: Container[int]) -> tuple[DataFrame, dict[int, str]]:
    """(step, cells_changed, rows_removed, rows_failed) of the steps that data decides, and the status of the others.

    Every fix marks the cells it changes on the row itself, so all fixes between two removals of duplicates
    are counted in one scan and nothing is joined. A step that fails changes nothing; the rows it fails on are counted."""
    data = list(df.columns)
    current, marks, parts, fixed_status = df, [], [], {}
    opened_by = None

    def close(frame, closed_by):
        counts = [count_where(F.col(f"_mark_{i}")).alias(f"n_{i}") for i in marks]
        wide = frame.agg(F.count(F.lit(1)).alias("rows"), *counts)
        zero = F.lit(0).cast("bigint")

        def entry(i, cells=zero, removed=zero, failed=zero):
            return F.struct(F.lit(i).alias("step"), cells.alias("cells"), removed.alias("removed"), failed.alias("failed"))

        rows = [entry(i, failed=F.col(f"n_{i}")) if i in failed else entry(i, cells=F.col(f"n_{i}")) for i in marks]
        if closed_by is not None:
            rows.append(entry(closed_by, removed=F.col("rows")))
        if opened_by is not None:
            rows.append(entry(opened_by, removed=-F.col("rows")))
        if rows:
            parts.append(wide.select(F.inline(F.array(*rows))))

    for i, fix in enumerate(plan):
        plain = current.select(*[col(c) for c in data])
        if fix.get("fix_type") == "remove_duplicates":
            close(current, i)
            current, marks, opened_by = remove_duplicates(plain), [], i
            continue
        new, status = new_value(plain, fix)
        if new is None:
            fixed_status[i] = status
            continue
        target = fix["target_column"]
        before = f"_before_{i}"
        kept = [f"_mark_{m}" for m in marks]
        if i in failed:
            # The mark is used once, so that a row is tried once.
            current = current.select(*[col(c) for c in data], *kept, outcome(new).isNull().alias(f"_mark_{i}"))
        else:
            # The old value rides along for one projection to be compared with the new one.
            wide = current.select(*[(new if c == target else col(c)).alias(c) for c in data], col(target).alias(before), *kept)
            differs = ~col(target).eqNullSafe(F.col(before).cast(wide.schema[target].dataType))
            current = wide.select(*[col(c) for c in data], *kept, differs.alias(f"_mark_{i}"))
        marks = [*marks, i]
    close(current, None)
    if parts:
        done = reduce(DataFrame.unionByName, parts)
    else:
        done = df.sparkSession.createDataFrame([], "step int, cells bigint, removed bigint, failed bigint")
    sums = [F.sum("cells").alias("cells_changed"), F.sum("removed").alias("rows_removed"), F.sum("failed").alias("rows_failed")]
    return done.groupBy("step").agg(*sums), fixed_status


def outcomes(df: DataFrame, plan: Sequence[dict]) -> tuple[DataFrame, dict[int, int], dict[int, str]]:
    """(what each step did, rows that each failing step fails on, status of the steps that data does not decide).

    Steps that fail are found first, so all counts are of what each step sees, and a row is tried once."""
    errors = carried_out(df, plan)[1] if any(map(can_fail, plan)) else set()
    done, fixed_status = traced(df, plan, errors)
    if not errors:
        return done, {}, fixed_status
    done = settled(done)
    counted = {r["step"]: r["rows_failed"] for r in done.filter("rows_failed > 0").select("step", "rows_failed").collect()}
    return done, {i: counted.get(i, 0) for i in errors}, fixed_status


def resolution_log(df: DataFrame, name: str, plan: Sequence[dict]) -> DataFrame:
    """One row per fix: status, cells changed, rows removed, rows it fails on, explanation, confidence."""
    done, failed, fixed_status = outcomes(df, plan)
    steps = control_table(
        df.sparkSession,
        [
            (
                i,
                name,
                f.get("issue_type"),
                f.get("fix_type"),
                f.get("target_column"),
                f.get("fix_logic") or "",
                f.get("medical_reasoning") or "",
                DEFAULT_CONFIDENCE if f.get("confidence") is None else float(f["confidence"]),
                "error" if i in failed else fixed_status.get(i),
                failed.get(i, 0),
            )
            for i, f in enumerate(plan)
        ],
        step=pa.int32(),
        dataset_name=pa.string(),
        issue_type=pa.string(),
        fix_type=pa.string(),
        target_column=pa.string(),
        fix_applied=pa.string(),
        reason=pa.string(),
        confidence=pa.float64(),
        fixed_status=pa.string(),
        rows_failed=pa.int64(),
    )
    effect = F.col("cells_changed") + F.col("rows_removed")
    return (
        steps.join(done.drop("rows_failed"), "step", "left")
        .na.fill(0, ["cells_changed", "rows_removed"])
        .withColumn(
            "status", F.coalesce("fixed_status", F.when(effect > 0, "resolved").otherwise("no_change"))
        )
        .drop("fixed_status")
    )


def enhancement_report(df: DataFrame, name: str, plan: Sequence[dict]) -> DataFrame:
    """Shape before and after, fixes by outcome, mean of the non-zero confidences of the fixes that ran."""
    after = apply_fix_plan(df.limit(0), plan)
    log = resolution_log(df, name, plan)
    ran = F.col("status").isin("resolved", "no_change")
    totals = log.agg(
        F.count(F.lit(1)).alias("issues_addressed"),
        count_where(F.col("status") == "resolved").alias("fixes_applied"),
        count_where(F.col("status") == "no_change").alias("fixes_without_effect"),
        count_where(F.col("status").isin("failed", "error")).alias("fixes_failed"),
        F.coalesce(F.sum("rows_removed"), F.lit(0)).alias("rows_removed"),
        F.avg(F.when(ran, F.nullif("confidence", F.lit(0.0)))).alias("average_confidence"),
    )
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return totals.withColumn("rows_before", rows).select(
        F.lit(name).alias("dataset_name"),
        "rows_before",
        (F.col("rows_before") - F.col("rows_removed")).alias("rows_after"),
        (-F.col("rows_removed")).alias("row_change"),
        F.lit(len(df.columns)).cast("bigint").alias("columns_before"),
        F.lit(len(after.columns)).cast("bigint").alias("columns_after"),
        "issues_addressed",
        "fixes_applied",
        "fixes_without_effect",
        "fixes_failed",
        "average_confidence",
    )


def cell_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells per column that differ between two versions of a table, matched by key.

    Cells are compared by 64-bit digests, so both sides are hash aggregates of fixed width and no text is sorted or
    shuffled. Equal rows of the old version are merged and the new version is reduced to one row per key, so repeated
    keys add nothing to the join. Rows whose key is gone, or stands for different rows in the new version,
    are counted apart. A null key is a key like others.
    """
    others = [c for c in before.columns if c in after.columns and c not in keys]
    cells = [f"c_{i}" for i in range(len(others))]
    old_cells = [cell_digest(known(before, c).cast(after.schema[c].dataType)).alias(n) for c, n in zip(others, cells, strict=True)]
    old = before.select(*[col(k) for k in keys], *old_cells).groupBy(*[col(k) for k in keys], *cells).agg(F.count(F.lit(1)).alias("copies"))
    new_cells = after.select(*[col(k) for k in keys], *[cell_digest(known(after, c)).alias(n) for c, n in zip(others, cells, strict=True)])
    row = F.xxhash64(*cells) if cells else F.lit(0)
    ends = [F.min(row).alias("low"), F.max(row).alias("high"), *[F.min(n).alias(f"n_{i}") for i, n in enumerate(cells)]]
    new = new_cells.groupBy(*[col(k) for k in keys]).agg(*ends)
    renamed = new.select(*[col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], "low", "high", *[f"n_{i}" for i in range(len(others))])
    match = reduce(lambda a, b: a & b, [col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])
    joined = old.join(renamed, match, "left")
    clear = F.col("low").isNotNull() & F.col("low").eqNullSafe(F.col("high"))
    copies = F.col("copies")

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, copies)), F.lit(0)).cast("bigint")

    wide = joined.agg(
        total(F.lit(True)).alias("rows_compared"),
        total(F.col("low").isNull()).alias("rows_gone"),
        total(F.col("low").isNotNull() & ~clear).alias("rows_unclear"),
        *[
            total(clear & (F.col(f"c_{i}") != F.col(f"n_{i}"))).alias(f"changed_{i}")
            for i in range(len(others))
        ],
    )
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"changed_{i}").alias("changed")) for i, c in enumerate(others)]
    return wide.select("rows_compared", "rows_gone", "rows_unclear", F.inline(F.array(*rows)))


def resolved(df: DataFrame, rule: dict) -> bool:
    """Whether a rule's predicate reads as a condition over the table."""
    try:
        return condition_of(df, {"predicate": rule["predicate"]}) is not None
    except AnalysisException:
        return False


def rule_violations(df: DataFrame, key: str, rules: Sequence[dict]) -> DataFrame:
    """One row per row and broken rule; nothing is repaired.

    A rule has rule_id, validation_type, columns, predicate (what valid rows satisfy), and optionally
    severity, suggestion, confidence. A row that a predicate fails on breaks no rule; see rule_errors."""
    checks = [
        F.when(
            outcome(F.expr(r["predicate"])) == "=false",
            F.struct(
                F.lit(r["rule_id"]).alias("rule_id"),
                F.lit(r["validation_type"]).alias("validation_type"),
                F.lit(",".join(r["columns"])).alias("columns_involved"),
                F.lit(r.get("severity", "medium")).alias("severity"),
                F.lit(r.get("suggestion", "")).alias("fix_suggestion"),
                F.lit(float(r.get("confidence", DEFAULT_CONFIDENCE))).alias("confidence"),
            ),
        )
        for r in rules
        if resolved(df, r)
    ]
    found = F.array_compact(F.array(*checks)) if checks else F.expr(f"CAST(array() AS ARRAY<{VIOLATION}>)")
    return df.select(col(key), F.inline(found))


def rule_errors(df: DataFrame, key: str, rules: Sequence[dict]) -> DataFrame:
    """One row per rule that can not be checked: `unresolved` over the table, or `fails` on some of its rows, with their
    number and the smallest and largest key among them. All rules are tried in one scan."""
    good = [r for r in rules if resolved(df, r)]
    marks = [F.when(outcome(F.expr(r["predicate"])).isNull(), F.lit(r["rule_id"])) for r in good]
    tried = df.select(col(key).alias("_key"), F.explode(F.array_compact(F.array(*marks, F.lit(None).cast("string")))).alias("rule_id"))
    counts = [F.count(F.lit(1)).alias("failed_rows"), F.min("_key").alias("first_key"), F.max("_key").alias("last_key")]
    failing = tried.groupBy("rule_id").agg(*counts).withColumn("reason", F.lit("fails"))
    bad = control_table(df.sparkSession, [(r["rule_id"], 0, "unresolved") for r in rules if r not in good], rule_id=pa.string(), failed_rows=pa.int64(), reason=pa.string())
    about = control_table(df.sparkSession, [(r["rule_id"], r["validation_type"], r["predicate"]) for r in rules], rule_id=pa.string(), validation_type=pa.string(), predicate=pa.string())
    return about.join(failing.unionByName(bad, allowMissingColumns=True), "rule_id")


def rule_findings(df: DataFrame, key: str, rules: Sequence[dict]) -> DataFrame:
    """Broken rules with the number of rows and the smallest and largest key among them."""
    return (
        rule_violations(df, key, rules)
        .groupBy("rule_id", "validation_type", "columns_involved", "severity", "fix_suggestion", "confidence")
        .agg(
            F.count(F.lit(1)).alias("affected_rows"),
            F.min(col(key)).alias("first_key"),
            F.max(col(key)).alias("last_key"),
        )
    )


def parse_fix_plan(responses: DataFrame, response: str = "response") -> DataFrame:
    """Fix instructions inside free text answers; an answer without a fix_type is dropped."""
    keep = [c for c in responses.columns if c != response]
    json = json_text.valid_json(json_text.object_span(F.col(response)))
    return (
        computed_once(responses, keep, fix=json_text.parse_as(json, FIX_SCHEMA))
        .filter(F.col("fix.fix_type").isNotNull())
        .select(*keep, "fix.*")
        .withColumn("confidence", F.coalesce("confidence", F.lit(DEFAULT_CONFIDENCE)))
    )
