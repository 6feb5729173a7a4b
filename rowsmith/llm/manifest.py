"""Merkle manifest of a dataset: a digest for each row, a tree for each language, a tree over the languages.

A leaf's place is a rank query on the bitmap of its language's doc_ids (see `ranks`). Leaves of SLOTS consecutive places
form a slot array, keyed by (language, place / SLOTS); an array is reduced by all its levels at once and gives one node
of the next tier, so a tree of any size takes a few shuffles of digests. Texts never travel.

Nulls: each null field is `-`; a null language is a language of its own, the first; rows without doc_id come before the
others. Rows that share language and doc_id are ordered by their leaves, and equal rows in any order. Empty and very
long texts are fields like others. An empty table has no rows and no root. Columns that are not fields do not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm.ranks import has_repeated, index, ranked
from rowsmith.sources.shared import stored

#: Levels that a slot array is reduced by, and its length.
LEVELS = 10
SLOTS = 1 << LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value as bytes that can not be mistaken for another list of values."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(row: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field(row[name]) for name in FIELDS]), 256)


def leaves(docs: DataFrame, **others: dict[str, Column]) -> DataFrame:
    """(uid, tree, doc_id, lang, leaf, ...): the leaf of each row, and one more column for each set of changed fields,
    null where the condition `if` of the set does not hold. `tree` names the language's tree."""
    row = {name: F.col(name) for name in FIELDS}
    tree = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-"))
    changed = {name: F.when(change["if"], leaf(row | {k: v for k, v in change.items() if k != "if"})) for name, change in others.items()}
    columns = [tree.alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), "lang", leaf(row).alias("leaf")]
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), *columns, *[c.alias(n) for n, c in changed.items()])
    return stored(rows, "leaves")


def placed(rows: DataFrame) -> DataFrame:
    """The leaves with `slot`, their place in their tree from 0, and `total`, the leaves of the tree.

    Only rows that share a doc_id need more than its rank: they are ranked again by the first 60 bits of their
    leaves, and where those are equal too, by the number of the row. A doc_id that a third of all rows have is spread like any
    other group."""
    words = index(rows, "tree", "doc_id")
    found = ranked(rows, words, "tree", "doc_id")
    single = found.filter("same = 1").select(*rows.columns, F.col("rank").alias("slot"), "total")
    if not has_repeated(words):
        return single
    ids = F.concat_ws(":", "tree", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    head = F.conv(F.substring("leaf", 1, 15), 16, 10).cast("bigint")
    again = found.filter("same > 1").select(*rows.columns, F.col("rank").alias("_first"), F.col("total").alias("_all"), ids.alias("_ids"), head.alias("_head"))
    again = stored(again, "repeated")
    again = ranked(again, index(again, "_ids", "_head"), "_ids", "_head").drop("same", "total").withColumnRenamed("rank", "_second")
    again = stored(again.withColumn("_equal", F.concat_ws(":", "_ids", "_head")), "repeated")
    again = ranked(again, index(again, "_equal", "uid"), "_equal", "uid")
    return single.unionByName(again.select(*rows.columns, F.expr("_first + _second + rank AS slot"), F.col("_all").alias("total")))


def reduced(array: Column, levels: Column) -> Column:
    """All levels of a slot array, its digests first: each further level has the digests of every two consecutive
    nodes, and of the last one alone where their number is odd."""

    def above(known, _):
        last = F.element_at(known, -1)
        pairs = F.sequence(F.lit(0), F.shiftright(F.size(last) + 1, 1) - 1)
        return F.concat(known, F.array(F.transform(pairs, lambda i: F.sha2(F.concat(F.get(last, i * 2), F.coalesce(F.get(last, i * 2 + 1), F.lit(""))), 256))))

    steps = F.filter(F.sequence(F.lit(0), levels), lambda i: i > 0)
    return F.aggregate(steps, F.array(array), above)


def tier(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """(tree, block, total, rows, levels): the slot arrays of nodes (tree, slot, total, digest). rows holds the carried columns in slot order.

    A tree of several arrays needs LEVELS of each; the only array of a tree needs as many as leave one node."""
    row = F.struct("slot", "digest", *carried)
    blocks = nodes.groupBy("tree", F.shiftright("slot", LEVELS).alias("block"), "total").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    most = F.when(F.col("total") > SLOTS, LEVELS).otherwise(F.ceil(F.log2(F.col("total").cast("double"))).cast("int"))
    return stored(blocks.withColumn("levels", reduced(F.col("rows.digest"), most)), "slots")


def tiers(nodes: DataFrame, carried: list[str]) -> list[DataFrame]:
    """Slot arrays from the leaves up to the tier at which every tree is one array."""
    found = [tier(nodes, carried)]
    while (found[-1].agg(F.max("total")).first()[0] or 0) > SLOTS:
        top = F.element_at(F.element_at("levels", -1), 1).alias("digest")
        above = F.shiftright(F.col("total") + (SLOTS - 1), LEVELS).alias("total")
        found.append(tier(found[-1].filter(F.col("total") > SLOTS).select("tree", F.col("block").alias("slot"), above, top), []))
    return found


def roots(tiers_: list[DataFrame]) -> DataFrame:
    """(tree, digest): the top node of each tree."""
    tops = [t.filter(F.col("total") <= SLOTS).select("tree", F.element_at(F.element_at("levels", -1), 1).alias("digest")) for t in tiers_]
    return reduce(DataFrame.unionByName, tops)


def descended(tiers_: list[DataFrame], crown: DataFrame, extra: list[str]) -> DataFrame:
    """The rows of the lowest tier with `proof`, the way from each to the top. crown: (tree, proof, extra columns), the way
    from each tree's top upwards."""
    known = None

    def way(row: Column) -> Column:
        place = row["slot"].bitwiseAND(SLOTS - 1).cast("int")

        def step(level: Column) -> Column:
            at = F.call_function("shiftright", place, level)
            right = at.bitwiseAND(1) == 1
            return F.struct(right.alias("right"), F.get(F.get("levels", level), F.when(right, at - 1).otherwise(at + 1)).alias("sibling"))

        below_top = F.filter(F.sequence(F.lit(0), F.size("levels") - 1), lambda i: i < F.size("levels") - 1)
        return F.struct(row.alias("row"), F.transform(below_top, step).alias("own"))

    for t in reversed(tiers_):
        tops = t.filter(F.col("total") <= SLOTS).join(crown, "tree")
        if known is not None:
            lower = t.filter(F.col("total") > SLOTS).join(known, ["tree", "block"])
            tops = tops.unionByName(lower)
        # The levels stay behind: only a row's own way leaves its array.
        rows = tops.select("tree", "proof", *extra, F.inline(F.transform("rows", way)))
        rows = rows.select("tree", F.col("row.slot").alias("block"), F.concat("own", "proof").alias("proof"), *extra, "row")
        known = rows.drop("row")
    return rows.select("tree", "proof", *extra, "row.*")


def numbered(rows: DataFrame, by: str) -> DataFrame:
    """The rows with `slot`, their place in the order of a text column, and `total`: numbers within ranges, and the sizes
    of the ranges before added, one row for each range."""
    ranges = stored(rows.repartitionByRange(by).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(Window.partitionBy(F.lit(1))).alias("total"))
    own = ranges.withColumn("own", F.row_number().over(Window.partitionBy("part").orderBy(by)))
    return own.join(sizes, "part").select(*rows.columns, (F.col("before") + F.col("own") - 1).alias("slot"), "total")


def folded(digest: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings on its way give. A node without sibling is hashed alone."""

    def up(node, step):
        sibling = F.coalesce(step["sibling"], F.lit(""))
        return F.sha2(F.when(step["right"], F.concat(sibling, node)).otherwise(F.concat(node, sibling)), 256)

    return F.aggregate(proof, digest, up)


def manifest(docs: DataFrame, **others: dict[str, Column]) -> DataFrame:
    """(doc_id, lang, slot, leaf, subroot, root, proof, ...): each row's leaf, its place among the leaves of its language,
    the root of its language's tree, the root of all, and the way from leaf to root: an array of (right, sibling), where
    right says that the node is the second of its two, and the sibling is null for a node alone.

    Each further set of changed fields with a condition gives a column of the leaves that the changed rows would have."""
    rows = placed(leaves(docs, **others))
    carried = ["doc_id", "lang", *others]
    trees = tiers(rows.withColumnRenamed("leaf", "digest"), carried)
    subroots = numbered(roots(trees), "tree").withColumnRenamed("tree", "of")
    top = tiers(subroots.withColumn("tree", F.lit("")), ["of"])
    none = "CAST(array() AS ARRAY<STRUCT<right: BOOLEAN, sibling: STRING>>) AS proof"
    crown = descended(top, roots(top).selectExpr("tree", none, "digest AS root"), ["root"])
    crown = stored(crown.select(F.col("of").alias("tree"), "proof", "root", F.col("digest").alias("subroot")), "crown")
    found = descended(trees, crown, ["root", "subroot"])
    return found.select("doc_id", "lang", "slot", F.col("digest").alias("leaf"), "subroot", "root", "proof", *others)


def audited(docs: DataFrame) -> DataFrame:
    """The manifest with a trial of its proofs: in rows whose doc_id has a crc32 that 7 divides, n_chars is raised by one,
    and every row's leaf, changed or not, is folded with its siblings. `verified` says whether the root came out."""
    tried = {"if": F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, "n_chars": F.col("n_chars").cast("bigint") + 1}
    found = manifest(docs, tampered=tried)
    siblings = F.array_join(F.transform("proof", lambda step: step["sibling"]), "")
    found = found.withColumns({"proof_sha256": F.sha2(siblings, 256), "folded_root": folded(F.coalesce("tampered", "leaf"), F.col("proof"))})
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
