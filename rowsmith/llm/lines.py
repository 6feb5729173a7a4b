"""Fuzzy line dedup by MinHash over character shingles, in DataFrame operations only.

Lines that are alike form a component, of which the first line in the table is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm.components import components
from rowsmith.llm.minhash import open_members, prefix_pairs
from rowsmith.sources.shared import removed, stored

#: Bytes of a shingle; least similarity in percent; bands, and signature coordinates in each.
SHINGLE = 12
PERCENT = 80
BANDS, ROWS = 8, 2
#: 64-bit words, a power of two, of a line's bitmap of shingles, which says how much two lines differ at least.
WORDS = 16
#: Members up to which a bucket's pairs are all compared by their bitmaps.
FEW = 32
#: The bitmap that says which texts are needed has 2 to this power rows of 1,024 bits (16 MB) at most.
CELLS = 17
#: Lines compared with one copy of a hub; a hub with more of them gets more copies.
GROUP = 1024


def parted(text: Column | str) -> Column:
    """The lines of a text. A carriage return before a line break belongs to the break; no regular expression is
    needed, which would take twice the time."""
    return F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), "\n")


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line, d1, d2): the lines of each text that are not empty, numbered from 0, and a 128-bit
    digest of each."""
    rows = docs.filter(F.col("doc_id").isNotNull())
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.posexplode(parted("text")).alias("line_no", "line"))
    return rows.filter("line != ''").withColumns({"d1": F.xxhash64("line"), "d2": F.xxhash64(F.lit(1), "line")})


def last_start(line: Column, size: int) -> Column:
    """Where the last shingle of a line begins, from 1. A line shorter than a shingle is one shingle."""
    return F.greatest(F.octet_length(line) - (size - 1), F.lit(1))


def starts(line: Column, size: int) -> Column:
    """Where the shingles of a line begin."""
    return F.sequence(F.lit(1), last_start(line, size))


def shingles(line: Column, size: int) -> Column:
    """The shingles of a line as 64-bit hashes, in order. The line is bound once: read from the row, its bytes are
    copied for each shingle."""
    return F.transform(F.array(line), lambda one: F.transform(starts(one, size), lambda at: F.xxhash64(one.substr(at, F.lit(size)))))[0]


def shingle_set(line: Column, size: int) -> Column:
    """The different shingles of a line as 64-bit hashes."""
    return F.array_distinct(shingles(line, size))


def exploded(sets: DataFrame, name: str) -> DataFrame:
    """(id, name): a row for each shingle of the sets (id, set). No set is empty, and the outer form of explode gets no
    filter on its argument, for which sets would be computed once more, also those that a join below leaves out."""
    return sets.select("id", F.explode_outer("set").alias(name))


def line_keys(docs: DataFrame, size: int, bands: int, rows: int, seed: int) -> DataFrame:
    """(id, d1, d2, times, keys): one row for each different line, with a key for each band.

    A coordinate is the least value over the line's shingles of their hash under one bijection of the 64-bit
    integers. The minima of equal lines are equal, so lines are grouped by digest in the same step, and a line that a
    third of all texts have is one row per task in the shuffle. A row holds two shingles, which halves the updates of
    minima; the last of an odd number stands twice."""
    each = lines_of(docs).select("d1", "d2", F.col("line").cast("binary").alias("line"))
    each = each.select("d1", "d2", "line", last_start(F.col("line"), size).alias("last"))
    each = each.select("d1", "d2", "line", "last", F.explode(F.sequence(F.lit(1), "last", F.lit(2))).alias("at"))
    pair = [F.xxhash64(F.expr(f"substring(line, {at}, {size})")) for at in ("at", "least(at + 1, last)")]
    hashed = each.select("d1", "d2", (F.col("at") == 1).cast("int").alias("head"), pair[0].alias("h"), pair[1].alias("next"))
    least = []
    for i in range(bands * rows):
        x, y = (F.col(c).bitwiseXOR(F.xxhash64(F.lit(seed + i))) for c in ("h", "next"))
        least.append(F.min(F.when(x < y, x).otherwise(y)).alias(f"m{i}"))
    signed = hashed.groupBy("d1", "d2").agg(F.sum("head").alias("times"), *least)
    keys = [F.xxhash64(F.lit(b), *[f"m{b * rows + r}" for r in range(rows)]) for b in range(bands)]
    return stored(signed.select(F.monotonically_increasing_id().alias("id"), "d1", "d2", "times", F.array(*keys).alias("keys")), "line-keys")


def bitmaps(texts: DataFrame, size: int) -> DataFrame:
    """(id, many, w0, w1, ...): how many shingles each line has, and a bitmap in which each of them turns one bit over."""
    sets = texts.select("id", shingle_set(F.col("line"), size).alias("set")).withColumn("many", F.size("set"))
    each = sets.select("id", "many", "set", F.explode(F.sequence(F.lit(1), "many", F.lit(2))).alias("at"))
    each = each.select("id", "many", F.expr("element_at(set, at)").alias("h"), F.expr("if(at < many, element_at(set, at + 1), null)").alias("next"))
    for h in ("h", "next"):
        bit = F.expr(f"coalesce(shiftleft(1L, cast(shiftrightunsigned({h}, 32) & 63 as int)), 0L)")
        each = each.withColumns({f"{h}_word": F.expr(f"coalesce(cast({h} & {WORDS - 1} as int), 0)"), f"{h}_bit": bit})
    words = [F.bit_xor(F.expr(f"if(h_word = {i}, h_bit, 0L) ^ if(next_word = {i}, next_bit, 0L)")).alias(f"w{i}") for i in range(WORDS)]
    return stored(each.groupBy("id").agg(F.max("many").cast("bigint").alias("many"), *words), "line-bits")


def likely(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """(a, b, together): the pairs that may be linked by their bitmaps, and the sum of their numbers of shingles.

    A bit that differs stands for a shingle, at least, that only one of the two lines has. A link leaves (100 -
    percent) / (100 + percent) of the sum for these, and so for the difference of the numbers: no link is left out."""
    sides = [bits.select(F.col("id").alias(c), *[F.col(n).alias(f"{c}_{n}") for n in bits.columns if n != "id"]) for c in ("a", "b")]
    both = pairs.join(sides[0].hint("shuffle_hash"), "a").join(sides[1].hint("shuffle_hash"), "b").withColumn("together", F.col("a_many") + F.col("b_many"))
    differ = F.lit(0)
    for i in range(WORDS):
        differ = differ + F.bit_count(F.col(f"a_w{i}").bitwiseXOR(F.col(f"b_w{i}")))
    least = F.greatest(differ, F.abs(F.col("a_many") - F.col("b_many")))
    return both.filter((100 + percent) * least <= (100 - percent) * F.col("together")).select("a", "b", "together")


def linked(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of lines whose shingle sets have 100 * intersection >= percent * union; together is the sum of
    the sizes of both sets."""
    copies = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("copies"))
    dealt = pairs.join(copies, "a").withColumn("copy", F.pmod(F.xxhash64("b"), "copies").cast("int"))
    right = texts.select(F.col("id").alias("b"), F.col("line").alias("right"))
    left = texts.join(copies, texts["id"] == copies["a"]).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.col("line").alias("left")
    )
    both = dealt.select("a", "b", "together", "copy").join(right, "b").join(left, ["a", "copy"])
    common = F.size(F.array_intersect(shingles(F.col("left"), size), shingles(F.col("right"), size)))
    return stored(both.filter((100 + percent) * common >= percent * F.col("together")).select("a", "b"), "line-links")


def bucket_members(keyed: DataFrame) -> DataFrame:
    """(bucket, id, hub, many): the lines of each bucket that has several, and the one of them that occurs most often."""
    members = keyed.select("id", "times", F.explode("keys").alias("bucket")).repartition("bucket")
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("many"), F.max("times").alias("most"), F.min("id").alias("first"))
    members = members.join(shared.filter("many > 1").hint("shuffle_hash"), "bucket")
    often = F.min(F.when((F.col("times") > 1) & (F.col("times") == F.col("most")), F.col("id"))).over(Window.partitionBy("bucket"))
    return stored(members.select("bucket", "id", F.coalesce(often, "first").alias("hub"), "many"), "line-members")


def wanted_lines(keyed: DataFrame, members: DataFrame) -> DataFrame:
    """(id, d1, d2, times, inside): the lines that occur several times or share a bucket; inside is null if they share none."""
    inside = members.select("id").distinct().withColumn("inside", F.lit(True))
    wanted = keyed.select("id", "d1", "d2", "times").join(inside, "id", "left").filter("times > 1 or inside")
    return stored(wanted, "line-wanted")


def digest_cells(digests: DataFrame, depth: int) -> DataFrame:
    """(cell, words): a bitmap of the digests d1 in rows of 1,024 bits, of which 2^depth are enough for all."""
    bit = F.expr("shiftleft(1L, cast(shiftright(d1, 4) & 63 as int))")
    words = [F.bit_or(F.when(F.col("d1").bitwiseAND(F.lit(15)) == i, bit).otherwise(F.lit(0).cast("bigint"))) for i in range(16)]
    return digests.groupBy(cell_of(depth).alias("cell")).agg(F.array(*words).alias("words"))


def cell_of(depth: int) -> Column:
    return F.shiftrightunsigned("d1", 64 - depth)


def line_copies(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, line_no, id, times, line): the places of the wanted lines, and their texts if they share a bucket.

    Most text is in lines that share none. A bitmap of the digests of those that do, sent to all tasks, keeps nearly all
    other texts out of the shuffle. It has 16 bits or more for a digest, but 2^CELLS rows at most: beyond that it only lets
    more texts through."""
    inside = wanted.filter("inside").select("d1")
    depth = min(max(1, (inside.count() // 64).bit_length()), CELLS)
    cells = F.broadcast(digest_cells(inside, depth))
    places = lines_of(docs).withColumn("cell", cell_of(depth)).join(cells, "cell", "left")
    may = F.expr("coalesce(shiftright(element_at(words, cast(d1 & 15 as int) + 1), cast(shiftright(d1, 4) & 63 as int)) & 1 = 1, false)")
    places = places.select("doc_id", "line_no", "d1", "d2", F.when(may, F.col("line").cast("binary")).alias("line"))
    copies = places.join(wanted, ["d1", "d2"])
    return stored(copies.select("doc_id", "line_no", "id", "times", F.when(F.col("inside"), F.col("line")).alias("line")), "line-copies")


def alike_lines(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, component) of the different lines that are linked with another one.

    Each member of a bucket is compared with the line of the bucket that occurs most often; that is all there is to a
    bucket of two. Where a larger bucket is not one component then, lines of different components are compared: all of
    them, where the bucket has few members; else those outside the largest component with those of other components
    with which they share a shingle early enough in the order from rare to frequent, as any link needs. Before lines
    are compared in full, their bitmaps rule out what can not be linked."""
    bits = bitmaps(texts, size)

    pairs = members.filter("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    links = linked(stored(likely(pairs, bits, percent), "line-pairs"), texts, size, percent)
    groups = components(links, "a", "b")
    removed(links)

    opened = stored(open_members(members.filter("many > 2").select("bucket", F.col("id").alias("rep"), "many"), groups), "line-open")
    used = [bits, opened]
    few = opened.filter(F.col("many") <= FEW).select("bucket", "rep", "component")
    rest = few.alias("x").join(few.alias("y"), "bucket").filter("x.rep < y.rep and x.component != y.component")
    rest = rest.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
    rest = likely(rest, bits, percent)
    many = opened.filter(F.col("many") > FEW).drop("many")
    if not many.isEmpty():
        wanted = many.select(F.col("rep").alias("id")).distinct()
        sets = texts.join(wanted, "id", "left_semi").select("id", shingle_set(F.col("line"), size).alias("set"))
        sets = exploded(sets, "shingle").withColumnRenamed("id", "rep")
        partner = F.ceil(F.col("size") * percent / 100).alias("partner")
        placed = many.join(bits.select(F.col("id").alias("rep"), F.col("many").alias("size")), "rep").select("*", partner)
        used += [stored(placed, "line-open"), stored(sets, "line-shingles")]
        pairs = prefix_pairs(*used[-2:], percent)
        rest = rest.unionByName(likely(pairs, bits, percent)).distinct()
    rest = stored(rest, "line-pairs")
    if not rest.isEmpty():
        more = linked(rest, texts, size, percent)
        if not more.isEmpty():
            stars = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
            groups = components(stars.unionByName(more), "a", "b")
    removed(*used, rest)
    return groups.withColumnRenamed("node", "id")


def repeated_lines(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, seed: int = 1) -> DataFrame:
    """(doc_id, n_lines, n_kept, removed), one row per input row: how many lines the text has that are not empty, how
    many of them are kept, and the numbers of the others, from 0 and counting empty lines, in order.

    Two lines are linked where their sets of byte shingles have 100 * intersection >= percent * union; lines linked
    over others belong together. Of each such group the line with the smallest doc_id, and in it the smallest number,
    is kept. At the limit of similarity all bands miss a pair with a chance of 3 in 10,000. Links are confirmed on
    the full sets. The main path runs no Python in its tasks.

    Null and empty texts have no lines; empty lines are kept and in no group. Rows without doc_id keep all their
    lines. Rows that share a doc_id are read as one document each: of equal lines with the same number all are kept
    where the line is the first, and all removed where it is not. Other columns do not matter. Empty tables give no
    rows.
    """
    keyed = line_keys(docs, size, bands, rows, seed)
    members = bucket_members(keyed)
    wanted = wanted_lines(keyed, members)
    removed(keyed)
    copies = line_copies(docs, wanted)
    removed(wanted)
    texts = stored(copies.filter("line is not null").select("id", "line").dropDuplicates(["id"]), "line-texts")
    groups = alike_lines(members, texts, size, percent)
    removed(members, texts)
    places = copies.join(groups, "id", "left").filter("times > 1 or component is not null")
    places = stored(places.select("doc_id", "line_no", F.coalesce("component", "id").alias("line_group")), "line-places")
    removed(copies)
    firsts = places.groupBy("line_group").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
    gone = places.join(firsts, "line_group").filter("doc_id != first.doc_id or line_no != first.line_no")
    gone = gone.groupBy("doc_id").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))
    some = F.array_remove(parted("text"), "")
    rows_in = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.size(some), F.lit(0)).cast("bigint").alias("n_lines"))
    rows_in = rows_in.withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    out = rows_in.join(gone, "doc_id", "left").withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))
    return out.select("doc_id", "n_lines", (F.col("n_lines") - F.size("removed")).alias("n_kept"), "removed")


def without_repeated_lines(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs, with all their columns, and text without the lines that repeated_lines() removes."""
    gone = repeated_lines(docs, **settings).filter("size(removed) > 0").select(F.col("doc_id").alias("_id"), F.col("removed").alias("_removed")).distinct()
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    rows = docs.select(row, F.col("doc_id").cast("bigint").alias("_doc")).join(gone, F.col("_doc") == F.col("_id"), "left")
    kept = F.filter(parted("_row.text"), lambda line, i: ~F.array_contains("_removed", i))
    text = F.when(F.col("_removed").isNull(), F.col("_row.text")).otherwise(F.array_join(kept, "\n"))
    return rows.select(*[(text if c == "text" else F.col("_row")[c]).alias(c) for c in docs.columns])
