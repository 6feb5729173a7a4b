"""Document fingerprints by winnowing, in DataFrame operations only.

Every run of K characters has a rolling hash: CRC-32, the remainder of its bits, as a polynomial over GF(2), by one of
degree 32. Of every WINDOW consecutive runs the least hash is chosen, the rightmost among equals, with its place. So two
texts that share a stretch of K + WINDOW - 1 characters share a chosen hash of that stretch, and nothing shorter than K
characters is ever matched.

A piece of text is laid out with four bytes to the character, so that a run is cut out in constant time; the minima of
windows are found by doubling, in log2(WINDOW) passes over an array. Texts are read in pieces of PIECE runs, which overlap by
a window, so memory beyond the text itself follows a piece. A text that changes from some character on is fingerprinted
anew from there only.

A null text is read as empty; an empty text has no hash, a text under K characters one of all its characters, and a text
of fewer than WINDOW runs one choice among all of them. Two empty fingerprints are alike, an empty and another are not.
Repeated rows are rows of their own, extra columns do not matter, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of a run and runs of a window, powers of two.
K, WINDOW = 16, 64
#: Runs of a piece.
PIECE = 4096
#: A chosen run is one whole number: hash * 2^31 + (2^31 - 1 - place), so that the least is the rightmost of the least hashes.
LAST = (1 << 31) - 1
#: Documents of a range whose next ones are looked up together, and ranges at most.
RANGE, RANGES = 2000, 4096


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def least_of(keys: Column, window: int) -> Column:
    """The least of each entry and the window - 1 entries after it, or of fewer near the end."""

    def longer(half: int) -> Callable[[Column], Column]:
        after = lambda a: F.slice(a, half + 1, F.greatest(F.size(a) - half, F.lit(0)))
        return lambda a: F.zip_with(a, after(a), lambda x, y: F.least(x, y))

    for level in range(window.bit_length() - 1):
        keys = once(keys, longer(1 << level))
    return keys


def chosen(piece: Column, first: Column, k: int, window: int) -> Column:
    """The choices of all windows of a piece, not empty, whose first character has the given place, in order of place."""
    runs = F.greatest(F.char_length(piece) - (k - 1), F.lit(1))
    places = F.sequence(F.lit(0), runs - 1)
    key = lambda laid, at: F.crc32(F.substring(laid, at * 4 + 1, F.lit(4 * k))) * (1 << 31) + (F.lit(LAST) - first - at)
    keys = once(F.encode(piece, "UTF-32"), lambda laid: F.transform(places, lambda at: key(laid, at)))
    return F.array_distinct(F.slice(least_of(keys, window), 1, F.greatest(runs - (window - 1), F.lit(1))))


def fingerprint(text: Column, k: int = K, window: int = WINDOW, piece: int = PIECE, start: Column | None = None) -> Column:
    """The chosen runs of a text in order of place, counted from `start` (0 if none). Use `hash_of` and `place_of` on them."""
    start = F.lit(0).cast("bigint") if start is None else start.cast("bigint")
    reach = piece + k + window - 2
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?s)(?=(.{{1,{reach}}})).{{1,{piece}}}"), F.lit(1))
    whole = lambda p, i: (i == 0) | (F.char_length(p) >= k + window - 1)
    found = F.transform(F.filter(pieces, whole), lambda p, i: chosen(p, start + i.cast("bigint") * piece, k, window))
    return F.array_distinct(F.flatten(found))


def continued(runs: Column, same: Column, text: Column, k: int = K, window: int = WINDOW, piece: int = PIECE) -> Column:
    """The fingerprint of a text whose first `same` characters are those of another text with the fingerprint `runs`.

    Choices of windows that lie within those characters stay. A chosen run is first chosen by the window it comes into, if
    it is less than the choice before it, else by the one that this choice has left."""
    kept = F.greatest(same - (k + window - 2), F.lit(0))

    def stays(run: Column, i: Column) -> Column:
        before = F.get(runs, i - 1)
        entered = F.when(run < before, place_of(run) - (window - 1)).otherwise(place_of(before) + 1)
        return F.when(i == 0, F.lit(0)).otherwise(entered) < kept

    rest = fingerprint(text.substr(kept + 1, F.char_length(text)), k, window, piece, kept)
    over = (kept > 0) & (F.char_length(text) - kept < k + window - 1)
    return F.array_distinct(F.concat(F.filter(runs, stays), F.when(~over, rest).otherwise(F.array().cast("array<bigint>"))))


def hash_of(run: Column) -> Column:
    return F.shiftright(run, 31)


def place_of(run: Column) -> Column:
    return F.lit(LAST) - run.bitwiseAND(LAST)


def likeness(a: Column, b: Column) -> Column:
    """Different hashes in both by different hashes in either."""
    a, b = F.transform(a, hash_of), F.transform(b, hash_of)
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def written(runs: Column) -> Column:
    """A fingerprint as text: hash@place of each chosen run."""
    return F.array_join(F.transform(runs, lambda r: F.concat_ws("@", hash_of(r).cast("string"), place_of(r).cast("string"))), " ")


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_chars, runs): the fingerprint of each row's text, an array of (hash, place) in order of place."""
    runs = F.transform(fingerprint(F.col("text"), k, window), lambda r: F.struct(hash_of(r).alias("hash"), place_of(r).alias("place")))
    return docs.select("doc_id", F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint").alias("n_chars"), runs.alias("runs"))


def beside_next(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The rows with a struct `next`: the columns of the row with the next smaller key, for the last row those of the first.

    Rows are dealt once, by ranges that begin at keys approximate percentiles found in the table. A row that begins a
    range is copied to the range before it, so no second pass over the edges is needed. Null is the smallest key. Rows of one key
    are ordered by the hash of the columns and lie in one range."""
    order = F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63)))
    many = min(max(-(-rows.count() // RANGE), 1), RANGES)
    shares = ",".join(str(i / many) for i in range(1, many + 1))
    found = rows.select(order.alias("key")).selectExpr(f"approx_percentile(key, array({shares}), {10 * RANGES}) AS at", "max(key) AS top").first()
    starts = sorted({*(found.at or []), *([found.top] if found.top is not None else [])})
    edges = F.lit(starts).cast("array<bigint>")
    own = F.size(F.filter(edges, lambda e: e >= order))
    before = F.when(own == 1, F.lit(len(starts))).otherwise(own - 1)
    place = lambda part, guest: F.struct(part.alias("part"), F.lit(guest).alias("guest"))
    places = F.when(F.array_contains(edges, order), F.array(place(own, False), place(before, True))).otherwise(F.array(place(own, False)))
    dealt = rows.select("*", order.alias("_order"), F.xxhash64(*columns).alias("_tie"), F.inline(places))
    turn = Window.partitionBy("part").orderBy("guest", F.desc("_order"), F.desc_nulls_last(key), "_tie")
    following = dealt.withColumn("next", F.lead(F.struct(*columns)).over(turn))
    return following.filter("NOT guest").select(*rows.columns, "next")


def edited(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """A trial of the fingerprints: (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The last third of each text is replaced by as many characters of the next document's beginning, in descending order of
    doc_id. near_edited is the likeness of the fingerprints before and after, near_next that to the next document's."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("runs", fingerprint(F.col("text"), k, window))
    rows = beside_next(rows, "doc_id", ["text", "runs"])
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    changed = F.concat(F.col("text").substr(F.lit(1), n - cut), F.col("next.text").substr(F.lit(1), cut))
    rows = rows.select("doc_id", n.cast("bigint").alias("n_chars"), (n - cut).alias("same"), "runs", F.col("next.runs").alias("others"), changed.alias("edited"))
    after = continued(F.col("runs"), F.col("same"), F.col("edited"), k, window)
    rows = rows.select("*", F.inline(F.array(F.struct(after.alias("after")))))
    near = {"near_edited": likeness(F.col("runs"), F.col("after")), "near_next": likeness(F.col("runs"), F.col("others"))}
    texts = {"fingerprint": written(F.col("runs")), "edited_fingerprint": written(F.col("after"))}
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *[c.alias(name) for name, c in (texts | near).items()])
