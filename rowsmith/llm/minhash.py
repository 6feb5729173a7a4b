"""Circulant MinHash near-duplicate detection: signatures, banding, exact verification, components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm import words
from rowsmith.llm.components import components
from rowsmith.sources.shared import stored

UNIVERSE = 1 << 22
BLOCK = 1 << 14
#: Members of a bucket compared with one copy of its hub's set; larger groups get more copies.
GROUP = 256


@cache
def permutations(coordinates: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The two permutations. The second is continued by its own beginning, so that a shift is a slice."""
    rng = np.random.default_rng(seed)
    first = rng.permutation(UNIVERSE).astype(np.int32)
    second = rng.permutation(UNIVERSE).astype(np.int32)
    return first, np.concatenate([second, second[:coordinates]])


def signatures(values: np.ndarray, before: np.ndarray, coordinates: int, seed: int) -> np.ndarray:
    """Rows x coordinates; coordinate k is the least value of the second permutation, shifted by k places, over
    the row's elements as placed by the first. Rows without elements hold the largest integer."""
    first, second = permutations(coordinates, seed)
    shifts = np.lib.stride_tricks.sliding_window_view(second, coordinates)
    out = np.full((len(before) - 1, coordinates), np.iinfo(np.int32).max, np.int32)
    place = first[(values & np.uint64(UNIVERSE - 1)).astype(np.int64)]
    row = np.repeat(np.arange(len(before) - 1), np.diff(before))
    for at in range(0, len(place), BLOCK):
        mine = row[at : at + BLOCK]
        begins = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        least = np.minimum.reduceat(shifts[place[at : at + BLOCK]], begins, axis=0)
        out[mine[begins]] = np.minimum(out[mine[begins]], least)
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of that many coordinates."""
    bands = signature.shape[1] // rows
    parts = signature[:, : bands * rows].reshape(len(signature), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(rows):
        key = words.mix(key * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, i])
    return key.view(np.int64)


def shingle_sets(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text of the batch, and the number before each."""
    data, offsets = words.texts_of(batch.column("text"))
    return words.distinct(*words.shingle_hashes(*words.word_hashes(data, offsets), n))


def sketches(docs: DataFrame, n: int, bands: int, rows: int, seed: int) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands): size and 128-bit digest of each set, and its band keys."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in words.slices(whole):
                values, before = shingle_sets(batch, n)
                sizes = np.diff(before)
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(words.mix(values ^ np.uint64(salt)))]) for salt in (seed + 1, seed + 2)]
                digests = [(s[before[1:]] - s[before[:-1]]).view(np.int64) for s in sums]
                keys = band_keys(signatures(values, before, bands * rows, seed), rows)
                keys = keys[sizes > 0].reshape(-1)
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes.astype(np.int64)), *map(pa.array, digests), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys))],
                    ["doc_id", "n_shingles", "d1", "d2", "bands"],
                )

    rows_in = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows_in.mapInArrow(task, "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>")


def set_table(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """(doc_id, members): the sorted 64-bit shingles, as bytes, of the documents named by ids."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in words.slices(whole):
                values, before = shingle_sets(batch, n)
                sets = [values[a:b].tobytes() for a, b in zip(before, before[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "members"])

    rows_in = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows_in.join(ids, "doc_id", "left_semi").mapInArrow(task, "doc_id bigint, members binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union.

    A set that many others are compared with is copied to as many tasks as its comparisons need.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    copies = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("copies"))
    dealt = pairs.join(copies, "a").withColumn("copy", F.pmod(F.xxhash64("b"), "copies").cast("int"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("members").alias("right"))
    left = sets.join(copies, sets["doc_id"] == copies["a"]).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.col("members").alias("left")
    )
    both = dealt.select("a", "b", "copy").join(right, "b").join(left, ["a", "copy"])
    return stored(both.select("a", "b", "left", "right").mapInArrow(task, "a bigint, b bigint"), "links")


def shingles(sets: DataFrame) -> DataFrame:
    """(rep, shingle): one row for each member of each set."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in words.slices(whole, "members"):
                many = pc.divide(pc.binary_length(batch.column("members")), 8)
                _, offsets, data = batch.column("members").buffers()
                at = np.frombuffer(offsets, np.int32)[batch.column("members").offset :][: batch.num_rows + 1]
                values = np.frombuffer(data, np.int64, (at[-1] - at[0]) // 8, int(at[0]))
                rep = np.repeat(batch.column("doc_id").to_numpy(), many.to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(values)], ["rep", "shingle"])

    return sets.mapInArrow(task, "rep bigint, shingle bigint")


def shared_sizes(sets: DataFrame) -> DataFrame:
    """(rep, shared): how many shingles of each set some other of these sets has too."""
    alone = shingles(sets).groupBy("shingle").agg(F.count(F.lit(1)).alias("docs"), F.min("rep").alias("rep")).filter("docs = 1")
    sizes = sets.select(F.col("doc_id").alias("rep"), (F.length("members") / 8).cast("bigint").alias("size"))
    return sizes.join(alone.groupBy("rep").count(), "rep", "left").select("rep", (F.col("size") - F.coalesce("count", F.lit(0))).alias("shared"))


def prefix_pairs(placed: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """From members (rep, shingle) of the placed sets: pairs (a, b) of different components that may be linked, one of them outside its bucket's largest component.

    Shingles are ordered from rare to frequent among these sets. Two sets with the overlap that a link needs have a
    shingle in common that is so early in both that enough others follow; only such pairs are given. Shingles that
    one set alone has count in the order but are not looked up.
    """
    docs = placed.groupBy("rep", "size", "component").agg(F.min("partner").alias("partner"), F.max(F.col("component") != F.col("main")).alias("other"))
    common = members.groupBy("shingle").agg(F.count(F.lit(1)).alias("docs")).filter("docs > 1")
    own = Window.partitionBy("rep")
    rows = members.join(common, "shingle").join(docs, "rep")
    rank = F.row_number().over(own.orderBy("docs", "shingle")) - 1 + F.col("size") - F.count(F.lit(1)).over(own)
    needed = F.ceil(percent * (F.col("size") + F.col("partner")) / (100 + percent))
    rows = rows.withColumn("place", rank).filter(F.col("place") <= F.col("size") - needed)
    rows = stored(rows.select("shingle", "rep", "size", "component", "other", "place"), "prefixes")
    pairs = rows.filter("other").alias("x").join(rows.alias("y"), "shingle")
    after = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    enough = (100 + percent) * after >= percent * (F.col("x.size") + F.col("y.size"))
    pairs = pairs.filter((F.col("x.component") != F.col("y.component")) & enough)
    return pairs.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()


def near_duplicates(docs: DataFrame, n: int = 4, percent: int = 80, bands: int = 26, rows: int = 4, seed: int = 1) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Sets are the distinct runs of n lower-cased words. Documents are linked where 100 * intersection >= percent *
    union; component_id is the smallest doc_id reachable over links, kept marks the document that has it.

    Signatures only propose pairs (a pair at the limit is missed by all bands with a chance of about 1e-6);
    every link is confirmed on the full sets. Equal sets form a class, of which only the smallest doc_id goes on.
    No bucket is expanded into its pairs; what can change the components is compared in three rounds:

    1. every member of a bucket with the smallest doc_id in it;
    2. where a bucket is not one component then, its members with the one that has the fewest shingles of its own,
       such as the text that the others were edited from;
    3. where it still is not, its members outside the largest component with those members of other components with
       which they share a shingle early enough in the order from rare to frequent, as any link needs.

    From round 2 on, a set's shingles that no other set of an open bucket has are known to be in no intersection.
    That leaves out, exactly, members that can have no link at all.

    Null and empty texts, and texts without words, have no shingles, are linked with nothing and are kept. Rows
    without doc_id are kept too and linked with nothing; their component_id is null. Rows that share a doc_id
    are one document with several texts, and kept or not together. Other columns of docs do not matter. Empty
    tables give no rows.
    """
    found = stored(sketches(docs, n, bands, rows, seed), "sketches")
    filled = found.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    key = ["d1", "d2", "n_shingles"]
    classes = stored(filled.groupBy(key).agg(F.min("doc_id").alias("rep")), "classes")
    heads = filled.join(classes.withColumnRenamed("rep", "doc_id"), [*key, "doc_id"], "left_semi").dropDuplicates([*key, "doc_id"])
    members = heads.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("size"), F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("many"), F.min("rep").alias("hub")).filter("many > 1")
    members = stored(members.join(shared.select("bucket", "hub"), "bucket"), "members")
    sets = stored(set_table(docs, members.select(F.col("rep").alias("doc_id")).distinct(), n), "sets")

    def may_link(common, x, y):
        return (100 + percent) * common >= percent * (x + y)

    sizes = members.select(F.col("rep").alias("hub"), F.col("size").alias("hub_size")).distinct()
    stars = members.filter("rep != hub").select("hub", "rep", "size").distinct().join(sizes, "hub")
    stars = stars.filter(may_link(F.least("size", "hub_size"), F.col("size"), F.col("hub_size")))
    again = filled.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    same = filled.join(again, "doc_id", "left_semi").join(classes, key).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    links = verified(stored(stars.select(F.col("hub").alias("a"), F.col("rep").alias("b")), "pairs"), sets, percent).unionByName(same)
    groups = components(links, "a", "b")

    open_ = stored(open_members(members.select("bucket", "rep", "size"), groups), "open")
    open_sets = sets.join(open_.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    live = stored(open_.drop("component", "main").join(shared_sizes(open_sets), "rep"), "live")
    least = live.groupBy("bucket").agg(F.min("size").alias("least"))
    partner = F.greatest("least", F.ceil(F.col("size") * percent / 100))
    live = live.join(least, "bucket").withColumn("partner", partner)
    live = live.filter(may_link(F.col("shared"), F.col("size"), F.col("partner"))).drop("least")
    live = stored(live, "live")

    for step in (2, 3):
        placed = stored(open_members(live, groups), "open")
        if step == 2:
            own = F.struct((F.col("size") - F.col("shared")).alias("own"), "rep")
            first = placed.groupBy("bucket").agg(F.min(own)["rep"].alias("rep"))
            pairs = placed.join(first, ["bucket", "rep"], "left_semi").alias("x").join(placed.alias("y"), "bucket")
            fits = may_link(F.least("x.shared", "y.shared"), F.col("x.size"), F.col("y.size"))
            pairs = pairs.filter((F.col("x.component") != F.col("y.component")) & fits)
            pairs = pairs.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
        else:
            own = sets.join(placed.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
            pairs = prefix_pairs(placed, shingles(own), percent)
        pairs = stored(pairs, "pairs")
        if not pairs.isEmpty():
            more = verified(pairs, sets, percent)
            if not more.isEmpty():
                links = links.unionByName(more)
                groups = components(links, "a", "b")

    reps = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    reps = reps.select(*[F.col(k).alias(f"_{k}") for k in key], F.coalesce("component", "rep").alias("component_id"))
    same_set = F.col("doc_id").isNotNull()
    for k in key:
        same_set = same_set & (F.col(k) == F.col(f"_{k}"))
    component = F.coalesce("component_id", "doc_id")
    return found.join(reps, same_set, "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def open_members(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members of the buckets that are more than one component, with component and the bucket's largest one."""
    placed = members.join(groups.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    parts = placed.groupBy("bucket", "component").count()
    largest = F.max(F.struct("count", "component"))["component"]
    main = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("many"), largest.alias("main")).filter("many > 1")
    return placed.join(main.select("bucket", "main"), "bucket")


def without_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, with all their columns, whose document near_duplicates() keeps."""
    gone = near_duplicates(docs, n, percent).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("bigint") == gone["_gone"], "left_anti")
