"""Approximate nearest neighbours by inner product: inverted lists, scanned by adaptive dimensions.

Vectors are lengthened by one component so that the nearest by distance is the one with the largest inner product,
rotated at random, and kept in blocks of columns. Within a probed list the scan adds up squared distances block by
block; as components of rotated vectors are alike, the partial distance estimates the whole one, and a candidate is
abandoned as soon as a test says that it is farther than the query's present k-th, at a set error.

A query looks into its few nearest lists first. The k-th of what they give is the limit that it takes into its other lists,
which return only what lies within it; so what a query brings back does not grow with the number of lists.

Near lists share a group, as large as one task can hold. A query is sent once to each group that has lists of its own, with
their numbers, and a task streams the queries past the points of its group. So neither the rows sent nor the memory of a task
follow the number of lists that a query looks into.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from rowsmith.sources.shared import removed, stored

#: Vectors that the list centres are fitted on.
SAMPLE = 10_000
#: Vectors of the sample for each list at least; the most of a list's vectors, and of its queries, that a task compares at a
#: time; the components of vectors that a group holds at most; and the rows that are sent on at a time. There are as many lists as the root of the number of distinct vectors, as far as the sample allows.
PER_LIST = 10
CHUNK, SLICE = 2048, 128
ROOM = 4_000_000
SENT = 16_384
#: Part of the probed lists, the nearest, that a query looks into without a limit.
FIRST = 1 / 8
#: Columns in the first block and each later one, and the width of the test in standard deviations.
COLUMNS = 16
#: Part of the neighbours that probing must reach on a sample, and the sampled queries it is measured with.
SHARE, QUERIES = 0.95, 200
EPSILON = 2.1
ROUNDS = 8


def usable(vectors: Column) -> Column:
    """No null or non-finite component, and not all zero."""
    good = F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.isNotNull() & F.coalesce(good, F.lit(False)) & F.exists(vectors, lambda x: x != 0)


def centres(sample: np.ndarray, lists: int, seed: int) -> np.ndarray:
    """Centres of the lists by rounds of k-means on a sample."""
    rng = np.random.default_rng(seed)
    out = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        nearest = nearest_lists(sample, out, 1)[:, 0]
        order = np.argsort(nearest, kind="stable")
        own, first = np.unique(nearest[order], return_index=True)
        out = out.copy()
        out[own] = np.add.reduceat(sample[order], first, axis=0) / np.diff(np.append(first, len(order)))[:, None]
    return out


def nearest_lists(vectors: np.ndarray, middle: np.ndarray, probes: int) -> np.ndarray:
    """The probes nearest centres of each vector."""
    out = []
    for at in range(0, len(vectors), 4096):
        far = (middle**2).sum(axis=1) - 2 * vectors[at : at + 4096] @ middle.T
        out.append(far.argmin(axis=1)[:, None] if probes == 1 else np.argsort(far, axis=1, kind="stable")[:, :probes])
    return np.concatenate(out) if out else np.zeros((0, probes), np.int64)


def near_order(middle: np.ndarray) -> np.ndarray:
    """The numbers of the centres, near ones beside each other: halved again and again where they differ most."""
    order, ranges = np.arange(len(middle)), [(0, len(middle))]
    while ranges:
        first, end = ranges.pop()
        if end - first > 2:
            own = order[first:end]
            order[first:end] = own[np.argsort(middle[own, middle[own].var(axis=0).argmax()], kind="stable")]
            ranges += [(first, (first + end) // 2), ((first + end) // 2, end)]
    return order


def grouped(order: np.ndarray, sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The first group and the number of groups of each list, and the number of all groups. A list with more than room
    vectors is dealt over groups of its own; others share one while there is room."""
    base, parts, now, filled = np.zeros(len(sizes), np.int64), np.maximum(1, -(-sizes // room)), 0, 0
    for i in order:
        if filled and filled + sizes[i] > room:
            now, filled = now + 1, 0
        base[i], filled = now, filled + sizes[i]
        if parts[i] > 1:
            now, filled = now + parts[i], 0
    return base, parts, int(now + (filled > 0))


def probes_for(asked: np.ndarray, near: np.ndarray, middle: np.ndarray) -> int:
    """How many lists the queries must look into to find SHARE of their nearest, given the list of each of these."""
    order = nearest_lists(asked, middle, len(middle))
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(len(middle)), order.shape), axis=1)
    found = np.concatenate([place[q, lists] for q, lists in enumerate(near)])
    return int(np.quantile(found, SHARE, method="higher")) + 1 if len(found) else 1


def true_neighbours(listed: DataFrame, asked: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
    """The list of each of the k points, other than itself, with the largest inner product with each query, over all points.

    Each task keeps k points a query, so that what is ranked afterwards follows the number of tasks."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score, lists = np.full((len(asked), 0), -np.inf), np.zeros((len(asked), 0), np.int64)
        for pdf in batches:
            if len(pdf):
                fresh = asked @ np.stack(pdf["v"]).T.astype(float)
                self = names.get_indexer(pdf["p"])
                fresh[self[self >= 0], np.flatnonzero(self >= 0)] = -np.inf
                score = np.concatenate([score, fresh], axis=1)
                lists = np.concatenate([lists, np.broadcast_to(pdf["list"].to_numpy(), fresh.shape)], axis=1)
                best = np.argpartition(-score, min(k, score.shape[1]) - 1, axis=1)[:, :k]
                score, lists = np.take_along_axis(score, best, axis=1), np.take_along_axis(lists, best, axis=1)
        q = np.repeat(np.arange(len(asked)), score.shape[1])
        out = pd.DataFrame({"q": q, "list": lists.reshape(-1), "score": score.reshape(-1)})
        yield out[out["score"] > -np.inf]

    names = pd.Index(own)  # numbers of the queries
    found = listed.mapInPandas(task, "q int, list bigint, score double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "list"))
    best = found.withColumn("rank", rank).filter(F.col("rank") <= k).groupBy("q").agg(F.collect_list("list").alias("lists")).collect()
    near = {r["q"]: np.array(r["lists"], np.int64) for r in best}
    return [near.get(q, np.zeros(0, np.int64)) for q in range(len(asked))]


def rotation(size: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def scan(queries: np.ndarray, points: np.ndarray, k: int, limit: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) pairs that may be among the k nearest: for each query, the points whose distance was completed
    and is no larger than the k-th such distance, or, if it is given, than the limit. Both sides are rotated.

    Without a limit, the k points that are nearest so far are measured in full after each block; their farthest is the limit
    of the tests, as there are k points within it.
    """
    width, (many, size) = points.shape[1], (len(queries), len(points))
    k = min(k, size)
    partial = np.zeros((many, size))
    alive = np.ones((many, size), bool)
    given = limit is not None
    limit = limit if given else np.full(many, np.inf)
    for at in range(0, width, COLUMNS):
        stop = min(at + COLUMNS, width)
        q, p = queries[:, at:stop], points[:, at:stop]
        if at == 0 or alive.mean() > 0.2:
            step = (q**2).sum(axis=1)[:, None] - 2 * q @ p.T + (p**2).sum(axis=1)
            partial += step
        else:
            i, j = np.nonzero(alive)
            partial[i, j] += ((q[i] - p[j]) ** 2).sum(axis=1)
        if stop < width:
            if not given:
                here = np.where(alive, partial, np.inf)
                first = np.argpartition(here, k - 1, axis=1)[:, :k]
                limit = np.minimum(limit, ((queries[:, None] - points[first]) ** 2).sum(axis=2).max(axis=1))
            bound = limit * stop / width * (1 + EPSILON / np.sqrt(stop)) ** 2
        else:
            bound = limit if given else np.minimum(limit, np.partition(np.where(alive, partial, np.inf), k - 1, axis=1)[:, k - 1])
        alive &= partial <= bound[:, None] * (1 + 1e-9) + 1e-9
    return np.nonzero(alive)


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def best_of(q: np.ndarray, p: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query's points, those that fewer than k surpass."""
    order = np.lexsort((-score, q))
    q, p, score = q[order], p[order], score[order]
    _, first, many = np.unique(q, return_index=True, return_counts=True)
    keep = score >= np.repeat(score[first + np.minimum(many, k) - 1], many)
    return q[keep], p[keep], score[keep]


def search(
    vectors: DataFrame, k: int = 20, every: int = 20, probes: int | None = None, seed: int = 1, id_column: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by `every`, its k nearest others.

    Nearest is the largest inner product of the original vectors in double precision, ties to the smaller id. A query
    looks into its `probes` nearest lists; by default, as many as hold SHARE of the true neighbours, among all vectors, of
    QUERIES vectors. The lists' centres are fitted on at most SAMPLE distinct vectors, and those queries are not among
    these where there are enough others; every vector is in a list. Equal vectors are kept once, with their k + 1 smallest ids: no query can return more of
    them, so a vector that a third of all rows have is one point and, as a query, is searched once. A task holds a group of
    lists, or a part of a large one, of bounded size, and compares it with one slice of queries at a time.

    Rows with a null id, and vectors that are null, zero, or hold a null or non-finite component take no part. Vectors
    are compared with those of their own length. Repeated ids are rows of their own: a query's candidates are all rows but
    itself. Other columns do not matter. Without other candidates a query has no rows, and empty tables give none.
    """
    spark = vectors.sparkSession
    kind = "float" if isinstance(vectors.schema[column].dataType.elementType, FloatType) else "double"
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(column).cast(f"array<{kind}>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    widths = sorted(r["n"] for r in rows.groupBy(F.size("v").alias("n")).count().collect())
    digest = F.substring(F.unhex(F.sha2(F.array_join(F.col("v").cast("array<double>"), ","), 256)), 1, 16)
    parts = [_search(rows.filter(F.size("v") == width).withColumn("h", digest), width, kind, k, every, probes, seed) for width in widths]
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return reduce(DataFrame.unionByName, parts)


def _sample(point: DataFrame, many: int) -> np.ndarray:
    """The SAMPLE vectors with the smallest digests. Only about as many are put in order."""
    share = 1.2 * SAMPLE / many
    if SAMPLE >= 1000 and share < 1:
        few = point.filter(F.col("h") < F.lit(bytearray(int(share * 2**64).to_bytes(8, "big"))))
        rows = few.orderBy("h").select("v").limit(SAMPLE).collect()
        if len(rows) == SAMPLE:
            return np.array([r["v"] for r in rows])
    return np.array([r["v"] for r in point.orderBy("h").select("v").limit(SAMPLE).collect()])


def _search(rows: DataFrame, width: int, kind: str, k: int, every: int, probes: int, seed: int) -> DataFrame:
    spark = rows.sparkSession
    order = Window.partitionBy("h").orderBy("vec_id")
    first = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    point = first.groupBy("h").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("v").alias("v"))
    point = stored(point.select(F.monotonically_increasing_id().alias("p"), "h", "ids", "v"), "points")
    squares = F.aggregate(F.col("v").cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x)
    many, longest = point.agg(F.count(F.lit(1)), F.max(squares)).first()
    sample = _sample(point, many)
    turn = rotation(width + 1, seed)

    def lengthened(v: np.ndarray) -> np.ndarray:
        return np.concatenate([v, np.sqrt(np.maximum(longest - (v**2).sum(axis=1), 0))[:, None]], axis=1) @ turn

    def asked(v: np.ndarray) -> np.ndarray:
        """A query scaled to the length of the points: that leaves the order of its inner products."""
        scale = np.sqrt(longest) / np.sqrt((v**2).sum(axis=1))
        return np.concatenate([v * scale[:, None], np.zeros((len(v), 1))], axis=1) @ turn

    middle = centres(lengthened(sample), max(1, min(round(math.sqrt(many)), len(sample) // PER_LIST)), seed)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = nearest_lists(lengthened(matrix(batch.column("v"), width)), middle, 1)[:, 0]
                yield pa.RecordBatch.from_arrays([pa.array(lists.astype("i4")), batch.column("p"), batch.column("v")], ["list", "p", "v"])

    listed = stored(point.select("p", "v").mapInArrow(placed, f"list int, p bigint, v array<{kind}>"), "lists")
    tried = point.orderBy(F.desc("h")).select("p", "v").limit(QUERIES).toPandas()
    ids = stored(point.select("p", "h", "ids"), "ids")
    removed(point)
    if not probes:
        trial = np.stack(tried["v"]).astype(float)
        near = true_neighbours(listed, trial, tried["p"].to_numpy(), k)
        probes = probes_for(asked(trial), near, middle)

    # The queries' own vectors are read again: there are fewer of them than of points that would be shuffled for a join.
    wanted = rows.filter(F.col("vec_id") % every == 0).join(ids.select("h", "p"), "h")
    wanted = stored(wanted.select(F.col("vec_id").alias("query_id"), "p", "v"), "wanted")
    asking = wanted.groupBy("p").agg(F.first("v").alias("v")).withColumn("least", F.lit(None).cast("double"))
    asking = stored(asking, "queries")

    sizes = np.zeros(len(middle), np.int64)
    for r in listed.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    room = min(max(CHUNK, ROOM // width), max(CHUNK, -(-many // (3 * spark.sparkContext.defaultParallelism))))
    base, parts, groups = grouped(near_order(middle), sizes, room)
    places = spark.createDataFrame([(i, int(base[i]), int(parts[i])) for i in range(len(sizes))], "list int, base int, parts int")
    held = listed.join(F.broadcast(places), "list").withColumn("at", (F.col("base") + F.pmod(F.xxhash64("p"), "parts")).cast("int"))
    held = held.select("at", F.lit(0).alias("asks"), "p", "v", F.lit(None).cast("double").alias("least"), F.array("list").alias("lists"))
    names = held.columns
    fields = f"at int, asks int, p bigint, v array<{kind}>, least double, lists array<int>"

    def routed(first: int, last: int):
        """A row for each query and group that has some of its lists, from its first to its last nearest."""

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            size = max(1, min(4096, SENT // groups))
            for whole in batches:
                for start in range(0, whole.num_rows, size):
                    batch = whole.slice(start, size)
                    lists = nearest_lists(asked(matrix(batch.column("v"), width)), middle, last)[:, first:]
                    again = parts[lists.ravel()]
                    q = np.repeat(np.repeat(np.arange(len(lists)), lists.shape[1]), again)
                    own = np.repeat(lists.ravel(), again)
                    at = base[own] + np.arange(len(own)) - np.repeat(np.cumsum(again) - again, again)
                    order = np.lexsort((at, q))
                    q, own, at = q[order], own[order], at[order]
                    heads = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]) | (at[1:] != at[:-1])])
                    sent = batch.take(pa.array(q[heads]))
                    offsets = pa.array(np.append(heads, len(q)).astype("i4"))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at[heads].astype("i4")), pa.array(np.ones(len(heads), "i4")), sent.column("p"), sent.column("v"), sent.column("least"), pa.ListArray.from_arrays(offsets, pa.array(own.astype("i4")))],
                        names,
                    )

        return task

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of their groups, points before queries. The points of one group are held."""
        now, points = None, []
        for batch in batches:
            at, asks = batch.column("at").to_numpy(), batch.column("asks").to_numpy()
            heads = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (asks[1:] != asks[:-1])]) if len(at) else []
            for start, end in zip(heads, [*heads[1:], len(at)], strict=True):
                part = batch.slice(start, end - start)
                if at[start] != now:
                    now, points, group = at[start], [], None
                if not asks[start]:
                    points.append((part.column("lists").flatten().to_numpy(), part.column("p").to_numpy(), matrix(part.column("v"), width)))
                elif points:
                    if group is None:
                        lists, p, v = (np.concatenate(x) for x in zip(*points, strict=True))
                        by_list = np.argsort(lists, kind="stable")
                        lists, p, v = lists[by_list], p[by_list], v[by_list]
                        group, points = (lists, p, v, lengthened(v)), [None]
                    for at_row in range(0, part.num_rows, 8 * SLICE):
                        yield found_in(group, part.slice(at_row, 8 * SLICE))

    def found_in(group: tuple, queries: pa.RecordBatch) -> pa.RecordBatch:
        """(q, p, score): the points that may be among the nearest of queries, which have found a limit or have none."""
        lists, numbers, points, space = group
        v, least = matrix(queries.column("v"), width), queries.column("least").to_numpy(zero_copy_only=False).astype(float)
        near, own = asked(v), queries.column("lists")
        # Queries and points have the same length, so a score says a distance.
        limit = 2 * longest - 2 * least * np.sqrt(longest) / np.sqrt((v**2).sum(axis=1))
        asks = np.repeat(np.arange(len(v)), own.value_lengths().to_numpy())
        wanted = own.flatten().to_numpy()
        order = np.lexsort((asks, np.isnan(least[asks]), wanted))
        asks, wanted = asks[order], wanted[order]
        free = np.isnan(least[asks])
        heads = np.flatnonzero(np.r_[True, (wanted[1:] != wanted[:-1]) | (free[1:] != free[:-1])])
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for start, end in zip(heads, [*heads[1:], len(asks)], strict=True):
            first, last = np.searchsorted(lists, [wanted[start], wanted[start] + 1])
            for a in range(start, end, SLICE):
                some = asks[a : min(a + SLICE, end)]
                for c in range(first, last, CHUNK):
                    stop = min(c + CHUNK, last)
                    i, j = scan(near[some], space[c:stop], k + 1, None if free[start] else limit[some])
                    i, j = some[i], j + c
                    out.append((i, j, (v[i] * points[j]).sum(axis=1)))
        q, p, score = best_of(*(np.concatenate(x) for x in zip(*out, strict=True)), k + 1)
        return pa.RecordBatch.from_arrays([queries.column("p").take(pa.array(q)), pa.array(numbers[p]), pa.array(score)], ["q", "p", "score"])

    def looked(queries: DataFrame, first: int, last: int) -> DataFrame:
        """(q, p, score): what the queries find in the lists from their first to their last nearest."""
        both = held.unionByName(queries.select("p", "v", "least").mapInArrow(routed(first, last), fields))
        both = both.repartitionById(groups, "at").sortWithinPartitions("at", "asks")
        return stored(both.mapInArrow(compared, "q bigint, p bigint, score double"), "found")

    probes = min(probes, len(middle))
    nearest_few = max(1, round(probes * FIRST))
    found = looked(asking, 0, nearest_few)
    if probes > nearest_few:
        turn_of = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "p"))
        least = found.withColumn("n", turn_of).filter(F.col("n") == k + 1).select(F.col("q").alias("p"), F.col("score").alias("limit"))
        # Queries that have found too few have no limit yet.
        limited = stored(asking.join(least, "p", "left").select("p", "v", F.col("limit").alias("least")), "queries")
        found = found.unionByName(looked(limited, nearest_few, probes))
    removed(listed)
    # Each point has an id, so only points that fewer than k + 1 points surpass can matter.
    surpassed = F.rank().over(Window.partitionBy("q").orderBy(F.desc("score")))
    found = found.withColumn("surpassed", surpassed).filter(F.col("surpassed") <= k + 1).drop("surpassed")
    best = found.join(ids.select("p", F.explode("ids").alias("vec_id")), "p")
    nearest = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "p")
    best = best.withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= k + 1)
    lists = best.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "p"))).alias("found"))
    mine = wanted.select("query_id", F.col("p").alias("q")).join(lists, "q")
    own = F.array_position(F.transform("found", lambda x: (x["vec_id"] == F.col("query_id")) & (x["p"] == F.col("q"))), True)
    mine = mine.withColumn("own", own)
    others = F.slice(F.filter("found", lambda x, i: i + 1 != F.col("own")), 1, k)
    mine = mine.select("query_id", F.posexplode(others).alias("at", "x"))
    return mine.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
