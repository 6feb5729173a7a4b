"""Queries of op5_neighbours are streamed past groups of lists."""

import numpy as np
import pytest

from rowsmith.llm import neighbours


def table_of(spark, vectors):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")


def test_what_is_sent_does_not_follow_the_lists(spark, monkeypatch):
    """A row for each query and list, with the query's vector in each, filled tasks and disks."""
    sizes, stored = {}, neighbours.stored

    def counted(df, name):
        table = stored(df, name)
        sizes[name] = max(sizes.get(name, 0), table.count())
        return table

    monkeypatch.setattr(neighbours, "stored", counted)
    table = table_of(spark, np.random.default_rng(1).normal(size=(3000, 16)))
    assert neighbours.search(table, k=5, probes=50).count() == 150 * 5
    assert max(sizes.values()) <= 3000, sizes


@pytest.mark.parametrize(("room", "chunk"), [(4_000_000, 2048), (400, 16)])
def test_groups_and_parts_of_lists_give_all_neighbours(spark, monkeypatch, room, chunk):
    """One list has a third of all vectors, more than a group holds."""
    monkeypatch.setattr(neighbours, "ROOM", room, raising=False)
    monkeypatch.setattr(neighbours, "CHUNK", chunk)
    monkeypatch.setattr(neighbours, "EPSILON", 1e9)
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(600, 8))
    vectors[::3] = vectors[0] + rng.normal(size=(200, 8)) / 100
    found = {}
    for r in neighbours.search(table_of(spark, vectors), k=6, probes=99).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    score = vectors @ vectors.T
    np.fill_diagonal(score, -np.inf)
    want = {q: [(n + 1, int(i)) for n, i in enumerate(np.argsort(-score[q], kind="stable")[:6])] for q in range(0, 600, 20)}
    assert {q: sorted(x) for q, x in found.items()} == want


def test_large_lists_have_groups_of_their_own():
    sizes = np.array([5, 45, 0, 7, 8, 10])
    base, parts, groups = neighbours.grouped(np.array([0, 1, 2, 3, 4, 5]), sizes, 10)
    assert base.tolist() == [0, 1, 6, 6, 7, 8] and parts.tolist() == [1, 5, 1, 1, 1, 1] and groups == 9
    centres = np.array([[9.0, 0], [0, 0], [9, 1], [0, 1]])
    assert sorted(map(sorted, np.split(neighbours.near_order(centres), 2))) == [[0, 2], [1, 3]]
