"""Whole jobs that a smaller one could pass for: training order, leaks beside many copies, recall on overfitted lists."""

import bisect

import numpy as np

import corpus_pipeline
from rowsmith.llm import mixing, registry
from rowsmith.sources.shared import stored


def words_given(schedule, time):
    """Part of a source's words that it has given by then, by adding up thin slices of its schedule."""
    at = (np.arange(200_000) + 0.5) / 200_000
    weight = np.interp(at, np.linspace(0, 1, len(schedule)), schedule)
    return weight[at < time].sum() / weight.sum()


def test_op10_gives_every_copy_its_position_and_place(spark, small):
    found = registry.QUERIES["op10_curriculum"](spark, small).collect()
    counts = {r.doc_id: r.copies for r in registry.QUERIES["op10_mixing"](spark, small).collect()}
    goals = {r.doc_id: (r.turn, r.before, r.source_size, r.target) for r in mixing.assignments(registry.documents(spark, small)).collect()}
    assert sorted((r.doc_id, r.copy) for r in found) == sorted((i, c) for i, n in counts.items() for c in range(n))
    found.sort(key=lambda r: r.place)
    assert [r.place for r in found] == list(range(len(found)))
    assert [r.position for r in found] == sorted(r.position for r in found)
    for r in found:
        turn, before, size, target = goals[r.doc_id]
        middle = (r.copy * size + before + r.size / 2) / target
        assert abs(words_given(mixing.SCHEDULES[turn % 3], r.position) - middle) < 1e-4
    level = mixing.order_of(registry.documents(spark, small), schedules=((1.0, 1.0),)).collect()
    assert {(r.doc_id, r.copy): r.position for r in level} != {(r.doc_id, r.copy): r.position for r in found}


def test_op10_counts_rows_that_are_equal(spark):
    docs = spark.createDataFrame([(1, "", "a"), (1, "", "a"), (1, "a b", "a"), (1, "a b", "a"), (None, None, None)], "doc_id bigint, text string, source string")
    assert sorted(map(str, mixing.totals(docs).collect())) == sorted(map(str, mixing.assignments(docs).select("doc_id", "size", "source_size", "target", "taken", "copies").collect()))


def test_token_files_follow_the_curriculum(spark, small):
    docs = registry.documents(spark, small)
    order = [r.doc_id for r in mixing.curriculum(docs).select("doc_id").collect()]
    assert order != sorted(order)
    mixed = corpus_pipeline.mixed(spark, docs, small)
    for rows in (stored(mixed, "mixed"), mixed):
        found = sorted(corpus_pipeline.encoded(spark, rows, small).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in found] == order
        assert bisect.bisect([r.start for r in found], 0) == 1


def test_equal_edited_copies_do_not_hide_each_other(spark):
    from rowsmith.llm import decontaminate

    rng = np.random.default_rng(2)
    vocabulary = [f"w{n}" for n in range(400)]
    exact = rng.choice(vocabulary, 40, replace=False)
    edited = [("changed" if n % 4 == 3 else w) for n, w in enumerate(exact)]
    for many in (5, 300):
        docs = [(i, " ".join([*rng.choice(vocabulary, 40), *edited, *rng.choice(vocabulary, 40)])) for i in range(many)] + [(9000, " ".join(exact))]
        frame = spark.createDataFrame(docs, "doc_id bigint, text string")
        items = spark.createDataFrame([(1, " ".join(exact))], "item_id bigint, text string")
        found = {r.doc_id: r.score for r in decontaminate.contaminated(frame, items).collect()}
        assert set(found) == {i for i, _ in docs} and found[0] >= 0.625 and found[9000] == 1.0
        assert decontaminate.decontaminated(frame, items).count() == 0


def test_neighbours_reach_the_recall_with_as_many_lists_as_sampled_points(spark, monkeypatch):
    from rowsmith.llm import neighbours

    monkeypatch.setattr(neighbours, "SAMPLE", 70)
    monkeypatch.setattr(neighbours, "PER_LIST", 1)
    matrix = np.random.default_rng(3).normal(size=(6000, 24))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id bigint, embedding array<double>")
    hits, asked = 0, range(0, 6000, 20)
    found = {q: set() for q in asked}
    for r in neighbours.search(table).collect():
        found[r.query_id].add(r.vec_id)
    for q in asked:
        score = matrix @ matrix[q]
        score[q] = -np.inf
        hits += len(set(np.argsort(-score)[:20].tolist()) & found[q])
    assert hits >= 0.9 * 20 * len(asked)


def test_passages_of_short_lines_are_found_whole(spark):
    from rowsmith.llm import substrings

    rng = np.random.default_rng(4)
    own = lambda: " ".join(f"u{n}" for n in rng.integers(0, 10**9, 30)) + "."
    verse = "\n".join(" ".join(f"v{4 * n + i}" for i in range(4)) for n in range(12))
    mixed = "\n".join(" ".join(f"m{20 * n + i}" for i in range(size)) for n, size in enumerate((12, 2, 3, 11, 8, 4, 3)))
    docs = [(i, f"{own()}\n{passage}\n{own()}") for i, passage in enumerate([verse, mixed] * 10)]
    found = substrings.without_repeats(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.n_removed for r in found} == {i: 0 if i < 2 else (12, 7)[i % 2] for i in range(20)}
    for r in found:
        kept = docs[r.doc_id][1].split("\n")
        assert r.text.split("\n") == (kept if r.doc_id < 2 else [kept[0], kept[-1]])


def test_neighbours_of_repeated_ids_and_other_lengths(spark):
    """A row is no candidate of itself, but rows with its id are; vectors meet those of their own length."""
    from rowsmith.llm import neighbours

    rng = np.random.default_rng(5)
    rows = [(i % 45, rng.integers(-4, 5, 3 + (i % 9 == 0)).astype(float).tolist()) for i in range(180)]
    rows += [(20, [1.0, 2.0, 3.0])] * 3 + [(40, [2.0, 0.0, 0.0])] * 30
    rows = [(i, v) for i, v in rows if any(v)]
    found = neighbours.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), k=6, probes=99).collect()
    want = []
    for at, (query, v) in enumerate(rows):
        if query % 20 == 0:
            others = sorted((-float(np.dot(v, w)), i) for n, (i, w) in enumerate(rows) if n != at and len(w) == len(v))[:6]
            want += [(query, place + 1, i, -score) for place, (score, i) in enumerate(others)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == sorted(want)
