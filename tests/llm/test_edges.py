"""Every operator and stage on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import public_tokenizers
import pytest

import corpus_pipeline
from rowsmith.llm import decontaminate, licenses, lines, minhash, mixing, neighbours, quality, substrings, tokens, toxicity
from rowsmith.sources.shared import new_path

LONG = "Alpha beta gamma. " * 3000 + "x" * 70_000
ROWS = [
    (1, "one two three four five six. Seven eight nine ten eleven twelve!", "a", 1),
    (1, "one two three four five six. Seven eight nine ten eleven twelve!", "a", 1),
    (2, None, "b", 2),
    (3, "", None, None),
    (4, "  \n\t ", "b", None),
    (None, "one two three four five six. Seven eight nine ten eleven twelve!", None, 3),
    (5, LONG, "a", 4),
    (6, LONG, "a", 4),
    (7, "idiot", "c", 5),
]
CLASHING = "doc_id bigint, text string, source string, rep int"


@pytest.fixture(scope="module")
def docs(spark):
    table = spark.createDataFrame(ROWS, CLASHING)
    clashing = ("bucket", "hub", "size", "score", "_key", "_gone", "before", "part", "lang")
    return table.select("*", *[table["rep"].alias(c) for c in clashing])


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (7, 0, 1), (2, None, None), (None, 1, 1), (7, 0, 1), (99, 1, 1), (6, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "six seven eight nine ten eleven"), (2, None), (None, "one two three"), (3, ""), (4, "one"), (1, "six seven eight nine ten eleven")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def results(docs, labels, items):
    path = new_path(docs.sparkSession, "tokens")
    tokens.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return {
        "minhash": minhash.near_duplicates(docs),
        "lines": lines.repeated_lines(docs),
        "substrings": substrings.without_repeats(docs),
        "quality": quality.scores(docs, labels),
        "tokens": tokens.read_tokens(docs.sparkSession, path),
        "licenses": licenses.scans(docs),
        "toxicity": toxicity.scores(docs, labels),
        "mixing": mixing.assignments(docs),
    }


def test_one_row_for_each_input_row(docs, labels, items):
    for name, found in results(docs, labels, items).items():
        rows = found.collect()
        assert len(rows) == len(ROWS), name
        assert sorted((r.doc_id for r in rows), key=str) == sorted((r[0] for r in ROWS), key=str), name
    placed = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert placed[1, 9] == (1, True) and placed[2, 0] == (2, True) and placed[None, 9] == (None, True)
    assert [v for k, v in placed.items() if k[0] in (5, 6)] == [(5, True), (5, False)] or placed[6, [k[1] for k in placed if k[0] == 6][0]] == (5, False)


def test_leaks(docs, items):
    found = decontaminate.contaminated(docs, items).collect()
    assert sorted((str(r.doc_id), r.item_id, r.score) for r in found) == [("1", 1, 1.0), ("1", 1, 1.0), ("None", 1, 1.0)]
    assert (found[0].first_word, found[0].last_word) == (5, 10)
    assert sorted(str(r.doc_id) for r in decontaminate.decontaminated(docs, items).collect()) == ["2", "3", "4", "5", "6", "7"]


def test_empty_tables(docs, labels, items):
    empty = docs.limit(0)
    for name, found in results(empty, labels, items).items():
        assert found.count() == 0, name
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.decontaminated(docs, items.limit(0)).count() == len(ROWS)
    assert {r.score for r in toxicity.scores(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in quality.scores(docs, labels.limit(0)).collect()} == {0.5}


def test_stages_keep_the_columns(spark, docs, labels, items, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, str(tmp_path))
            assert out.columns == docs.columns, name
            assert out.count() <= 3 * len(ROWS), name
    assert lines.without_repeated_lines(docs).columns == docs.columns


def test_mixing_takes_each_copy_once(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 7), ["a", "b", None][i % 3], 0) for i in range(60)], CLASHING)
    rows = mixing.assignments(docs).collect()
    for source in ("a", "b", None):
        mine = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 6
        assert all(r.taken <= 3 * r.size for r in mine)
    order = mixing.curriculum(docs).collect()
    assert len(order) == sum(r.copies for r in rows)
    assert [r.doc_id for r in order] == [r.doc_id for r in mixing.curriculum(docs.repartition(5)).collect()]


def test_neighbours_of_odd_vectors(spark):
    good = [(i, [float(i % 5), 1.0, float(i % 3)]) for i in range(1, 50)]
    odd = [(100, None), (120, [0.0, 0.0, 0.0]), (140, [1.0, None, 1.0]), (160, [float("nan"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (180, [1.0])]
    table = spark.createDataFrame(good + odd, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS h", "2 AS score")
    rows = neighbours.search(table, k=4).collect()
    vectors = dict(good)
    assert sorted({r.query_id for r in rows}) == [20, 40]
    for query in (20, 40):
        score = {i: sum(x * y for x, y in zip(vectors[query], v)) for i, v in vectors.items() if i != query}
        best = sorted(score, key=lambda i: (-score[i], i))[:4]
        mine = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == query)
        assert mine == [(n + 1, i, score[i]) for n, i in enumerate(best)]
    assert neighbours.search(table.limit(0)).count() == 0


def test_license_markup():
    auto = licenses.compiled("x", "made by <<2>> under [[the]] terms")
    accepted = lambda text: auto.accept([licenses.hash_of(w) for w in text.split()], 0)
    assert [accepted(t) for t in ("made by under terms", "made by a b under the terms", "made by a b c under terms", "made by a under")] == [4, 7, None, None]
    with pytest.raises(ValueError):
        licenses.compiled("x", "[[all may go]]")
