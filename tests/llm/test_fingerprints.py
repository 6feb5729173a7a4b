"""Winnowing beside a plain version that looks at every window."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsmith.llm import fingerprints as fp


def hashes(text, k):
    return [zlib.crc32(text[i : i + k].encode("utf-32-be")) for i in range(max(len(text) - k + 1, 1))] if text else []


def winnowed(text, k, window):
    grams = hashes(text, k)
    found = set()
    for at in range(max(len(grams) - window + 1, 1) if grams else 0):
        part = range(at, min(at + window, len(grams)))
        best = min(part, key=lambda i: (grams[i], -i))
        found.add((best, grams[best]))
    return sorted(found)


TEXTS = ["", None, "a", "short", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "naïve 😀 text with 😀😀 signs " * 9, "line\nbreaks\r\n\x00 " * 30]


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(8)
    return TEXTS + ["".join(rng.choice(list("abcdeé 😀"), n)) for n in (15, 16, 17, 78, 79, 80, 127, 128, 300, 4095, 4174, 4175, 9000)]


@pytest.mark.parametrize(("k", "window", "piece"), [(16, 64, 4096), (4, 8, 16), (2, 1, 5), (1, 2, 1)])
def test_fingerprint(spark, texts, k, window, piece):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    runs = fp.fingerprint(F.col("text"), k, window, piece)
    pairs = F.transform(runs, lambda r: F.struct(fp.place_of(r), fp.hash_of(r)))
    for r in rows.select("i", pairs.alias("runs")).collect():
        assert [tuple(x) for x in r.runs] == winnowed(texts[r.i] or "", k, window), r.i


@pytest.mark.parametrize(("k", "window"), [(16, 64), (4, 8), (2, 1), (1, 2)])
def test_continued(spark, texts, k, window):
    rows = [(i, a or "", b or "", same) for i, (a, b) in enumerate(zip(texts, texts[3:] + texts[:3], strict=True)) for same in {0, 1, 90, len(a or "") // 2, len(a or "")} if same <= len(a or "")]
    rows = [(a, a[:same] + b, same) for _, a, b, same in rows]
    runs = fp.fingerprint(F.col("a"), k, window, 64)
    frame = spark.createDataFrame(rows, "a string, b string, same int").withColumn("runs", runs)
    after = F.transform(fp.continued(F.col("runs"), F.col("same"), F.col("b"), k, window, 64), lambda r: F.struct(fp.place_of(r), fp.hash_of(r)))
    for r in frame.select("b", "same", after.alias("after")).collect():
        assert [tuple(x) for x in r.after] == winnowed(r.b, k, window), r.same


def test_shared_stretches_share_a_choice(spark):
    rng = np.random.default_rng(9)
    word = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    shared = [word(fp.K + fp.WINDOW - 1) for _ in range(20)]
    rows = [(i, word(int(rng.integers(0, 300))) + s + word(int(rng.integers(0, 300)))) for i, s in enumerate(shared * 2)]
    found = {i: {x.hash for x in r.runs} for i, r in enumerate(fp.fingerprints(spark.createDataFrame(rows, "doc_id int, text string")).orderBy(F.monotonically_increasing_id()).collect())}
    for i in range(20):
        assert found[i] & found[i + 20]


@pytest.mark.parametrize("size", [2000, 3])
def test_edited(spark, texts, monkeypatch, size):
    monkeypatch.setattr(fp, "RANGE", size)
    ids = [i * i * 3 - 40 for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in zip(ids, texts, strict=True)], "doc_id bigint, text string, next int, part string").repartition(4)
    order = sorted(zip(ids, [t or "" for t in texts], strict=True), reverse=True)
    share = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    held = lambda t: {h for _, h in winnowed(t, fp.K, fp.WINDOW)}
    text_of = lambda t: " ".join(f"{h}@{p}" for p, h in winnowed(t, fp.K, fp.WINDOW))
    want = []
    for (i, text), (_, other) in zip(order, order[1:] + order[:1], strict=True):
        cut = len(text) // 3
        edit = text[: len(text) - cut] + other[:cut]
        want.append((i, len(text), hashlib.sha256(edit.encode()).hexdigest(), text_of(text), text_of(edit), share(held(text), held(edit)), share(held(text), held(other))))
    assert sorted(map(tuple, fp.edited(docs).collect())) == sorted(want)


def test_odd_rows(spark):
    rows = [(None, "a"), (7, "b"), (7, "b"), (7, None), (None, "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = fp.edited(docs).collect()
    assert len(found) == 5 and sorted(r.n_chars for r in found) == [0, 1, 1, 1, 1]
    assert fp.edited(docs.limit(0)).count() == 0
    assert fp.edited(docs.limit(1)).first().near_next == 1.0


def test_no_python_in_the_plan(spark, small):
    from rowsmith.llm import registry

    plan = registry.QUERIES["op13_fingerprints"](spark, small)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD"))
