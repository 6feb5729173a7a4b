"""Spelling variants beside a comparison of every word with every word."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rowsmith.llm import registry, spelling

LOWER = {i: i + 32 for i in range(65, 91)}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(counts):
    forms, many = {}, {}
    for word, n in counts.items():
        others = [v for v in counts if abs(len(v) - len(word)) < 2 and near(word, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        many[word] = len(others)
        forms[word] = best if best is not None and counts[best] >= 2 * n else None
    for word, n in counts.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        yield word, forms[word], root, n, many[word], counts[forms[word]] if forms[word] is not None else None


def found(frame):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()), key=str)


@pytest.mark.parametrize("most", [spelling.FILTER_BYTES, 400])
def test_variants(spark, monkeypatch, most):
    monkeypatch.setattr(spelling.Filters.__init__, "__defaults__", (most,))
    rng = np.random.default_rng(5)
    base = ["".join(rng.choice(list("abcé"), n)) for n in (5, 5, 6, 6, 7, 9, 40, 63, 64, 65, 66, 200)]
    base += ["letter", "lettre", "lettter", "leter", "aaaaa", "aaaaaa", "aaaaaaa", "short", "shor", "żółwie", "żółwi"]
    words = Counter()
    for word in base:
        words[word] += int(rng.integers(3, 40))
        for at in rng.integers(0, len(word), 12):
            kind, c = rng.integers(3), str(rng.choice(list("abcéz")))
            edit = (word[:at] + word[at + 1 :], word[:at] + c + word[at:], word[:at] + c + word[at + 1 :])[kind]
            words[edit] += int(rng.integers(1, 20))
    rows = [(w,) for w, n in words.items() for _ in range(n)] + [(None,), ("",)] * 5
    frame = spelling.variants(spark.createDataFrame(rows, "word string").selectExpr("word", "'x' AS n", "1 AS root"))
    kept = {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}
    assert found(frame) == sorted(grouped(kept), key=str)


def test_query(spark, small):
    counts = Counter()
    for r in registry.documents(spark, small).collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{r.doc_id}:{word}".encode())
            counts[word[: h % len(word)] + word[h % len(word) + 1 :] if h % 97 == 0 else word] += 1
    kept = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    by_size = sorted(kept, key=len)
    assert len(by_size) > 500
    rows = found(registry.QUERIES["op12_spelling"](spark, small))
    assert rows == sorted(grouped(kept), key=str)
    assert any(r[1] for r in rows)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0), (None, "Hello hello", 0), (2, "", 0), (3, "hellO\x00hello×", 0), (3, "hello" * 50_000, 0)], "doc_id bigint, text string, run int")
    runs = Counter(r.run for r in spelling.runs(docs).collect())
    assert runs == {"hello": 4 - 1, "hello×": 1, "hello" * 50_000: 1}
    assert spelling.variants(spelling.shortened(spelling.runs(docs.limit(0)))).count() == 0
    assert spelling.variants(docs.selectExpr("CAST(NULL AS STRING) AS word")).count() == 0


def test_false_positives_go(spark, monkeypatch):
    """Filters of a single block let nearly every edit through; the joins leave only true ones."""
    monkeypatch.setattr(spelling, "BITS", 1)
    words = [f"{a}{b}{c}word" for a in "abc" for b in "abc" for c in "abc"]
    frame = spelling.variants(spark.createDataFrame([(w,) for w in words * 3], "word string"))
    assert found(frame) == sorted(grouped(dict.fromkeys(words, 3)), key=str)
