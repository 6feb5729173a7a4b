"""Operators on the smallest tables beside plain versions that compare everything with everything."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from compare import connect, differences
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowsmith.llm import registry, tokens, words

LOWER = {i: i + 32 for i in range(65, 91)}
SPACED, LETTERED = "[^\x20\x09-\x0d]+", "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


@pytest.fixture(scope="module")
def texts(spark, small):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}


def rows_of(spark, small, name):
    return registry.QUERIES[name](spark, small).collect()


def groups(sets, percent):
    """Component of each name by its smallest member."""
    parent = {name: name for name in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    holders = defaultdict(list)
    for a, members in sets.items():
        common = Counter(b for m in members for b in holders[m])
        for m in members:
            holders[m].append(a)
        for b, k in common.items():
            if 100 * k >= percent * (len(members) + len(sets[b]) - k):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {name: root(name) for name in sets}


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_sql(spark, small, name):
    assert differences(registry.QUERIES[name](spark, small), connect(small), registry.ORACLES[name]) == []


def test_lines(spark, small, texts):
    places = [(i, n, line) for i in sorted(texts) for n, line in enumerate(re.split("\r?\n", texts[i])) if line]
    number = {line: at for at, (_, _, line) in reversed(list(enumerate(places)))}
    sets = {at: {b[i : i + 12] for i in range(max(1, len(b) - 11))} for line, at in sorted(number.items(), key=lambda x: x[1]) for b in [line.encode()]}
    component = groups(sets, 80)
    first, removed = {}, defaultdict(list)
    for i, n, line in places:
        if first.setdefault(component[number[line]], (i, n)) != (i, n):
            removed[i].append(n)
    for r in rows_of(spark, small, "op3_lines"):
        assert r.removed == ",".join(map(str, removed[r.doc_id]))


@pytest.mark.parametrize("few", [2, 32])
def test_lines_of_open_buckets(spark, monkeypatch, few):
    """Chains of lines of which only neighbours are linked: their buckets are not one component at first."""
    from rowsmith.llm import lines

    rng = np.random.default_rng(3)
    texts = []
    for _ in range(12):
        line = "".join(rng.choice(list("abcdefgh \u00e9"), 400))
        for step in range(9):
            line = line[: 40 * step] + "".join(rng.choice(list("klmno"), 25)) + line[40 * step + 25 :]
            texts += [line, line + line[-30:] + line[-30:]][: 1 + step % 2]
    sets = {at: {b[i : i + 12] for i in range(max(1, len(b) - 11))} for at, line in enumerate(texts) for b in [line.encode()]}
    component = groups(sets, 80)

    def unwanted(*_):
        raise AssertionError("shingles of all open lines are put in one order")

    monkeypatch.setattr(lines, "FEW", few, raising=False)
    if few > 2:
        monkeypatch.setattr(lines, "prefix_pairs", unwanted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.n_kept for r in lines.repeated_lines(docs).collect()}
    assert found == {at: int(component[at] == at) for at in sets}
    assert 12 <= sum(found.values()) < len(texts)


def test_bitmaps_leave_no_link_out(spark):
    from rowsmith.llm import lines

    rng = np.random.default_rng(4)
    texts = []
    for n in (5, 12, 13, 30, 100, 700, 3000):
        line = "".join(rng.choice(list("abc"), n))
        texts += [line, line[: n - n // 10], line * 2, line[: n // 2] + "x" + line[n // 2 :]]
    sets = [{b[i : i + 12] for i in range(max(1, len(b) - 11))} for b in map(str.encode, texts)]
    pairs = [(a, b) for a in range(len(texts)) for b in range(a)]
    wanted = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    table = spark.createDataFrame(list(enumerate(texts)), "id bigint, line string").selectExpr("id", "cast(line as binary) AS line")
    bits = lines.bitmaps(table, 12)
    left = lines.likely(spark.createDataFrame(pairs, "a bigint, b bigint"), bits, 80)
    rows = left.collect()
    assert wanted <= {(r.a, r.b) for r in rows} and len(rows) < len(pairs) / 2
    assert all(r.together == len(sets[r.a]) + len(sets[r.b]) for r in rows)
    assert {(r.a, r.b) for r in lines.linked(left, table, 12, 80).collect()} == wanted


def test_sets_of_lines_are_made_once(spark, monkeypatch):
    """No filter makes sets of shingles once more, no line is copied for each of its shingles, and texts are parted
    only for keys, for copies and for counts."""
    from rowsmith.llm import lines

    plans, calls, stored, lines_of = [], [], lines.stored, lines.lines_of

    def kept(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(lines, "stored", kept)
    monkeypatch.setattr(lines, "lines_of", lambda docs: calls.append(1) or lines_of(docs))
    monkeypatch.setattr(lines, "FEW", 2)
    rng = np.random.default_rng(5)
    line = "".join(rng.choice(list("abcdefgh"), 600))
    texts = [line[:i] + "x" * 25 + line[i + 25 :] for i in range(0, 550, 10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    lines.repeated_lines(docs).collect()
    made = [step for plan in plans for step in plan.splitlines() if "xxhash64(substr" in step]
    assert any("array_distinct" in step for step in made)
    assert not [step for step in made if "Filter" in step and "array_distinct" in step]
    assert all("transform(array(" in step for step in made if "transform(" in step)
    assert len(calls) == 2


def test_hubs_of_buckets(spark):
    from rowsmith.llm import lines

    rng = np.random.default_rng(6)
    rows = [(i, int(rng.choice([1, 1, 1, 2, 5])), [int(k) for k in rng.integers(0, 60, 3)]) for i in range(90)]
    rows = [(i, times, sorted(set(keys))) for i, times, keys in rows]
    buckets = {}
    for i, times, keys in rows:
        for k in keys:
            buckets.setdefault(k, []).append((-times, i))
    wanted = {(k, i, min(at)[1], len(at)) for k, at in buckets.items() if len(at) > 1 for _, i in at}
    keyed = spark.createDataFrame(rows, "id bigint, times bigint, keys array<bigint>")
    assert {tuple(r) for r in lines.bucket_members(keyed).select("bucket", "id", "hub", "many").collect()} == wanted


@pytest.mark.parametrize("n", [1, 11, 12, 13, 14, 40, 41])
def test_keys_of_lines_are_of_all_shingles(spark, n):
    """Lines of odd and even numbers of shingles: where a shingle is left out, keys differ from those of its set."""
    from rowsmith.llm import lines

    line = "".join(np.random.default_rng(n).choice(list("abcd"), n))
    docs = spark.createDataFrame([(1, f"{line}\n{line}"), (2, line)], "doc_id bigint, text string")
    row = lines.line_keys(docs, 12, 8, 2, 1).first()
    sets = spark.createDataFrame([(line,)], "line string").selectExpr("cast(line as binary) AS line")
    shingles = sets.select(F.explode(lines.shingle_set(F.col("line"), 12)).alias("h"))
    least = shingles.agg(*[F.min(F.col("h").bitwiseXOR(F.xxhash64(F.lit(1 + i)))).alias(f"m{i}") for i in range(16)])
    keys = least.select(F.array(*[F.xxhash64(F.lit(b), f"m{2 * b}", f"m{2 * b + 1}") for b in range(8)])).first()[0]
    assert row.times == 3 and row["keys"] == keys


def test_sentence_runs(spark, small, texts):
    parts = {}
    for i, text in texts.items():
        found, now = [], []
        for token in re.findall(SPACED + "|\n", text):
            if token != "\n":
                now.append(token.translate(LOWER))
            if now and (token == "\n" or token[-1] in ".!?"):
                found, now = [*found, now], []
        parts[i] = [*found, now] if now else found
    first, gone = {}, defaultdict(set)
    for i in sorted(parts):
        for n, (a, b) in enumerate(zip(parts[i], parts[i][1:], strict=False)):
            if len(a + b) >= 10 and first.setdefault(tuple(a + b), (i, n)) != (i, n):
                gone[i] |= {n, n + 1}
    for r in rows_of(spark, small, "op4_substrings"):
        assert (r.n_sentences, r.n_removed) == (len(parts[r.doc_id]), len(gone[r.doc_id]))
        kept = [w for n, s in enumerate(parts[r.doc_id]) if n not in gone[r.doc_id] for w in s]
        assert re.findall(SPACED, r.text.translate(LOWER)) == kept


def test_leaks_are_all_found(spark, small, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()}
    words_of = lambda t: " " + " ".join(re.findall(LETTERED, t.translate(LOWER))) + " "
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if words_of(x) in words_of(t)}
    found = {(r.doc_id, r.item_id): r.score for r in rows_of(spark, small, "op2_decontaminate")}
    assert exact and exact == {pair for pair, score in found.items() if score == 1.0}


def test_edited_leaks_are_found_and_others_are_not(spark):
    from rowsmith.llm import decontaminate

    rng = np.random.default_rng(0)
    vocabulary = [f"w{n}" for n in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary, 40))) for i in range(5)]
    docs = []
    for i, text in items:
        edited = text.split()
        for at in rng.choice(40, 6, replace=False):
            edited[at] = "changed"
        del edited[20]
        docs.append((i, " ".join([*rng.choice(vocabulary, 50), *edited, *rng.choice(vocabulary, 50)])))
    docs += [(100 + i, " ".join(rng.choice(vocabulary, 300))) for i in range(20)]
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(i, i) for i in range(5)]


def test_neighbours_reach_the_recall(spark, small):
    table = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()}
    ids = np.array(sorted(table))
    matrix = np.stack([table[i] for i in ids])
    found = defaultdict(list)
    for r in sorted(rows_of(spark, small, "op5_neighbours"), key=lambda r: r["rank"]):
        found[r.query_id].append(r.vec_id)
        assert abs(r.score - table[r.query_id] @ table[r.vec_id]) < 1e-9
    hits = 0
    for query in ids[ids % 20 == 0]:
        score = np.where(ids == query, -np.inf, matrix @ table[query])
        hits += len(set(ids[np.lexsort((ids, -score))[:20]]) & set(found[query]))
    assert hits >= 0.9 * 20 * (ids % 20 == 0).sum()


def test_adaptive_scan_keeps_the_nearest():
    from rowsmith.llm import neighbours

    rng = np.random.default_rng(1)
    turn = neighbours.rotation(65, 1)
    points, queries = rng.normal(size=(3000, 65)) @ turn, rng.normal(size=(40, 65)) @ turn
    q, p = neighbours.scan(queries, points, 10)
    far = ((queries[:, None] - points) ** 2).sum(axis=2)
    hits = sum(len(set(p[q == i]) & set(np.argsort(far[i])[:10])) for i in range(40))
    assert hits >= 0.95 * 400 and len(p) < 40 * 3000 / 10


def test_token_files(spark, small, texts):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows_of(spark, small, "op7_tokens")}
    for i in sorted(texts):
        ids = [*plain.encode(texts[i], add_special_tokens=False).ids, 1]
        assert found[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_word_encoder_equals_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    plain, own = Tokenizer.from_file(path), tokens.WordEncoder(path)
    odd = ["It's 3.14!! 'tis", "<|endoftext|>x a", "ÀÉ́ J̌ İstanbul ΣΑΣ", "a\x1cb c", "中文 🙂🙂 x y z", "", "  \n"]
    assert own.ids(odd) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in odd]


def test_word_encoder_on_random_unicode():
    """Also on characters that later versions of Unicode call letters, and the tokenizer does not."""
    path = public_tokenizers.path("word_bpe_49k.json")
    plain, own = Tokenizer.from_file(path), tokens.WordEncoder(path)
    rng = np.random.default_rng(5)
    common = [*map(chr, range(1, 0x250)), *"\u0301\u0308\u4e2d\ufb01\u0663\u200b\u3000\ufeff", "'ll", "'S", *" .," * 40]
    texts = ["".join(rng.choice(common, 30)) for _ in range(1000)]
    far = np.setdiff1d(np.arange(0x250, 0x20000), np.arange(0xD800, 0xE000))
    texts += ["".join(map(chr, rng.choice(far, 20))) for _ in range(1000)] + ["xy\U00018dce", "\U0001c63d ab,"]
    for part in (texts[:700], texts[700:], texts):
        assert own.ids(part) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in part]


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
@pytest.mark.parametrize("top", [2, 300, 49408, 2**32 - 1])
def test_blocks_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    ids[n // 2 : n // 2 + 1] = 2**32 - 1
    starts, payload = tokens.pack(ids)
    assert (tokens.unpack(starts, payload, n) == ids).all()
    one = starts[len(starts) // 2 : len(starts) // 2 + 1]
    if len(one):
        at = len(starts) // 2 * tokens.BLOCK
        assert (tokens.unpack(one, payload, len(ids[at : at + tokens.BLOCK])) == ids[at : at + tokens.BLOCK]).all()


def test_license_phrases(spark, small, texts):
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    for r in rows_of(spark, small, "op8_licenses"):
        w = re.findall(LETTERED, texts[r.doc_id].translate(LOWER))
        places = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert set(r.base_labels.split(",")) <= {*r.labels.split(","), ""}


@pytest.mark.parametrize("window", [8, 1 << 20])
def test_words_equal_regular_expressions(monkeypatch, window):
    import pyarrow as pa

    monkeypatch.setattr(words, "WINDOW", window)
    rng = np.random.default_rng(window)
    seen = {}
    for _ in range(50):
        texts = ["".join(rng.choice(list("ab \t\néA"), rng.choice([0, 1, 9, 60]))) for _ in range(4)]
        hashes, before = words.word_hashes(*words.texts_of(pa.array([None, *texts])))
        for n, text in enumerate(texts, 1):
            found = re.findall(SPACED, text.translate(LOWER))
            assert before[n + 1] - before[n] == len(found)
            assert all(seen.setdefault(w, h) == h for w, h in zip(found, hashes[before[n] : before[n + 1]], strict=True))
    assert len(set(seen.values())) == len(seen)
