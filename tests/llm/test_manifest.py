"""The Merkle manifest beside a tree built over sorted lists."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from rowsmith.llm import manifest, ranks

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, slot int, total int, word string, digest string, same string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, more=0):
    chars = None if row.n_chars is None else row.n_chars + more
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, chars, row.text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.lang].append((r.doc_id is not None, r.doc_id or 0, leaf(r), r))
    langs = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    ordered = {lang: sorted(groups[lang], key=lambda x: x[:3]) for lang in langs}
    trees = {lang: tree([x[2] for x in ordered[lang]]) for lang in langs}
    top = tree([trees[lang][-1][0] for lang in langs])
    for at, lang in enumerate(langs):
        for place, (_, _, own, row) in enumerate(ordered[lang]):
            way = []
            for levels, spot in ((trees[lang], place), (top, at)):
                for level in levels[:-1]:
                    way.append((spot % 2, "".join(level[spot ^ 1 : (spot ^ 1) + 1])))
                    spot //= 2
            changed = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 7 == 0
            node = leaf(row, 1) if changed else own
            for right, sibling in way:
                node = sha(sibling + node if right else node + sibling)
            root = top[-1][0]
            yield row.doc_id, own, trees[lang][-1][0], root, sha("".join(s for _, s in way)), node, node == root


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def rows_of(spark, many):
    rows = [(i * i * 37 - 400, f"text {i}", ["en", "de", None, "ä"][i % 7 % 4], None if i % 5 else "s", None if i % 3 == 0 else i) for i in range(many)]
    rows += [(None, t, "en", "s", 3) for t in ("", None, "a", "a", "a" * 100_000)] * 5
    rows += [(37, f"copy {i % 20}", "en", "hot", 1) for i in range(many)] + [(5, "alone", "zz", None, 2)]
    rows += [(i, "far", "zz", "s", 0) for i in (-(1 << 63), (1 << 63) - 1, 1 << 40, 63, 64, -1, -64, -65)]
    return spark.createDataFrame([(*r, 0, 0, "w", "d", "s") for r in rows], SCHEMA)


@pytest.mark.parametrize(("many", "levels"), [(60, 10), (60, 2), (200, 1)])
def test_manifest(spark, monkeypatch, many, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    monkeypatch.setattr(manifest, "SLOTS", 1 << levels)
    docs = rows_of(spark, many)
    found = manifest.audited(docs).select(COLUMNS).collect()
    assert sorted(map(tuple, found), key=str) == sorted(plain(docs.collect()), key=str)
    assert {r.verified for r in found} == {True, False}


def test_empty_and_single(spark):
    docs = rows_of(spark, 1)
    assert manifest.audited(docs.limit(0)).count() == 0
    one = docs.limit(1)
    row = manifest.audited(one).first()
    assert (row.root, row.subroot, row.proof, row.proof_sha256) == (row.leaf, row.leaf, [], sha(""))


def test_proofs_name_the_side_of_each_sibling(spark):
    found = manifest.manifest(rows_of(spark, 30)).collect()
    for r in found:
        node = r.leaf
        for step in r.proof:
            node = sha((step.sibling or "") + node if step.right else node + (step.sibling or ""))
        assert node == r.root


def test_ranks_with_a_narrow_directory(spark, monkeypatch):
    monkeypatch.setattr(ranks, "RADIX", 6)
    keys = [None, None, -(1 << 63), (1 << 63) - 1, 0, 0, 0, 1, 63, 64, 65, -1, -64, -65, 1 << 33, *range(5000, 9000, 7)]
    rows = spark.createDataFrame([("ab"[i % 2], k) for i, k in enumerate(keys)], "g string, k bigint")
    for r in ranks.ranked(rows, ranks.index(rows, "g", "k"), "g", "k").collect():
        mine = [-(1 << 70) if k is None else k for i, k in enumerate(keys) if "ab"[i % 2] == r.g]
        key = -(1 << 70) if r.k is None else r.k
        assert (r.rank, r.same, r.total) == (sum(k < key for k in mine), mine.count(key), len(mine))
