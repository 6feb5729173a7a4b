"""What steps leave on disk while a job goes on."""

import os

import numpy as np
import pytest

from rowsmith.llm import lines
from rowsmith.sources import shared


def shuffle_files(spark):
    places = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f"{d}/{x}" for place in places for d, _, names in os.walk(place.getPath()) for x in names if x.startswith("shuffle_")}


def tables(spark):
    return set(os.listdir(shared.shared_folder(spark).removeprefix("file:")))


def test_stored_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(shared.CLEANED, None)
    rows = spark.range(1000).selectExpr("id % 7 AS k").repartition(5, "k").groupBy("k").count()
    table = shared.stored(rows, "counts")
    assert shuffle_files(spark) <= before and spark.conf.get(shared.CLEANED, None) == setting
    assert sorted(r["count"] for r in table.collect()) == [142] * 1 + [143] * 6
    shared.removed(table)
    assert os.path.basename(table.stored_at) not in tables(spark)


@pytest.mark.parametrize("cells", [1, 17])
def test_lines_keep_only_what_is_read_later(spark, monkeypatch, cells):
    """Tables go once they are read; a bitmap of digests that is too small only lets more texts through."""
    monkeypatch.setattr(lines, "CELLS", cells, raising=False)
    rng = np.random.default_rng(7)
    own = ["".join(rng.choice(list("abcdefgh"), 400)) for _ in range(300)]
    texts = [f"{own[i]}\nthe same\n{own[i - 150] + 'x' * (i % 2) if i >= 150 else i}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    spark.range(1).count()
    shared.stored(spark.range(1), "first")
    before = tables(spark)
    found = lines.repeated_lines(docs)
    left = {name.rpartition("-")[0] for name in tables(spark) - before}
    assert left <= {"line-places", "line-pairs", "line-open", "line-links", "links", "prefixes"}, left
    assert {r.doc_id: r.removed for r in found.collect()} == {i: [1] * (i > 0) + [2] * (i >= 150) for i in range(300)}
