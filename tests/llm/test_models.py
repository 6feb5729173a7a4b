"""Held-out accuracy of the fitted classifiers on the middle tables."""

from rowsmith.llm import registry

TABLES = "/root/testdata/sf0.1"


def rates(spark, name, label):
    labels = spark.read.parquet(f"{TABLES}/labels.parquet").select("doc_id", label)
    rows = registry.QUERIES[name](spark, TABLES).filter("held_out").join(labels, "doc_id").collect()
    yes = [r.predicted for r in rows if r[label] == 1]
    no = [r.predicted for r in rows if r[label] == 0]
    return sum(yes) / len(yes), sum(no) / len(no)


def test_quality(spark):
    kept, passed = rates(spark, "op6_quality", "quality")
    assert kept > 0.97 and passed < 0.1


def test_toxicity(spark):
    caught, blamed = rates(spark, "op9_toxicity", "toxic")
    assert caught > blamed + 0.6
