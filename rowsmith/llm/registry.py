"""Queries over the training-data operators, and the SQL that checks those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.llm import (
    decontaminate,
    fingerprints,
    licenses,
    lines,
    manifest,
    minhash,
    mixing,
    neighbours,
    oracles,
    quality,
    spelling,
    substrings,
    tokens,
    toxicity,
)
from rowsmith.sources.shared import new_path

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_minhash(spark, sf_dir):
    return minhash.near_duplicates(documents(spark, sf_dir), n=4)


def op2_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op3_lines(spark, sf_dir):
    found = lines.repeated_lines(documents(spark, sf_dir))
    return found.withColumn("removed", F.array_join(F.transform("removed", lambda i: i.cast("string")), ","))


def op4_passages(spark, sf_dir):
    return substrings.without_repeats(documents(spark, sf_dir))


def op4_substrings(spark, sf_dir):
    return substrings.without_repeats(documents(spark, sf_dir), extend=False)


def op5_neighbours(spark, sf_dir):
    return neighbours.search(table(spark, sf_dir, "embeddings"))


def op6_quality(spark, sf_dir):
    return quality.scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op8_licenses(spark, sf_dir):
    found = licenses.scans(documents(spark, sf_dir)).drop("spans")
    return found.withColumns({name: F.array_join(name, ",") for name in ("base_labels", "labels")})


def op9_toxicity(spark, sf_dir):
    return toxicity.scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op10_curriculum(spark, sf_dir):
    return mixing.order_of(documents(spark, sf_dir))


def op10_mixing(spark, sf_dir):
    return mixing.totals(documents(spark, sf_dir))


def op7_tokens(spark, sf_dir):
    import public_tokenizers

    path = new_path(spark, "tokens")
    tokens.write_tokens(documents(spark, sf_dir), path, public_tokenizers.path(TOKENIZER))
    return tokens.read_tokens(spark, path, with_ids=False)


def op11_manifest(spark, sf_dir):
    return manifest.audited(documents(spark, sf_dir)).drop("proof", "tampered")


def op12_spelling(spark, sf_dir):
    return spelling.variants(spelling.shortened(spelling.runs(documents(spark, sf_dir))))


def op13_fingerprints(spark, sf_dir):
    return fingerprints.edited(documents(spark, sf_dir))


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_decontaminate": op2_decontaminate,
    "op3_lines": op3_lines,
    "op4_passages": op4_passages,
    "op4_substrings": op4_substrings,
    "op5_neighbours": op5_neighbours,
    "op6_quality": op6_quality,
    "op7_tokens": op7_tokens,
    "op8_licenses": op8_licenses,
    "op9_toxicity": op9_toxicity,
    "op10_mixing": op10_mixing,
    "op10_curriculum": op10_curriculum,
    "op11_manifest": op11_manifest,
    "op12_spelling": op12_spelling,
    "op13_fingerprints": op13_fingerprints,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_minhash": """
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+') AS x FROM documents),
        s AS (
          SELECT DISTINCT doc_id, CASE WHEN len(x) < 4 THEN x ELSE x[i:i + 3] END AS shingle
          FROM w, unnest(range(1, greatest(len(x) - 3, CASE WHEN len(x) > 0 THEN 1 ELSE 0 END) + 1)) AS r(i)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id),
        links AS (
          SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
        reach AS (
          SELECT doc_id AS a, doc_id AS b FROM documents
          UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
        FROM documents d LEFT JOIN n USING (doc_id)
        JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)""",
    "op10_mixing": """
        WITH d AS (
          SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
            md5('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        s AS (
          SELECT source, sum(size)::BIGINT AS source_size,
            CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
          FROM d GROUP BY source),
        k AS (
          SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER need, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER need, 0)) AS share
          FROM s WINDOW need AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        t AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, max(share) OVER () * weight) AS target FROM k),
        c AS (
          SELECT doc_id, size, source_size, target, greatest(coalesce(ceil((target - size / 2
            - coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / nullif(source_size, 0)), 1), 0)::BIGINT AS copies
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT *, copies * size AS taken FROM c""",
    "op11_manifest": oracles.MANIFEST,
    "op12_spelling": oracles.SPELLING,
    "op13_fingerprints": oracles.fingerprints(fingerprints.K, fingerprints.WINDOW),
}
