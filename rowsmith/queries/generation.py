"""Generation queries: one synthetic row, sample or batch per row of a given table."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.operators import generate, pages, requests
from rowsmith.plans import generation as plans
from rowsmith.queries.views import orders_dirty, said, table, with_views
from rowsmith.sources.shared import new_path

SEED = 7
ANCHOR = "2024-06-30"
SPEC = [
    ("patient_id", "id"),
    ("order_id", "string"),
    ("age", "int"),
    ("birth_year", "int"),
    ("visits", "int"),
    ("risk_score", "float"),
    ("visit_date", "date"),
    ("active", "boolean"),
    ("gender", "categorical"),
    ("race", "categorical"),
    ("frequency", "categorical"),
    ("group_code", "categorical"),
    ("note", "string"),
]
BATCH_SPEC = [("id", "id"), ("age", "int"), ("city", "string"), ("rate", "float")]


def requests_of(spark, sf_dir):
    """The benchmark texts as requests, with their domain."""
    return requests.understand(table(spark, sf_dir, "benchmark"), "text")


def descriptors_of(spark, sf_dir):
    return pages.fallback_descriptors(requests_of(spark, sf_dir), 3, "item_id", "text", "domain")


def batch_answers(spark, sf_dir):
    """Answers with rows of a batch within each document's text: complete, with a field left out, without JSON, broken."""
    item = F.col("doc_id")
    number = item.cast("string")
    full = F.concat(F.lit('Rows: [{"id":"A'), number, F.lit('","age":'), number, F.lit('},{"id":"B","age":7}] end'))
    answer = (
        F.when(item % 4 == 0, full)
        .when(item % 4 == 1, F.concat(F.lit('[{"id":"C","rate":'), number, F.lit("}]")))
        .when(item % 4 == 2, "no rows")
        .otherwise('[{"id":"D",}]')
    )
    return table(spark, sf_dir, "documents").select(item.alias("batch"), said(answer).alias("response"))


def spec_answers(spark, sf_dir):
    """Answers with a specification within each document's text, and answers without one."""
    item = F.col("doc_id")
    full = F.concat(
        F.lit('Here: {"dataset_name":"Set '),
        item.cast("string"),
        F.lit('","columns":["id","age","city"],"column_details":{"age":{"type":"int"},"id":{"type":"id"}}} ok'),
    )
    return table(spark, sf_dir, "documents").select(
        item.alias("answer_id"),
        said(F.when(item % 2 == 0, full).otherwise("sorry")).alias("response"),
        F.array(F.lit("id"), F.lit("value")).alias("expected_columns"),
    )


def run_answers(spark, sf_dir):
    """An answer for each source of the documents, within text of one of them: as many patients as it has documents, as many
    sites, no specification, or an empty one."""
    docs = table(spark, sf_dir, "documents")
    sources = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", F.substring("text", 1, 200).alias("text"))).alias("first"))
    name, size = F.col("source"), F.col("n").cast("string")
    patients = (
        '", "description": "who", "columns": ["patient_id", "age", "gender", "risk_score", "age"], "column_details": {'
        '"patient_id": {"type": "id"}, "age": {"type": "int", "value_range": "20 to 35 years"},'
        ' "gender": {"type": "categorical"}, "risk_score": {"type": "float", "value_range": [2.5, -0.5]}}, "row_count": '
    )
    sites = (
        '", "columns": ["id", "opened", "open", "kind", "note"], "column_details": {"id": {"type": "id"},'
        ' "opened": {"type": "date"}, "open": {"type": "boolean"}, "kind": {"type": "categorical", "value_range": "clinic, ward, lab"}}, "row_count": '
    )
    turn = F.col("n") % 4
    spec = (
        F.when(turn == 0, F.concat(F.lit('{"dataset_name": "patients of '), name, F.lit(patients), size, F.lit("}")))
        .when(turn == 1, F.concat(F.lit('{"dataset_name": "sites of '), name, F.lit(sites), size, F.lit("}")))
        .when(turn == 2, F.lit("I can not say"))
        .otherwise(F.concat(F.lit('{"dataset_name": "nothing of '), name, F.lit('", "columns": ["id"], "row_count": 0}')))
    )
    text = F.translate("first.text", "{}", "()")
    return sources.select(
        F.col("source").alias("answer_id"), F.concat(text, F.lit(" "), spec, F.lit(" "), text).alias("response"), F.array(F.lit("id"), F.lit("value")).alias("expected_columns")
    )


def run_of(spark, sf_dir):
    return plans.generation_run(run_answers(spark, sf_dir), "answer_id", new_path(spark, "run"), SEED, ANCHOR)


def gen_run(spark, sf_dir):
    """All cells of a run's tables, read back from its files, in the order of the wanted columns: one that no table has among them."""
    specs, rows, _ = run_of(spark, sf_dir)
    wanted = specs.select("dataset", F.array_append(F.col("fields.column"), F.lit("reviewer")).alias("columns"))
    return plans.aligned(rows, wanted).withColumn("position", F.col("position").cast("bigint"))


def gen_run_manifest(spark, sf_dir):
    """What a run has written, and whether ids repeat."""
    found = run_of(spark, sf_dir)[2]
    return found.withColumns({"columns": F.array_join("columns", ","), "file_path": F.element_at(F.split("file_path", "/"), -1)})


def gen_table(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select("o_orderkey")
    return generate.generate_table(keys, "o_orderkey", SPEC, SEED, ANCHOR)


def gen_table_whole_parts(spark, sf_dir):
    """Names match as whole parts only: width is no id, and percentage is no age."""
    keys = table(spark, sf_dir, "customer").select("c_custkey")
    spec = [("width", "int"), ("percentage", "float"), ("customerId", "string"), ("age_group", "string")]
    return generate.generate_table(keys, "c_custkey", spec, SEED, ANCHOR, whole_parts=True, keep=["c_custkey"])


def gen_batches(spark, sf_dir):
    keys = generate.with_batches(table(spark, sf_dir, "orders"), "o_orderkey")
    rows = generate.generate_table(keys, "o_orderkey", [("id", "id")], keep=["batch", "id_offset"])
    return rows.groupBy("batch", "id_offset").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


def gen_samples(spark, sf_dir):
    rows = generate.sample_rows(
        descriptors_of(spark, sf_dir).withColumn("key", F.concat_ws("-", "item_id", "dataset_no")), "key", seed=SEED, anchor=ANCHOR
    )
    return rows.select("item_id", "dataset_no", F.posexplode("sample_data").alias("row_no", "r")).select(
        "item_id",
        "dataset_no",
        F.col("row_no").cast("bigint").alias("row_no"),
        F.explode("r").alias("column", "value"),
    )


def gen_constants(spark, sf_dir):
    rows = generate.constant_samples(descriptors_of(spark, sf_dir), "domain")
    return rows.select("item_id", "dataset_no", F.explode("sample_data").alias("r")).select(
        "item_id", "dataset_no", F.explode("r").alias("column", "value")
    )


def gen_spec(spark, sf_dir):
    rows = generate.read_specs(spec_answers(spark, sf_dir), "answer_id")
    return rows.withColumn("ordinal", F.col("ordinal").cast("bigint"))


def gen_parse(spark, sf_dir):
    rows = generate.parse_generated_rows(batch_answers(spark, sf_dir), "batch", BATCH_SPEC, seed=SEED, anchor=ANCHOR)
    return rows.withColumn("position", F.col("position").cast("bigint"))


def gen_align(spark, sf_dir):
    rows = generate.align_schema(table(spark, sf_dir, "part"), ["p_name", "p_color", "p_partkey", "p_size"])
    return rows


def gen_unique_ids(spark, sf_dir):
    """Ids made from the keys of a table with repeated rows are repeated as well."""
    made = generate.generate_table(orders_dirty(spark, sf_dir), "o_orderkey", [("order_id", "id")])
    return generate.repeated_ids(made, "order_id")


QUERIES = {
    f.__name__: f
    for f in (
        gen_table,
        gen_table_whole_parts,
        gen_batches,
        gen_samples,
        gen_constants,
        gen_spec,
        gen_parse,
        gen_align,
        gen_unique_ids,
        gen_run,
        gen_run_manifest,
    )
}


def digest_sql(name: str, key: str) -> str:
    return f"md5(concat('{SEED}:{name}:', CAST({key} AS VARCHAR)))"


def hash_sql(name: str, key: str) -> str:
    return f"CAST(concat('0x', substr({digest_sql(name, key)}, 1, 8)) AS BIGINT)"


def list_sql(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def pick_sql(number: str, values) -> str:
    return f"({list_sql(values)})[CAST(({number}) % {len(values)} AS BIGINT) + 1]"


def text_sql(digest: str, words: int = 8) -> str:
    picked = ", ".join(
        pick_sql(f"CAST(concat('0x', substr({digest}, {2 * i + 1}, 2)) AS BIGINT)", generate.WORDS) for i in range(words)
    )
    joined = f"array_to_string([{picked}], ' ')"
    return f"concat(upper(substr({joined}, 1, 1)), substr({joined}, 2))"


def date_sql(number: str) -> str:
    return f"strftime(DATE '{ANCHOR}' - CAST(({number}) % 1827 AS INTEGER), '%Y-%m-%d')"


def id_sql(form: str, key: str) -> str:
    return f"concat('{form}', lpad(CAST({key} + 1 AS VARCHAR), CAST(greatest(6, length(CAST({key} + 1 AS VARCHAR))) AS INTEGER), '0'))"


def int_sql(name: str, key: str, low: int, high: int) -> str:
    return f"CAST({hash_sql(name, key)} % {high - low + 1} + {low} AS INTEGER)"


def float_sql(name: str, key: str) -> str:
    return f"CAST({hash_sql(name, key)} % 10001 AS DOUBLE) / 100"


def note_sql(name: str, key: str) -> str:
    return f"substr({text_sql(digest_sql(name, key))}, 1, 50)"


K = "o_orderkey"
DESCRIPTORS_SQL = """d AS (
  SELECT item_id, domain, CAST(n AS BIGINT) AS dataset_no, unnest(CASE domain
    WHEN 'medical' THEN ['patient_id', 'age', 'gender', 'condition', 'treatment', 'outcome']
    WHEN 'financial' THEN ['date', 'symbol', 'price', 'volume', 'market_cap']
    ELSE ['id', 'category', 'value', 'status', 'date'] END) AS "column"
  FROM req, (SELECT unnest([1, 2, 3]) AS n))"""


def domain_sql(text: str) -> str:
    rules = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({text}), '{w}')" for w in words) + f" THEN '{d}'"
        for d, words in requests.DOMAIN_KEYWORDS.items()
    )
    return f"CASE {rules} ELSE 'general' END"


REQUESTS_SQL = f"req AS (SELECT item_id, text, {domain_sql('text')} AS domain FROM benchmark)"

SAMPLE_DIGEST = (
    f"md5(concat('{SEED}:', \"column\", ':', CAST(item_id AS VARCHAR), '-', CAST(dataset_no AS VARCHAR), '/',"
    " CAST(row_no AS VARCHAR)))"
)
SAMPLES_SQL = f"""SELECT item_id, dataset_no, row_no, "column", CASE
    WHEN contains("column", 'id') THEN concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), substr(h, 13, 4),
      substr(h, 17, 4), substr(h, 21, 12))
    WHEN contains("column", 'age') THEN CAST(n0 % 73 + 18 AS VARCHAR)
    WHEN contains("column", 'date') THEN {date_sql("n0")}
    WHEN contains("column", 'value') THEN concat(CAST((n0 % 100000) // 100 AS VARCHAR), '.',
      lpad(CAST(n0 % 100 AS VARCHAR), 2, '0'))
    ELSE {pick_sql("n0", generate.WORDS)} END AS value
  FROM (SELECT *, CAST(concat('0x', substr(h, 1, 8)) AS BIGINT) AS n0 FROM (
    SELECT *, {SAMPLE_DIGEST} AS h FROM d, (SELECT unnest([0, 1, 2])::BIGINT AS row_no)))"""

RUN_DIGEST = f"md5(concat('{SEED}:', dataset, '/', \"column\", ':', CAST(row_no AS VARCHAR)))"
RUN_SQL = f"""sources AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
named AS (
  SELECT source, CAST(CASE n % 4 WHEN 2 THEN 50 WHEN 3 THEN 0 ELSE n END AS BIGINT) AS n, CASE n % 4
    WHEN 0 THEN concat('patients of ', source) WHEN 1 THEN concat('sites of ', source) WHEN 2 THEN 'SyntheticDataset'
    ELSE concat('nothing of ', source) END AS name, CASE n % 4 WHEN 0 THEN 'who' ELSE '' END AS description, CASE n % 4
    WHEN 0 THEN ['patient_id', 'age', 'gender', 'risk_score'] WHEN 1 THEN ['id', 'opened', 'open', 'kind', 'note']
    WHEN 2 THEN ['id', 'value'] ELSE ['id'] END AS columns FROM sources),
tables AS (SELECT *, concat(source, '-', name) AS dataset FROM named),
cells AS (
  SELECT dataset, row_no, position, "column", CAST(concat('0x', substr(h, 1, 8)) AS BIGINT) AS h0, h FROM (
    SELECT *, {RUN_DIGEST} AS h FROM (
      SELECT dataset, row_no, i AS position, list_append(columns, 'reviewer')[i + 1] AS "column"
      FROM tables, unnest(range(n)) AS r(row_no), unnest(range(len(columns) + 1)) AS c(i))))"""

ORACLES = {
    "gen_run": with_views(RUN_SQL)
    + f"""SELECT dataset, row_no, position, "column", CASE "column"
    WHEN 'patient_id' THEN {id_sql("PAT_", "row_no")} WHEN 'id' THEN {id_sql("ID_", "row_no")}
    WHEN 'age' THEN CAST(20 + h0 % 16 AS VARCHAR) WHEN 'gender' THEN {pick_sql("h0", generate.SEX_VALUES)}
    WHEN 'risk_score' THEN concat(CASE WHEN h0 % 301 < 50 THEN '-' ELSE '' END, CAST(abs(h0 % 301 - 50) // 100 AS VARCHAR), '.',
      lpad(CAST(abs(h0 % 301 - 50) % 100 AS VARCHAR), 2, '0'))
    WHEN 'opened' THEN {date_sql("h0")} WHEN 'open' THEN CAST(h0 % 2 = 0 AS VARCHAR)
    WHEN 'kind' THEN {pick_sql("h0", ["clinic", "ward", "lab"])} WHEN 'reviewer' THEN 'Unknown'
    ELSE substr({text_sql("h")}, 1, 50) END AS value FROM cells""",
    "gen_run_manifest": with_views(RUN_SQL)
    + """SELECT name, description, array_to_string(columns, ',') AS columns, concat('dataset=', dataset) AS file_path,
  n AS row_count, n AS asked_rows, CAST(0 AS BIGINT) AS repeated_ids FROM tables""",
    "gen_table": f"""SELECT {id_sql("PAT_", K)} AS patient_id, {id_sql("ID_", K)} AS order_id,
  {int_sql("age", K, 18, 90)} AS age, {int_sql("birth_year", K, 1950, 2023)} AS birth_year,
  {int_sql("visits", K, 0, 100)} AS visits, {float_sql("risk_score", K)} AS risk_score,
  {date_sql(hash_sql("visit_date", K))} AS visit_date, {hash_sql("active", K)} % 2 = 0 AS active,
  {pick_sql(hash_sql("gender", K), generate.SEX_VALUES)} AS gender,
  {pick_sql(hash_sql("race", K), generate.ORIGIN_VALUES)} AS race,
  {pick_sql(hash_sql("frequency", K), generate.FREQUENCY_VALUES)} AS frequency,
  {pick_sql(hash_sql("group_code", K), generate.OTHER_VALUES)} AS group_code, {note_sql("note", K)} AS note
  FROM orders""",
    "gen_table_whole_parts": f"""SELECT c_custkey, {int_sql("width", "c_custkey", 0, 100)} AS width,
  {float_sql("percentage", "c_custkey")} AS percentage, {id_sql("ID_", "c_custkey")} AS "customerId",
  {int_sql("age_group", "c_custkey", 18, 90)} AS age_group FROM customer""",
    "gen_batches": f"""SELECT {K} // 10 AS batch, {K} // 10 * 10 AS id_offset, count(*) AS row_count,
  min({id_sql("ID_", K)}) AS first_id, max({id_sql("ID_", K)}) AS last_id FROM orders GROUP BY 1, 2""",
    "gen_samples": with_views(REQUESTS_SQL, DESCRIPTORS_SQL) + SAMPLES_SQL,
    "gen_constants": with_views(REQUESTS_SQL, DESCRIPTORS_SQL)
    + """SELECT item_id, dataset_no, "column", CASE domain
    WHEN 'medical' THEN CASE "column" WHEN 'age' THEN '45' WHEN 'patient_id' THEN 'P001' WHEN 'gender' THEN 'Male'
      ELSE 'Sample Value' END
    WHEN 'financial' THEN CASE "column" WHEN 'price' THEN '100.5' WHEN 'date' THEN '2024-01-01'
      WHEN 'symbol' THEN 'STOCK' ELSE 'Sample Value' END
    ELSE 'Sample Value' END AS value FROM d""",
    "gen_spec": """SELECT doc_id AS answer_id, concat('Set ', CAST(doc_id AS VARCHAR)) AS dataset_name, ordinal, "column", type
  FROM documents, (VALUES (0::BIGINT, 'id', 'id'), (1, 'age', 'int'), (2, 'city', 'string')) v(ordinal, "column", type)
  WHERE doc_id % 2 = 0
UNION ALL SELECT doc_id, 'SyntheticDataset', ordinal, "column", type
  FROM documents, (VALUES (0::BIGINT, 'id', 'string'), (1, 'value', 'string')) v(ordinal, "column", type)
  WHERE doc_id % 2 = 1""",
    "gen_parse": f"""SELECT doc_id AS batch, p AS position, 'answer' AS source,
    CASE p WHEN 0 THEN concat('A', CAST(doc_id AS VARCHAR)) ELSE 'B' END AS id,
    CASE p WHEN 0 THEN CAST(doc_id AS VARCHAR) ELSE '7' END AS age, CAST(NULL AS VARCHAR) AS city,
    CAST(NULL AS VARCHAR) AS rate
  FROM documents, (SELECT unnest([0, 1])::BIGINT AS p) WHERE doc_id % 4 = 0
UNION ALL SELECT doc_id, 0, 'answer', 'C', NULL, NULL, CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id % 4 = 1
UNION ALL SELECT batch, p, 'rule', {id_sql("ID_", "k")}, CAST({int_sql("age", "k", 18, 90)} AS VARCHAR),
    {note_sql("city", "k")}, CAST({float_sql("rate", "k")} AS VARCHAR)
  FROM (SELECT doc_id AS batch, p, doc_id * 10 + p AS k
    FROM documents, (SELECT unnest(range(10)) AS p) WHERE doc_id % 4 IN (2, 3))""",
    "gen_align": "SELECT p_name, 'Unknown' AS p_color, p_partkey, p_size FROM part",
    "gen_unique_ids": with_views("orders_dirty")
    + f"SELECT {id_sql('ID_', K)} AS id, count(*) AS copies FROM orders_dirty GROUP BY 1 HAVING count(*) > 1",
}
