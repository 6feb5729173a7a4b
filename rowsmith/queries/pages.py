"""Page and request queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowsmith.functions.columns import fixed
from rowsmith.operators import pages, requests
from rowsmith.queries.generation import REQUESTS_SQL, domain_sql, list_sql, requests_of
from rowsmith.queries.profiles import r4, rounded, union_all
from rowsmith.queries.views import page_responses, pages_abs, table, with_views

QUERY = "effect of alcohol on patients with liver problems"
# The given pages hold invented words, so the marker words are ones that occur in them.
MARKERS = ["data", "tion", "que"]
TOP = 5


def texts_of(spark, sf_dir):
    return pages.extract_page_text(pages_abs(spark, sf_dir))


def candidates_of(spark, sf_dir):
    return pages.describe_candidates(texts_of(spark, sf_dir), page_responses(spark, sf_dir), QUERY, MARKERS)


def ranked_of(spark, sf_dir):
    return pages.rank_candidates(candidates_of(spark, sf_dir), TOP)


def shown(df):
    """Scores rounded, lists as text."""
    scores = [c for c in ("relevance_score", "data_quality_score", "quality_score", "merit") if c in df.columns]
    df = rounded(df, *scores)
    if "columns" in df.columns:
        df = df.withColumn("columns", F.array_join("columns", ","))
    if "candidate_rank" in df.columns:
        df = df.withColumn("candidate_rank", F.col("candidate_rank").cast("bigint"))
    return df


def page_links(spark, sf_dir):
    links = pages.extract_links(pages_abs(spark, sf_dir), max_links=5)
    return links.withColumn("position", F.col("position").cast("bigint"))


def page_text(spark, sf_dir):
    return texts_of(spark, sf_dir)


def page_filter(spark, sf_dir):
    return pages.filter_dataset_pages(texts_of(spark, sf_dir)).select("page_id", "url")


def page_score(spark, sf_dir):
    return shown(pages.page_scores(texts_of(spark, sf_dir)))


def page_collect(spark, sf_dir):
    """Two searches that find the same pages: with repeats, and once per url."""
    first = pages_abs(spark, sf_dir).select("page_id", "url", F.length("html").cast("bigint").alias("size"))
    second = table(spark, sf_dir, "pages").select("page_id", "url", F.length("html").cast("bigint").alias("size"))
    both = pages.collect_pages([first, second])
    once = pages.collect_pages([first, second], once_per_url=True)
    rows = both.withColumn("mode", F.lit("all")).unionByName(once.withColumn("mode", F.lit("once")))
    return rows.withColumn("search_no", F.col("search_no").cast("bigint"))


def candidates(spark, sf_dir):
    return shown(candidates_of(spark, sf_dir))


def candidate_rank(spark, sf_dir):
    return shown(ranked_of(spark, sf_dir)).select("candidate_rank", "crawl_pos", "name", "merit")


def candidate_rank_global(spark, sf_dir):
    ranked = pages.rank_candidates(candidates_of(spark, sf_dir), TOP, global_rank=True)
    return shown(ranked).select("candidate_rank", "crawl_pos", "name", "merit")


def candidate_fill(spark, sf_dir):
    """More candidates wanted than answers describe: the rest is synthetic."""
    texts = texts_of(spark, sf_dir)
    few = pages.describe_candidates(texts, page_responses(spark, sf_dir), QUERY, ["zz"])
    return shown(pages.fill_shortfall(few, texts, 12)).select(
        "candidate_rank", "crawl_pos", "name", "url", "columns", "synthetic_no", "merit"
    )


def candidate_fallback(spark, sf_dir):
    return shown(pages.fallback_descriptors(requests_of(spark, sf_dir), 3, "item_id", "text", "domain"))


def candidate_export(spark, sf_dir):
    return shown(pages.export_candidates(ranked_of(spark, sf_dir)))


def research_summary(spark, sf_dir):
    """Of the whole crawl: one descriptor a page."""
    found = pages.crawl_summary(candidates_of(spark, sf_dir), table(spark, sf_dir, "pages"))
    return found.withColumn("best_relevance", fixed(F.col("best_relevance")))


def domain_class(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", requests.domain_of(F.col("text")).alias("domain"))


def entities(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.array_join(requests.entities_of(F.col("text")), ",").alias("entities"))


def query_clean(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    cleaned = requests.clean_queries(docs, "text").withColumnRenamed("query", "cleaned")
    return requests.clean_queries(cleaned, "text", drop_stop_words=True).select("doc_id", "cleaned", "query")


def query_expand(spark, sf_dir):
    cleaned = requests.clean_queries(table(spark, sf_dir, "benchmark"), "text")
    rows = requests.expand_queries(cleaned)
    return rows.select("item_id", F.col("template_no").cast("bigint").alias("template_no"), "search_text")


QUERIES = {
    f.__name__: f
    for f in (
        page_links,
        page_text,
        page_filter,
        page_score,
        page_collect,
        candidates,
        candidate_rank,
        candidate_rank_global,
        candidate_fill,
        candidate_fallback,
        candidate_export,
        research_summary,
        domain_class,
        entities,
        query_clean,
        query_expand,
    )
}

HIDDEN_SQL = r"""regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
  '(?is)<script\b[^>]*>.*?</script\s*>', '', 'g'), '(?is)<style\b[^>]*>.*?</style\s*>', '', 'g')"""


# The references that the given pages hold, and the commonest others; the ampersand comes last.
REFERENCES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©"),
    ("&amp;", "&"),
]
TAG_REST = """(?:(?:[^>"'']|"[^"]*"|''[^'']*'')*>|[^>]*>)"""


def decoded_sql(text: str) -> str:
    for reference, character in REFERENCES:
        text = f"replace({text}, '{reference}', '{character.replace(chr(39), chr(39) * 2)}')"
    return text


TEXTS_SQL = rf"""texts AS (
  SELECT page_id, url, coalesce(regexp_replace({decoded_sql("title")}, '^\s+|\s+$', '', 'g'), 'No title') AS title,
    content, {decoded_sql(f"regexp_replace(content, '(?s)<{TAG_REST}', '', 'g')")} AS raw_text FROM (
    SELECT page_id, url, nullif(regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1), '') AS title,
      coalesce(nullif(regexp_extract(visible, '(?is)<article\b[^>]*>.*</article\s*>'), ''),
        nullif(regexp_extract(visible, '(?is)<main\b[^>]*>.*</main\s*>'), ''), visible) AS content
    FROM (SELECT page_id, url, html, {HIDDEN_SQL} AS visible FROM pages_abs)))"""


def any_sql(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


HOST_SQL = any_sql("lower(url)", pages.TRUSTED_HOSTS)
LENGTH_SQL = "CASE WHEN length(raw_text) > 500 THEN 0.1 ELSE 0 END + CASE WHEN length(raw_text) > 1000 THEN 0.1 ELSE 0 END"
CANDIDATES_SQL = f"""candidates AS (
  SELECT t.page_id AS crawl_pos, CASE kind WHEN 0 THEN concat('Set ', CAST(t.page_id AS VARCHAR)) ELSE title END AS name,
    CASE kind WHEN 0 THEN 'rows' ELSE 'Dataset related to {QUERY}' END AS description, url,
    CASE kind WHEN 0 THEN 'csv' ELSE 'unknown' END AS format,
    CASE kind WHEN 0 THEN '2 MB' ELSE 'Size not specified' END AS size_info,
    CASE kind WHEN 0 THEN 'id,value' ELSE '' END AS columns, concat('Web content from ', url) AS source_context,
    CAST(CASE kind WHEN 0 THEN CAST(concat('0.', CAST(t.page_id % 90 + 10 AS VARCHAR)) AS DOUBLE) ELSE 0.5 END AS DOUBLE)
      AS relevance_score,
    CAST(least(1.0, 0.5 + {LENGTH_SQL} + CASE kind WHEN 0 THEN 0.3 ELSE 0 END + CASE WHEN {HOST_SQL} THEN 0.2 ELSE 0 END)
      AS DOUBLE) AS data_quality_score, substr(raw_text, 1, 1000) AS extracted_content
  FROM (SELECT *, page_id % 4 AS kind FROM texts) t WHERE kind IN (0, 1) AND {any_sql("lower(raw_text)", MARKERS)}),
scored AS (SELECT *, (relevance_score + data_quality_score) / 2 AS merit FROM candidates),
ranked AS (SELECT *, row_number() OVER (ORDER BY merit DESC, crawl_pos) AS candidate_rank
  FROM (SELECT * FROM scored ORDER BY crawl_pos LIMIT {TOP}))"""
PAGE_BASE = ("pages_abs", TEXTS_SQL)
CANDIDATE_BASE = (*PAGE_BASE, CANDIDATES_SQL)
SCORES = f"{r4('relevance_score')} AS relevance_score, {r4('data_quality_score')} AS data_quality_score"

HREF = r"""(?is)\shref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))"""
LINKS_SQL = rf"""tags AS (
  SELECT page_id, regexp_extract_all({HIDDEN_SQL}, '(?is)<a\s{TAG_REST}') AS tags FROM pages_abs),
targets AS (
  SELECT page_id, [h for h in [{decoded_sql(f"concat(regexp_extract(t, '{HREF}', 1), regexp_extract(t, '{HREF}', 2), regexp_extract(t, '{HREF}', 3))")}
    for t in tags] if h <> ''] AS targets FROM tags),
links AS (
  SELECT page_id, [h for h in ([h for h in targets if contains(h, 'http')])[1:5] if starts_with(h, 'http')] AS found,
    [h for h in targets[1:5] if starts_with(h, 'http')] AS every FROM targets)
SELECT page_id, CAST(i - 1 AS BIGINT) AS position, chosen[i] AS link FROM (
  SELECT page_id, chosen, unnest(range(1, len(chosen) + 1)) AS i FROM (
    SELECT page_id, CASE WHEN len(found) > 0 THEN found ELSE every END AS chosen FROM links))"""

FALLBACK_SQL = """SELECT item_id, domain, CAST(n AS BIGINT) AS dataset_no,
  concat(CASE domain WHEN 'medical' THEN 'Medical Research Dataset ' WHEN 'financial' THEN 'Financial Analysis Dataset '
    ELSE 'Research Dataset ' END, CAST(n AS VARCHAR)) AS name,
  concat(CASE domain WHEN 'medical' THEN 'Clinical dataset containing patient information relevant to: '
    WHEN 'financial' THEN 'Financial dataset with market data relevant to: '
    ELSE 'Structured dataset relevant to: ' END, text) AS description,
  concat('synthetic_fallback_', CAST(n AS VARCHAR)) AS url, 'csv' AS format,
  concat('~', CAST(5 + 5 * n AS VARCHAR), 'KB estimated') AS size_info,
  CASE domain WHEN 'medical' THEN 'patient_id,age,gender,condition,treatment,outcome'
    WHEN 'financial' THEN 'date,symbol,price,volume,market_cap' ELSE 'id,category,value,status,date' END AS columns,
  concat('Synthetic Dataset - Generated for ', domain, ' domain') AS source_context,
  CAST(0.7 AS DOUBLE) AS relevance_score, CAST(0.75 AS DOUBLE) AS data_quality_score,
  'Fallback synthetic dataset' AS extracted_content FROM req, (SELECT unnest([1, 2, 3]) AS n)"""

STOP = list_sql(requests.QUERY_STOP_WORDS)
FILLED = """first AS (SELECT page_id, row_number() OVER (ORDER BY page_id) - 1 AS pos, count(*) OVER () AS n FROM pages),
made AS (SELECT page_id AS crawl_pos, i + 1 AS synthetic_no, concat('Synthetic Dataset ', CAST(i + 1 AS VARCHAR)) AS name
  FROM first, (SELECT unnest(range({k} - {have})) AS i) WHERE i % n = pos)"""

ORACLES = {
    "page_links": with_views("pages_abs", LINKS_SQL.split("\nSELECT page_id, CAST")[0])
    + "SELECT page_id, CAST"
    + LINKS_SQL.split("\nSELECT page_id, CAST")[1],
    "page_text": with_views(*PAGE_BASE) + "SELECT * FROM texts",
    "page_filter": with_views(*PAGE_BASE)
    + f"SELECT page_id, url FROM texts WHERE {any_sql('lower(raw_text)', pages.INDICATORS)}",
    "page_score": with_views(*PAGE_BASE)
    + f"""SELECT page_id, url, length(raw_text) AS text_length,
  {r4(f"least(1.0, 0.5 + {LENGTH_SQL} + CASE WHEN {HOST_SQL} THEN 0.2 ELSE 0 END)")} AS quality_score FROM texts""",
    "page_collect": with_views("pages_abs")
    + union_all(
        f"SELECT page_id, url, length(html) AS size, CAST({n} AS BIGINT) AS search_no, '{mode}' AS mode FROM {t}"
        for t, n, mode in (("pages_abs", 0, "all"), ("pages", 1, "all"), ("pages_abs", 0, "once"))
    ),
    "candidates": with_views(*CANDIDATE_BASE)
    + f"""SELECT crawl_pos, name, description, url, format, size_info, columns, source_context, {SCORES},
  extracted_content FROM candidates""",
    "candidate_rank": with_views(*CANDIDATE_BASE)
    + f"SELECT candidate_rank, crawl_pos, name, {r4('merit')} AS merit FROM ranked",
    "candidate_rank_global": with_views(*CANDIDATE_BASE)
    + f"""SELECT row_number() OVER (ORDER BY merit DESC, crawl_pos) AS candidate_rank, crawl_pos, name,
  {r4("merit")} AS merit FROM (SELECT * FROM scored ORDER BY merit DESC, crawl_pos LIMIT {TOP})""",
    "candidate_fill": with_views(
        *PAGE_BASE,
        CANDIDATES_SQL.replace(any_sql("lower(raw_text)", MARKERS), any_sql("lower(raw_text)", ["zz"])),
        "found AS (SELECT * FROM scored ORDER BY crawl_pos LIMIT 12)",
        FILLED.format(k=12, have="(SELECT count(*) FROM found)"),
    )
    + f"""SELECT row_number() OVER (ORDER BY merit DESC, synthetic_no, crawl_pos) AS candidate_rank, crawl_pos, name, url,
  columns, synthetic_no, {r4("merit")} AS merit FROM (
    SELECT crawl_pos, name, url, columns, CAST(0 AS BIGINT) AS synthetic_no, merit FROM found
    UNION ALL SELECT crawl_pos, name, 'synthetic_data', 'id,value', synthetic_no, CAST(0.75 AS DOUBLE) FROM made)""",
    "candidate_fallback": with_views(REQUESTS_SQL) + FALLBACK_SQL,
    "candidate_export": with_views(*CANDIDATE_BASE)
    + f"""SELECT candidate_rank, name, description, url, format, columns, source_context,
  {r4("relevance_score")} AS relevance_score, {r4("data_quality_score")} AS quality_score,
  CASE WHEN length(extracted_content) > 200 THEN concat(substr(extracted_content, 1, 200), '...')
    ELSE extracted_content END AS extracted_content_preview,
  (SELECT name FROM ranked ORDER BY candidate_rank LIMIT 1) AS best_dataset,
  (SELECT count(*) FROM ranked) AS total_available FROM ranked""",
    "research_summary": with_views(*CANDIDATE_BASE, "found AS (SELECT * FROM scored)")
    + f"""SELECT count(*) AS real_datasets, (SELECT count(*) FROM texts) - count(*) AS synthetic_datasets,
  (SELECT name FROM found ORDER BY merit DESC, crawl_pos LIMIT 1) AS top_real_dataset,
  {r4("max(relevance_score)")} AS best_relevance FROM found""",
    "domain_class": f"SELECT doc_id, {domain_sql('text')} AS domain FROM documents",
    "entities": rf"""SELECT doc_id, array_to_string(([w for w in regexp_split_to_array(text, '[^\p{{L}}\p{{N}}_]+')
  if regexp_full_match(w, '[a-zA-Z]{{3,}}') AND NOT list_contains({list_sql(requests.ENTITY_STOP_WORDS)}, lower(w))])[1:5],
  ',') AS entities FROM documents""",
    "query_clean": rf"""SELECT doc_id,
  substr(regexp_replace(regexp_replace(text, '[^a-zA-Z0-9\s]', '', 'g'), '^\s+|\s+$', '', 'g'), 1, 100) AS cleaned,
  CASE WHEN len(kept) > 0 THEN array_to_string(kept, ' ') ELSE text END AS query FROM (
    SELECT doc_id, text, [w for w in regexp_split_to_array(text, '\s+')
      if w <> '' AND NOT list_contains({STOP}, lower(w))] AS kept FROM documents)""",
    "query_expand": rf"""SELECT item_id, CAST(n AS BIGINT) AS template_no,
  concat(substr(regexp_replace(regexp_replace(text, '[^a-zA-Z0-9\s]', '', 'g'), '^\s+|\s+$', '', 'g'), 1, 100), ending)
    AS search_text
  FROM benchmark, (VALUES (0, ' dataset'), (1, ' data download'), (2, ' csv data'), (3, ' open data')) v(n, ending)""",
}
