"""Fetched pages: links, texts, dataset candidates, ranking, summaries.

Pages come as a table (page_id, url, html); page_id is the crawl order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.functions import json_text
from rowsmith.functions.columns import computed_once, contains_any, count_where, strip_space

# Words that mark a dataset page, trusted hosts, score parts, limits, default texts.
INDICATORS = [
    "dataset", "csv", "download", "data", "columns", "rows", "kaggle", "github", "data.gov", "machine learning",
]
TRUSTED_HOSTS = ["kaggle.com", "github.com", "data.gov", "uci.edu"]
BASE_SCORE, LENGTH_BONUS, ANSWER_BONUS, HOST_BONUS = 0.5, 0.1, 0.15, 0.2
LENGTH_STEPS = [500, 1000]
MAX_LINKS = 15
EXCERPT = 1000
PREVIEW = 200
NO_TITLE = "No title"
SYNTHETIC = {
    "name": "Synthetic Dataset ",
    "description": "A synthetic dataset.",
    "url": "synthetic_data",
    "format": "csv",
    "size_info": "small",
    "columns": ["id", "value"],
    "source_context": "Generated synthetically",
    "relevance_score": 0.7,
    "data_quality_score": 0.8,
}

# Fallback descriptors by domain (name, description, columns).
FALLBACKS = {
    "medical": (
        "Medical Research Dataset ",
        "Clinical dataset containing patient information relevant to: ",
        ["patient_id", "age", "gender", "condition", "treatment", "outcome"],
    ),
    "financial": (
        "Financial Analysis Dataset ",
        "Financial dataset with market data relevant to: ",
        ["date", "symbol", "price", "volume", "market_cap"],
    ),
    "other": (
        "Research Dataset ",
        "Structured dataset relevant to: ",
        ["id", "category", "value", "status", "date"],
    ),
}
FALLBACK_RELEVANCE, FALLBACK_QUALITY = 0.7, 0.75

#: The rest of a tag up to its end, stepping over quoted attribute values that hold ``>``; a tag whose quotes do not
#: close ends at the first one.
TAG_REST = r"""(?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*>)"""
#: Character references by number and by name; a no-break space becomes a space.
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"
NAMED = {f"&{name};": chr(code) for name, code in name2codepoint.items() if name != "amp"} | {"&nbsp;": " ", "&#160;": " ", "&apos;": "'"}

PAGE_ANSWER = (
    "struct<is_dataset:boolean, dataset_name:string, description:string, file_format:string,"
    " estimated_columns:array<string>, data_size:string, download_available:boolean, relevance_to_query:double>"
)


def character(reference: Column) -> Column:
    """The character that a reference stands for; an unknown one stays as it is."""
    digits = F.substring_index(F.substring(reference, 3, 9), ";", 1)
    hexadecimal = F.lower(F.substring(digits, 1, 1)) == "x"
    code = F.when(hexadecimal, F.conv(F.substring(digits, 2, 8), 16, 10)).otherwise(digits).try_cast("bigint")
    real = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    known = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    names = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])
    numbered = F.startswith(reference, F.lit("&#"))
    return F.coalesce(F.try_element_at(names, reference), F.when(numbered & real, known), reference)


def decoded(text: Column) -> Column:
    """Character references turned into characters, each kind once; the ampersand comes last, so that no text is
    decoded twice. The text is computed once, and only one with an ampersand is searched."""

    def replaced(t: Column) -> Column:
        found = F.filter(F.array_distinct(F.regexp_extract_all(t, F.lit(REFERENCE), F.lit(0))), lambda r: r != "&amp;")
        return F.replace(F.aggregate(found, t, lambda done, r: F.replace(done, r, character(r))), F.lit("&amp;"), F.lit("&"))

    return F.get(F.transform(F.array(text), lambda t: F.when(F.contains(t, F.lit("&")), replaced(t)).otherwise(t)), F.lit(0))


def without_hidden(html: Column) -> Column:
    """HTML without comments, scripts and styles."""
    for pattern in (
        r"(?s)<!--.*?-->",
        r"(?is)<script\b[^>]*>.*?</script\s*>",
        r"(?is)<style\b[^>]*>.*?</style\s*>",
    ):
        html = F.regexp_replace(html, pattern, "")
    return html


def plain_text(html: Column) -> Column:
    """Text of HTML whose hidden parts are gone."""
    return decoded(F.regexp_replace(html, "(?s)<" + TAG_REST, ""))


def href(tag: Column) -> Column:
    """Link target of an anchor tag; empty without one."""
    pattern = r"""(?is)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
    return decoded(F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]))


def extract_links(pages: DataFrame, max_links: int = MAX_LINKS) -> DataFrame:
    """Absolute links of each page, in order: (page_id, position, link).

    Anchors of class result-link win over anchors with http in the target. The cap counts anchors before the
    ones that do not start with http are dropped. If nothing remains, all anchors are taken under the same
    cap. (Other result classes can not add a link: their targets would already hold http.)
    """
    anchors = F.regexp_extract_all(without_hidden(F.col("html")), F.lit(r"(?is)<a\s" + TAG_REST), F.lit(0))
    classed = F.filter("tags", lambda t: F.rlike(t, F.lit(r"""(?is)\sclass\s*=\s*["'](?:[^"']*\s)?result-link["'\s]""")))
    targets = F.filter(F.transform("tags", href), lambda h: h != "")

    def absolute(links):
        return F.filter(F.slice(links, 1, max_links), lambda h: F.startswith(h, F.lit("http")))

    with_http = F.filter("targets", lambda h: F.contains(h, F.lit("http")))
    chosen = F.when(F.size("classed") > 0, absolute(F.transform("classed", href))).otherwise(absolute(with_http))
    return (
        pages.select("page_id", anchors.alias("tags"))
        .select("page_id", classed.alias("classed"), targets.alias("targets"))
        .select("page_id", chosen.alias("links"), absolute(F.col("targets")).alias("every"))
        .select("page_id", F.posexplode(F.when(F.size("links") > 0, F.col("links")).otherwise(F.col("every"))).alias("position", "link"))
    )


def extract_page_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, title, content, raw_text): main HTML (article, main, or the whole page) and its text."""
    found = F.nullif(F.regexp_extract("html", r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1), F.lit(""))
    title = F.coalesce(strip_space(decoded(found)), F.lit(NO_TITLE))
    visible = pages.select("page_id", "url", title.alias("title"), without_hidden(F.col("html")).alias("visible"))
    content = F.coalesce(
        *[
            F.nullif(F.regexp_extract("visible", rf"(?is)<{tag}\b[^>]*>.*</{tag}\s*>", 0), F.lit(""))
            for tag in ("article", "main")
        ],
        "visible",
    )
    main = visible.select("page_id", "url", "title", content.alias("html"))
    return computed_once(main, ["page_id", "url", "title"], content=F.col("html"), raw_text=plain_text(F.col("html")))


def filter_dataset_pages(texts: DataFrame, indicators: Sequence[str] = INDICATORS) -> DataFrame:
    """Pages whose text holds one of the indicator words."""
    lowered = computed_once(texts, texts.columns, low=F.lower("raw_text"))
    return lowered.filter(contains_any(F.col("low"), indicators)).drop("low")


def quality_score(length: Column, url: Column, has_columns: Column, has_download: Column) -> Column:
    """0.5 and bonuses for length, known columns, a download and a trusted host, at most 1."""
    def bonus(condition, value):
        return F.when(condition, F.lit(value)).otherwise(F.lit(0.0))

    score = F.lit(BASE_SCORE)
    for step in LENGTH_STEPS:
        score = score + bonus(length > step, LENGTH_BONUS)
    score = score + bonus(has_columns, ANSWER_BONUS) + bonus(has_download, ANSWER_BONUS)
    score = score + bonus(contains_any(F.lower(url), TRUSTED_HOSTS), HOST_BONUS)
    return F.least(F.lit(1.0), score)


def page_scores(texts: DataFrame) -> DataFrame:
    """Score of each page by itself, before any answer about it is known."""
    return texts.select(
        "page_id",
        "url",
        F.length("raw_text").cast("bigint").alias("text_length"),
        quality_score(F.length("raw_text"), F.col("url"), F.lit(False), F.lit(False)).alias("quality_score"),
    )


def describe_candidates(
    texts: DataFrame, responses: DataFrame, query: str, indicators: Sequence[str] = INDICATORS
) -> DataFrame:
    """Dataset descriptors from pages and the answers given about them.

    Pages are cut down to title, length and excerpt before the join, so the shuffle does not carry texts.
    """
    slim = filter_dataset_pages(texts, indicators).select(
        "page_id",
        "url",
        "title",
        F.length("raw_text").alias("text_length"),
        F.substring("raw_text", 1, EXCERPT).alias("extracted_content"),
    )
    json = json_text.valid_json(json_text.object_span(F.col("response")))
    answers = computed_once(responses, ["page_id"], a=json_text.parse_as(json, PAGE_ANSWER)).filter("a.is_dataset")
    columns = F.coalesce("a.estimated_columns", F.array().cast("array<string>"))
    return slim.join(answers, "page_id").select(
        F.col("page_id").alias("crawl_pos"),
        F.coalesce("a.dataset_name", "title").alias("name"),
        F.coalesce("a.description", F.lit(f"Dataset related to {query}")).alias("description"),
        "url",
        F.coalesce("a.file_format", F.lit("unknown")).alias("format"),
        F.coalesce("a.data_size", F.lit("Size not specified")).alias("size_info"),
        columns.alias("columns"),
        F.concat(F.lit("Web content from "), F.col("url")).alias("source_context"),
        F.coalesce("a.relevance_to_query", F.lit(0.5)).alias("relevance_score"),
        quality_score(
            F.col("text_length"),
            F.col("url"),
            F.size(columns) > 0,
            F.coalesce("a.download_available", F.lit(False)),
        ).alias("data_quality_score"),
        "extracted_content",
    )


def merit() -> Column:
    return (F.col("relevance_score") + F.col("data_quality_score")) / 2


def rank_candidates(candidates: DataFrame, k: int, global_rank: bool = False) -> DataFrame:
    """First k candidates of the crawl in order of merit; with global_rank the k best of all.

    Both ways are a bounded top-k; the rank runs over at most k rows.
    """
    order = [F.desc("merit"), F.col("crawl_pos")]
    scored = candidates.withColumn("merit", merit())
    best = scored.orderBy(*order).limit(k) if global_rank else scored.orderBy("crawl_pos").limit(k)
    return best.withColumn("candidate_rank", F.row_number().over(Window.orderBy(*order)))


def fill_shortfall(candidates: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """First k candidates, filled up to k with synthetic descriptors, ranked by merit.

    The i-th synthetic one stands for page i modulo the number of pages. Only the first k pages can be hit,
    or all of them when there are fewer, so no numbering of the whole crawl is needed.
    """
    found = candidates.orderBy("crawl_pos").limit(k).withColumn("synthetic_no", F.lit(0).cast("bigint"))
    have = found.agg(F.count(F.lit(1)).alias("n")).scalar()
    everything = Window.orderBy("page_id")
    first = (
        texts.select("page_id")
        .orderBy("page_id")
        .limit(k)
        .withColumn("pos", F.row_number().over(everything) - 1)
        .withColumn("pages", F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))))
        .withColumn("missing", F.lit(k) - have)
    )
    # Numbers of the synthetic descriptors that fall on this page: pos, pos + pages, pos + 2 x pages, ...
    pos, step, last = (F.col(c).cast("bigint") for c in ("pos", "pages", "missing"))
    numbers = F.when(pos < last, F.sequence(pos, last - 1, step))
    made = first.select(F.col("page_id").alias("crawl_pos"), F.explode(numbers).alias("i")).select(
        "crawl_pos",
        F.concat(F.lit(SYNTHETIC["name"]), (F.col("i") + 1).cast("string")).alias("name"),
        *[F.lit(SYNTHETIC[c]).alias(c) for c in ("description", "url", "format", "size_info")],
        F.array(*[F.lit(c) for c in SYNTHETIC["columns"]]).alias("columns"),
        *[F.lit(SYNTHETIC[c]).alias(c) for c in ("source_context", "relevance_score", "data_quality_score")],
        F.lit("").alias("extracted_content"),
        (F.col("i") + 1).cast("bigint").alias("synthetic_no"),
    )
    order = Window.orderBy(F.desc("merit"), "synthetic_no", "crawl_pos")
    return (
        found.unionByName(made)
        .withColumn("merit", merit())
        .withColumn("candidate_rank", F.row_number().over(order))
    )


def fallback_descriptors(requests: DataFrame, k: int, request_id: str, text: str, domain: str) -> DataFrame:
    """k fixed descriptors per request by its domain."""
    def by_domain(pick):
        return (
            F.when(F.col(domain) == "medical", pick(FALLBACKS["medical"]))
            .when(F.col(domain) == "financial", pick(FALLBACKS["financial"]))
            .otherwise(pick(FALLBACKS["other"]))
        )

    i = F.col("i")
    rows = requests.select(request_id, text, domain, F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("i"))
    return rows.select(
        request_id,
        domain,
        (i + 1).cast("bigint").alias("dataset_no"),
        F.concat(by_domain(lambda f: F.lit(f[0])), (i + 1).cast("string")).alias("name"),
        F.concat(by_domain(lambda f: F.lit(f[1])), F.col(text)).alias("description"),
        F.concat(F.lit("synthetic_fallback_"), (i + 1).cast("string")).alias("url"),
        F.lit("csv").alias("format"),
        F.concat(F.lit("~"), (i * 5 + 10).cast("string"), F.lit("KB estimated")).alias("size_info"),
        by_domain(lambda f: F.array(*[F.lit(c) for c in f[2]])).alias("columns"),
        F.concat(F.lit("Synthetic Dataset - Generated for "), F.col(domain), F.lit(" domain")).alias("source_context"),
        F.lit(FALLBACK_RELEVANCE).alias("relevance_score"),
        F.lit(FALLBACK_QUALITY).alias("data_quality_score"),
        F.lit("Fallback synthetic dataset").alias("extracted_content"),
    )


def export_candidates(ranked: DataFrame) -> DataFrame:
    """Hand-over form: preview instead of excerpt, name of the best candidate, number of candidates."""
    content = F.col("extracted_content")
    preview = F.when(F.length(content) > PREVIEW, F.concat(F.substring(content, 1, PREVIEW), F.lit("..."))).otherwise(content)
    facts = ranked.agg(
        F.min_by("name", "candidate_rank").alias("best_dataset"), F.count(F.lit(1)).alias("total_available")
    ).select(F.struct("*").alias("all"))
    return ranked.withColumn("f", facts.scalar()).select(
        "candidate_rank",
        "name",
        "description",
        "url",
        "format",
        "columns",
        "source_context",
        "relevance_score",
        F.col("data_quality_score").alias("quality_score"),
        preview.alias("extracted_content_preview"),
        "f.best_dataset",
        "f.total_available",
    )


def crawl_summary(candidates: DataFrame, texts: DataFrame) -> DataFrame:
    """research_summary of a whole crawl filled up to one descriptor a page, without making or ranking any: counts, and the
    best real name by merit, from partial aggregates."""
    real = ~F.startswith("url", F.lit("synthetic"))
    best = F.when(real, F.struct((-F.col("merit")).alias("less"), "crawl_pos"))
    pages = texts.agg(F.count(F.lit(1))).scalar()
    return (
        candidates.withColumn("merit", merit())
        .agg(
            count_where(real).alias("real_datasets"),
            count_where(~real).alias("others"),
            F.count(F.lit(1)).alias("candidates"),
            F.min_by("name", best).alias("top_real_dataset"),
            F.max(F.when(real, F.col("relevance_score"))).alias("best_relevance"),
        )
        .select(
            "real_datasets",
            (F.col("others") + F.greatest(pages - F.col("candidates"), F.lit(0))).alias("synthetic_datasets"),
            "top_real_dataset",
            "best_relevance",
        )
    )


def research_summary(ranked: DataFrame) -> DataFrame:
    """Real and synthetic candidates, best real name, highest relevance among the real ones."""
    real = ~F.startswith("url", F.lit("synthetic"))
    return ranked.agg(
        count_where(real).alias("real_datasets"),
        count_where(~real).alias("synthetic_datasets"),
        F.min_by("name", F.when(real, F.col("candidate_rank"))).alias("top_real_dataset"),
        F.max(F.when(real, F.col("relevance_score"))).alias("best_relevance"),
    )


def collect_pages(parts: Sequence[DataFrame], once_per_url: bool = False) -> DataFrame:
    """Pages of all searches together, numbered by search; a url may appear several times.

    With once_per_url the first find of each url stays; tasks pass on at most one row per url.
    """
    pages = reduce(DataFrame.unionByName, [p.withColumn("search_no", F.lit(i)) for i, p in enumerate(parts)])
    if not once_per_url:
        return pages
    first = Window.partitionBy("url").orderBy("search_no", "page_id")
    return pages.withColumn("find", F.row_number().over(first)).filter("find = 1").drop("find")
