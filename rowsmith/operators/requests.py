"""Requests as a table of texts: domain, entities, cleaned and expanded search texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.functions.columns import col, contains_any, strip_space

# Keywords per domain in order of precedence, stop words, search templates, limits.
DOMAIN_KEYWORDS = {
    "medical": [
        "health", "medical", "patient", "disease", "doctor", "hospital", "drug", "treatment", "liver", "alcohol",
        "clinical",
    ],
    "financial": [
        "money", "stock", "price", "market", "finance", "bank", "investment", "economic", "trading",
    ],
    "education": ["student", "school", "education", "grade", "academic", "university", "learning"],
    "technology": ["software", "tech", "computer", "programming", "ai", "machine learning", "data science"],
    "business": ["customer", "sales", "business", "company", "revenue", "marketing", "profit"],
}
GENERAL = "general"
ENTITY_STOP_WORDS = ["the", "and", "for", "with", "data", "dataset"]
QUERY_STOP_WORDS = ["data", "dataset", "information", "analysis", "study", "research"]
TEMPLATES = [
    "{query} dataset",
    "{query} data download",
    "{query} csv data",
    "{query} open data",
    "{query} machine learning dataset",
    "site:kaggle.com {query}",
    "site:data.gov {query}",
    "site:github.com {query} dataset",
]
TEMPLATES_USED = 4
ENTITIES = 5
QUERY_LENGTH = 100


def domain_of(text: Column, keywords: dict[str, list[str]] | None = None) -> Column:
    """First domain with one of its keywords anywhere in the text, else general."""
    lower = F.lower(text)
    found = F.lit(GENERAL)
    for domain, words in reversed(list((DOMAIN_KEYWORDS if keywords is None else keywords).items())):
        found = F.when(contains_any(lower, words), F.lit(domain)).otherwise(found)
    return found


def entities_of(text: Column, n: int = ENTITIES) -> Column:
    """First n words of three or more ASCII letters that are no stop words, repeats included."""
    words = F.split(text, r"[^\p{L}\p{N}_]+")
    wanted = F.filter(
        words, lambda w: F.rlike(w, F.lit("^[a-zA-Z]{3,}$")) & ~F.lower(w).isin(ENTITY_STOP_WORDS)
    )
    return F.slice(wanted, 1, n)


def cleaned(text: Column, most: int = QUERY_LENGTH) -> Column:
    """ASCII letters, digits and white space only, trimmed, cut to a number of characters."""
    return F.substring(strip_space(F.regexp_replace(text, r"[^a-zA-Z0-9\s]", "")), 1, most)


def without_stop_words(text: Column) -> Column:
    """Words other than the stop words, joined by blanks; the text itself if none is left."""
    words = F.filter(F.split(text, r"\s+"), lambda w: (w != "") & ~F.lower(w).isin(QUERY_STOP_WORDS))
    return F.when(F.size(words) > 0, F.array_join(words, " ")).otherwise(text)


def understand(requests: DataFrame, text: str) -> DataFrame:
    """Adds domain and key entities of each request."""
    return requests.withColumns({"domain": domain_of(col(text)), "key_entities": entities_of(col(text))})


def clean_queries(requests: DataFrame, text: str, drop_stop_words: bool = False) -> DataFrame:
    """Adds the cleaned search text."""
    return requests.withColumn("query", without_stop_words(col(text)) if drop_stop_words else cleaned(col(text)))


def expand_queries(
    requests: DataFrame, query: str = "query", templates: Sequence[str] = TEMPLATES, used: int = TEMPLATES_USED
) -> DataFrame:
    """One search text per request and template; the templates are a constant on the row, not a join."""
    texts = F.array(*[F.lit(t) for t in templates[:used]])
    return requests.select("*", F.posexplode(texts).alias("template_no", "template")).select(
        *[col(c) for c in requests.columns],
        "template_no",
        F.replace(F.col("template"), F.lit("{query}"), col(query)).alias("search_text"),
    )
