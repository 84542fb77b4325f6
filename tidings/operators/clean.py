"""Layered article models: staging, scored articles, intelligence mart."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings import vocab
from tidings.functions import text
from tidings.session import small

REQUIRED = ("id", "title", "content", "source", "timestamp")


def has_content() -> Column:
    return F.col("content").isNotNull() & (F.col("content") != "")


def is_valid(required=REQUIRED) -> Column:
    ok = F.lit(True)
    for name in required:
        ok = ok & F.col(name).isNotNull()
    return ok


def split_valid(items: DataFrame, required=REQUIRED) -> tuple[DataFrame, DataFrame]:
    return items.where(is_valid(required)), items.where(~is_valid(required))


def since(column: str, as_of: Column, days: int) -> Column:
    """Lookback window ending at ``as_of``."""
    return F.col(column) >= as_of - F.make_dt_interval(F.lit(days))


def staging(raw: DataFrame) -> DataFrame:
    """Rows with title, url and date; whitespace collapsed, source standardised."""
    keep = raw.dropna(subset=["title", "url", "published_at"])
    return keep.select(
        "article_id",
        text.collapse(F.col("title")).alias("title_clean"),
        text.collapse(F.col("content")).alias("content_clean"),
        text.collapse(F.col("description")).alias("description_clean"),
        "published_at", text.standard_source(F.col("source_name")).alias("source_name_standardized"),
        "url", "author", "url_to_image", "search_terms", "ingestion_timestamp")


def with_relevance(articles: DataFrame, entities: DataFrame) -> DataFrame:
    """Left join of extracted entity arrays, weighted score, wire boost, cap."""
    joined = articles.join(entities, "article_id", "left")
    score = reduce(lambda a, b: a + b, [
        F.coalesce(F.size(F.col(c)), F.lit(0)).cast("double") * F.lit(w) for c, w in vocab.RELEVANCE_WEIGHTS])
    boost = F.when(F.col("source_name_standardized").isin(*vocab.WIRE_SOURCES), vocab.WIRE_MULTIPLIER).otherwise(1.0)
    return (joined.withColumn("base_relevance_score", score)
            .withColumn("source_authority_multiplier", boost)
            .withColumn("final_relevance_score", F.least(
                F.col("base_relevance_score") * F.col("source_authority_multiplier"), F.lit(vocab.RELEVANCE_CAP))))


def priority(score: Column) -> Column:
    out = F.lit(vocab.PRIORITY_DEFAULT)
    for floor, label in reversed(vocab.PRIORITY_BANDS):
        out = F.when(score >= floor, label).otherwise(out)
    return out


def technology_flags(technologies: Column) -> list[Column]:
    line = F.array_join(technologies, ",")
    return [F.coalesce(reduce(or_, [line.ilike(p) for p in patterns]), F.lit(False)).alias(name)
            for name, patterns in vocab.TECHNOLOGY_FLAGS]


def mart(scored: DataFrame) -> DataFrame:
    """Articles with some relevance, prioritised and flagged."""
    score = F.col("final_relevance_score")
    return scored.where(score > 0).select(
        "article_id", F.col("title_clean").alias("title"), F.col("description_clean").alias("description"),
        F.col("content_clean").alias("content"), "published_at",
        F.col("source_name_standardized").alias("source_name"), "url", "author",
        "companies", "agencies", "technologies", "funding_mentions", "contract_mentions",
        "final_relevance_score", priority(score).alias("priority_level"),
        *technology_flags(F.col("technologies")), "ingestion_timestamp")


def keyword_table(spark, lists=None) -> DataFrame:
    rows = [(tag, k.lower()) for tag, words in (lists or vocab.SECTOR_KEYWORDS).items() for k in words]
    return spark.createDataFrame(rows, "tag string, keyword string")


def word_tags(docs: DataFrame, keywords: DataFrame) -> DataFrame:
    """(doc_num, tag) for single-word keywords: an equi-join on the word."""
    single = keywords.where(~F.col("keyword").contains(" ")).select(F.col("keyword").alias("term"), "tag")
    words = docs.select("doc_num", text.explode_tokens(F.array_distinct("tokens")).alias("term"))
    # a frequent word must not meet a shuffle by word
    return words.join(small(single, 100_000), "term").select("doc_num", "tag").distinct()


def phrase_tags(articles: DataFrame, lists=None) -> DataFrame:
    """(doc_num, tag) for keyword phrases of the fixed lists.

    Text and phrases are compared as space-separated tokens, so phrases match
    on whole words; one codegen pass over the text, no shuffle.
    """
    lists = lists or vocab.SECTOR_KEYWORDS
    line = F.concat(F.lit(" "), F.array_join(text.tokens(F.col("content")), " "), F.lit(" "))
    norm = {tag: [" " + " ".join(_words(k)) + " " for k in words] for tag, words in lists.items()}
    hits = [F.when(reduce(or_, [F.col("line").contains(k) for k in words]), F.lit(tag)) for tag, words in norm.items()]
    return (articles.select("doc_num", line.alias("line"))
            .select("doc_num", F.explode_outer(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("tag"))
            .where(F.col("tag").isNotNull()))


def _words(phrase: str) -> list[str]:
    return "".join(ch if ch.isalnum() else " " for ch in phrase.lower()).split()


def route(articles: DataFrame, terms=vocab.ROUTE_TERMS) -> DataFrame:
    """Flag articles whose content matches the routing alternation."""
    return articles.withColumn("matched", F.col("content").rlike(text.any_of(terms)))
