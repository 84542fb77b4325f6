"""Landed API items to canonical articles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings import vocab
from tidings.functions import ids, text


def explode_responses(responses: DataFrame) -> DataFrame:
    """One row per item of each landed response, tagged with its envelope."""
    return responses.select(
        F.explode("articles.results").alias("raw_article"), "fetched_at", "topic_name", "topic_key")


def gate_topics(topics: DataFrame) -> DataFrame:
    """Topics with a ``configured`` flag; placeholder uris are not fetched."""
    return topics.withColumn("configured", ~F.col("uri").startswith(vocab.UNCONFIGURED_URI_PREFIX))


def canonical(items: DataFrame, now: Column | None = None) -> DataFrame:
    """Standard article rows; ``now`` stands in for a missing or bad date."""
    now = F.current_timestamp() if now is None else now
    a = F.col("raw_article")
    return items.select(
        ids.article_id(a["uri"], a["url"]).alias("doc_id"),
        F.coalesce(a["title"], F.lit("")).alias("title"),
        F.coalesce(a["body"], F.lit("")).alias("content"),
        text.description(a["body"]).alias("description"),
        F.coalesce(a["url"], F.lit("")).alias("link"),
        F.coalesce(text.parse_iso(a["dateTime"]), now).alias("published_at"),
        F.coalesce(a["source"]["title"], F.lit(vocab.UNKNOWN_SOURCE)).alias("source"),
        F.lit(vocab.SOURCE_TYPE).alias("source_type"),
        "topic_name", "topic_key",
        F.array("topic_name").alias("categories"),
        text.parse_iso(F.col("fetched_at")).alias("ingestion_timestamp"),
        F.struct(a["uri"].alias("uri"), a["sentiment"].alias("sentiment"),
                 a["wgt"].alias("wgt"), a["image"].alias("image")).alias("metadata"),
    )


def flatten(articles: DataFrame) -> DataFrame:
    """The 15-column table form: metadata fields become columns."""
    return articles.select(
        *[c for c in articles.columns if c != "metadata"],
        "metadata.sentiment", "metadata.wgt", "metadata.image")


def export_rows(items: DataFrame) -> DataFrame:
    """Interchange rows with relevance and similarity, absent scores as 0."""
    a = F.col("raw_article")
    key = F.replace(F.coalesce(a["uri"], F.lit("")), F.lit("/"), F.lit("_"))
    return items.select(
        F.when(key == "", F.concat(F.lit(vocab.DOC_ID_PREFIX), F.md5(F.coalesce(a["url"], F.lit("")))))
        .otherwise(key).alias("doc_id"),
        F.coalesce(a["title"], F.lit("")).alias("title"),
        F.coalesce(a["body"], F.lit("")).alias("content"),
        text.description(a["body"]).alias("description"),
        F.coalesce(a["url"], F.lit("")).alias("link"),
        F.coalesce(a["dateTime"], F.lit("")).alias("published_at"),
        F.coalesce(a["source"]["title"], F.lit(vocab.UNKNOWN_SOURCE)).alias("source"),
        F.lit(vocab.SOURCE_TYPE).alias("source_type"),
        F.col("topic_name").alias("topic"), text.slug(F.col("topic_name")).alias("topic_slug"),
        F.coalesce(a["relevance"], F.lit(0.0)).alias("relevance_score"),
        F.coalesce(a["sim"], F.lit(0.0)).alias("similarity_score"),
        F.filter(F.transform(a["categories"], lambda c: c["label"]),
                 lambda x: x.isNotNull() & (x != "")).alias("categories"),
        "fetched_at",
    )


def cap_per_topic(articles: DataFrame, topics: DataFrame, *order: Column) -> DataFrame:
    """First ``max_articles`` per topic in the given order.

    ``topics`` is the configuration dimension.  The largest limit prunes rows
    before the shuffle (rank limit inside each task), so a topic holding most
    of the articles sends only a handful of rows to its reducer.
    """
    limit = topics.agg(F.max("max_articles")).first()[0] or vocab.DEFAULT_MAX_ARTICLES
    w = Window.partitionBy("topic_key").orderBy(*order)
    ranked = articles.withColumn("position", F.row_number().over(w)).where(F.col("position") <= limit)
    return (ranked.join(topics.select("topic_key", "max_articles"), "topic_key")
            .where(F.col("position") <= F.col("max_articles")).drop("max_articles"))


def union_all(*frames: DataFrame) -> DataFrame:
    """Concatenation by name; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_per_key(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """Keep the first row per key.

    The rank-1 limit runs inside each task before the shuffle, so copies of
    one hot key collapse where they are read.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def run_log(topics: DataFrame, counts: DataFrame) -> DataFrame:
    """One record per topic: skipped when unconfigured, error when its counts
    row carries an error, success otherwise (also with no items)."""
    log = gate_topics(topics).join(counts, "topic_key", "left")
    error = F.col("error") if "error" in counts.columns else F.lit(None).cast("string")
    status = F.when(~F.col("configured"), "skipped").when(error.isNotNull(), "error").otherwise("success")
    return log.select(
        "topic_key", F.col("name").alias("topic_name"), status.alias("status"),
        F.when(status == "skipped", "URI not configured").alias("reason"), error.alias("error"),
        F.when(status == "skipped", F.lit(0)).otherwise(F.coalesce("items", F.lit(0))).cast("bigint").alias("items_processed"))


def run_summary(log: DataFrame) -> DataFrame:
    return log.agg(
        F.sum("items_processed").alias("total_articles"),
        F.count_if(F.col("status") == "success").alias("successful_topics"),
        F.count_if(F.col("status") == "error").alias("failed_topics"),
        F.count_if(F.col("status") == "skipped").alias("skipped_topics"))
