"""Readers for landed files: topic responses, feeds, agency and query results.

Each reader turns files into canonical rows.  ``SOURCES`` is the plug-in
registry: a name and a function from (session, path) to those rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings import schemas, vocab
from tidings.functions import ids, text
from tidings.operators import ingest

CANONICAL = ("id", "title", "content", "description", "link", "published_at", "source", "source_type", "categories")


def topic_responses(spark: SparkSession, path: str) -> DataFrame:
    """Raw items of landed topic responses; one envelope per line."""
    return ingest.explode_responses(spark.read.schema(schemas.RAW_RESPONSE).json(path))


def topic_articles(spark: SparkSession, path: str) -> DataFrame:
    a = ingest.canonical(topic_responses(spark, path))
    return a.select(F.col("doc_id").alias("id"), *[c for c in CANONICAL if c != "id"])


def rss_items(spark: SparkSession, path: str) -> DataFrame:
    """Feed items; a missing tag is '' (a missing date is null)."""
    items = spark.read.format("xml").option("rowTag", "item").schema(schemas.RSS_ITEM).load(path)
    day = F.regexp_replace(F.col("pubDate"), r"^[A-Za-z]+,\s*", "")
    link = F.coalesce("link", F.lit(""))
    return items.select(
        F.concat(F.lit("defense_news_"), ids.url_md5(link)).alias("id"), F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("description", F.lit("")).alias("content"), F.coalesce("description", F.lit("")).alias("description"),
        link.alias("link"), F.try_to_timestamp(day, F.lit("dd MMM yyyy HH:mm:ss Z")).alias("published_at"),
        F.lit("Defense News").alias("source"), F.lit(vocab.SOURCE_TYPE).alias("source_type"),
        F.array().cast("array<string>").alias("categories"))


def agency_items(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(schemas.AGENCY_RESPONSE).json(path).select(F.explode("items").alias("i"))
    return rows.select(
        F.concat(F.lit("darpa_"), F.col("i.id")).alias("id"), "i.title", F.col("i.body").alias("content"),
        F.col("i.excerpt").alias("description"), F.col("i.url").alias("link"), text.parse_iso(F.col("i.date")).alias("published_at"),
        F.lit("DARPA").alias("source"), F.coalesce("i.type", F.lit("announcement")).alias("source_type"),
        F.coalesce("i.categories", F.array().cast("array<string>")).alias("categories"))


def _query_schema():
    from pyspark.sql.types import StringType, StructType
    return StructType(list(schemas.QUERY_RESPONSE.fields)).add("_corrupt_record", StringType())


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line of the query results that are not valid JSON; lines read =
    lines kept + these.  Empty lines are neither."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    parsed = lines.withColumn("_p", F.from_json("line", _query_schema(), {"mode": "PERMISSIVE"}))
    return parsed.where((F.trim("line") != "") & F.col("_p._corrupt_record").isNotNull()).drop("_p")


def query_items(spark: SparkSession, path: str, published_from=None, published_to=None, sources: tuple[str, ...] | None = None) -> DataFrame:
    """Keyword-query results tagged with their query, within a date range
    (both ends included) and a list of sources where given.

    Broken lines are left out (``rejected_lines`` has them); a URL found by
    several queries is kept once.
    """
    rows = spark.read.schema(_query_schema()).option("mode", "PERMISSIVE").json(path)
    a = rows.where(F.col("_corrupt_record").isNull()).select("query", F.explode("articles").alias("a"))
    out = a.select(
        F.concat(F.lit("newsapi_"), ids.url_md5(F.col("a.url"))).alias("id"), "a.title", "a.content", "a.description",
        F.col("a.url").alias("link"), text.parse_iso(F.col("a.publishedAt")).alias("published_at"),
        F.coalesce("a.source.name", F.lit("Unknown")).alias("source"), F.lit(vocab.SOURCE_TYPE).alias("source_type"),
        F.array("query").alias("categories"))
    for given, keep in ((published_from, lambda: F.col("published_at") >= published_from), (published_to, lambda: F.col("published_at") <= published_to),
                        (sources, lambda: F.col("source").isin(*sources))):
        out = out.where(keep()) if given is not None else out
    return ingest.first_per_key(out, "link", F.element_at("categories", 1))


def staged_array(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON array files: one array of rows per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


SOURCES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "topics": topic_articles, "defense_news": rss_items, "darpa": agency_items, "newsapi": query_items,
}


def load(spark: SparkSession, name: str, path: str) -> DataFrame:
    return SOURCES[name](spark, path)


def inventory(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Files below a folder; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
            .load(path).select("path", "length", "modificationTime"))
