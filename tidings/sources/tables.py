"""Canonical views over the given parquet tables.

The tables carry no titles, dates or links, so those columns are derived
deterministically from the ones they do have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings import vocab
from tidings.functions import text
from tidings.session import configure

EPOCH_2024 = 1704067200  # 2024-01-01T00:00:00Z


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash ``df`` over all cores when its scan has fewer splits than cores.

    A large table always has more splits than cores and passes unchanged, so
    this never adds a shuffle at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def _at(num: Column) -> Column:
    return F.timestamp_seconds(F.lit(EPOCH_2024) + (num % 30) * 86400 + (num % 24) * 3600)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    num = F.col("doc_num")
    topic = F.concat(F.lit("t"), (F.regexp_extract("source", r"(\d+)", 1).cast("int") % 4).cast("string"))
    body = F.col("content")
    return (
        table(spark, sf_dir, "documents")
        .select(F.col("doc_id").alias("doc_num"), F.col("text").alias("content"), "lang", "source")
        .select(
            F.concat(F.lit("doc_"), num.cast("string")).alias("doc_id"), "doc_num",
            F.substring(text.first_line(body), 1, 100).alias("title"), "content",
            text.description(body).alias("description"),
            F.concat(F.lit("https://news.example.com/"), F.md5(body)).alias("link"),
            _at(num).alias("published_at"), "source",
            F.lit(vocab.SOURCE_TYPE).alias("source_type"),
            F.concat(F.lit("Topic "), topic).alias("topic_name"), topic.alias("topic_key"),
            F.array(F.concat(F.lit("Topic "), topic)).alias("categories"),
            (_at(num) + F.expr("INTERVAL 6 HOURS")).alias("ingestion_timestamp"), "lang",
            F.when(num % 5 != 0, ((num * 37) % 200 - 100) / F.lit(100.0)).alias("sentiment"),
            (num % 1000).cast("double").alias("wgt"),
            F.when(num % 3 != 0, F.concat(F.lit("https://img.example.com/"), num.cast("string"))).alias("image"),
        )
    )


COUNTRY_BY_LANG = {"en": "United States", "fr": "France", "es": "Spain"}


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as API items: one row per item with its envelope fields.

    Every tenth item has an empty uri; dates are missing or malformed in some;
    the country is unknown for languages without an entry.
    """
    num = F.col("doc_num")
    iso = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    country = F.create_map(*[F.lit(x) for kv in COUNTRY_BY_LANG.items() for x in kv])[F.col("lang")]
    raw = F.struct(
        F.when(num % 10 == 0, "").otherwise(
            F.concat(F.lit("news/"), F.col("source"), F.lit(":"), num.cast("string"))).alias("uri"),
        F.col("link").alias("url"), F.nullif("title", F.lit("")).alias("title"),
        F.col("content").alias("body"),
        F.date_format("published_at", "yyyy-MM-dd").alias("date"),
        F.when(num % 7 == 0, F.lit(None).cast("string")).when(num % 11 == 0, "soon").otherwise(iso).alias("dateTime"),
        F.col("sentiment"), F.col("wgt"),
        F.when(num % 4 != 0, (num % 100).cast("double")).alias("relevance"),
        F.when(num % 6 != 0, (num % 50) / F.lit(50.0)).alias("sim"), F.col("image"),
        F.struct(
            F.when(num % 17 != 0, F.col("source")).alias("title"),
            F.struct(F.struct(F.struct(country.alias("eng")).alias("label")).alias("country")).alias("location"),
        ).alias("source"),
        F.array(
            F.struct(F.lit("").alias("label")), F.struct(F.col("topic_name").alias("label")),
            F.struct(F.concat(F.lit("lang/"), F.col("lang")).alias("label")),
            F.struct(F.concat(F.lit("image/"), F.col("image").isNotNull().cast("string")).alias("label")),
            F.struct(F.concat(F.lit("source/"), F.col("source")).alias("label")),
        ).alias("categories"),
    )
    return articles(spark, sf_dir).select(
        raw.alias("raw_article"),
        F.date_format("ingestion_timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("fetched_at"),
        "topic_name", "topic_key", "doc_num",
    )


def doc_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_num"), "embedding")


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item is one query: its whole text and one query vector."""
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    return items.join(vectors, "query_id", "left")


def _key(prefix: str, col: str) -> Column:
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


def supplies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier -> part, one row per shipment."""
    return table(spark, sf_dir, "lineitem").select(
        _key("s:", "l_suppkey").alias("src"), _key("p:", "l_partkey").alias("dst"),
        F.lit("SUPPLIES").alias("type"), F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_extendedprice").alias("value"))


def awards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> supplier, one row per order line."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", "l_extendedprice")
    return o.join(li, "o_orderkey").select(
        _key("c:", "o_custkey").alias("src"), _key("s:", "l_suppkey").alias("dst"),
        F.lit("AWARDS").alias("type"), F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("l_extendedprice").alias("value"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LOCATED_IN customer/supplier -> nation, PARTICIPATES_IN nation -> region."""
    none_ts, none_value = F.lit(None).cast("timestamp").alias("ts"), F.lit(None).cast("double").alias("value")
    located = F.lit("LOCATED_IN").alias("type")
    c = table(spark, sf_dir, "customer").select(
        _key("c:", "c_custkey").alias("src"), _key("n:", "c_nationkey").alias("dst"), located, none_ts, none_value)
    s = table(spark, sf_dir, "supplier").select(
        _key("s:", "s_suppkey").alias("src"), _key("n:", "s_nationkey").alias("dst"), located, none_ts, none_value)
    n = table(spark, sf_dir, "nation").select(
        _key("n:", "n_nationkey").alias("src"), _key("r:", "n_regionkey").alias("dst"),
        F.lit("PARTICIPATES_IN").alias("type"), none_ts, none_value)
    return c.unionByName(s).unionByName(n)


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole relation table: src, dst, type, ts, value."""
    return supplies(spark, sf_dir).unionByName(awards(spark, sf_dir)).unionByName(places(spark, sf_dir))
