"""Queries: article-set analysis, facets, projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.functions import text
from tidings.operators import ingest, profile, sketches
from tidings.plans import common
from tidings.plans.sql import ARTICLES, RAW, TOKENS, GAZETTEER, with_
from tidings.session import materialize, scratch, small
from tidings.sources import tables


def top_sources(spark, sf):
    return profile.top_counts(tables.raw_items(spark, sf), profile.source_name(), "source", 15)


def by_date(spark, sf):
    return profile.newest_counts(tables.raw_items(spark, sf), F.col("raw_article.date"), "day", 7)


def by_publish_day(spark, sf):
    """Every day of the parsed dateTime; unparsable values are dropped."""
    day = text.day_key(text.parse_iso(F.col("raw_article.dateTime")))
    return profile.newest_counts(tables.raw_items(spark, sf), day, "day")


def by_category(spark, sf):
    return profile.top_counts(profile.category_labels(tables.raw_items(spark, sf)), F.col("category"), "category", 10)


def by_country(spark, sf):
    return profile.top_counts(tables.raw_items(spark, sf), profile.country_name(), "country", 10)


def score_stats(spark, sf):
    return profile.score_stats(tables.raw_items(spark, sf), "relevance", "sim")


def length_stats(spark, sf):
    return profile.length_stats(tables.raw_items(spark, sf), "body", "title")


def completeness(spark, sf):
    return profile.completeness(tables.raw_items(spark, sf), "topic_name")


def cross_topic_sources(spark, sf):
    return profile.sources_across_topics(_two_feeds(spark, sf))


def _two_feeds(spark, sf):
    """Items as delivered by their own topic and again by a combined topic."""
    items = tables.raw_items(spark, sf)
    again = items.where(F.col("raw_article.wgt") >= 500).withColumn("topic_name", F.lit("Topic all"))
    return items.unionByName(again)


def topic_sources(spark, sf):
    return profile.topic_sources(_two_feeds(spark, sf))


def date_coverage(spark, sf):
    return profile.date_coverage(tables.raw_items(spark, sf))


def dup_urls(spark, sf):
    return profile.duplicate_urls(tables.raw_items(spark, sf))


def field_profile(spark, sf):
    return profile.field_profile(tables.raw_items(spark, sf), "raw_article")


def facets(spark, sf):
    out = profile.facets(tables.articles(spark, sf), ("source",), ("topic_name",), ("source_type",), ("source", "topic_name"))
    return out.select(*[F.coalesce(c, F.lit("*")).alias(c) for c in ("source", "topic_name", "source_type")], "n")


def entity_facets(spark, sf):
    """Facet counts of the array fields of the entity index."""
    _, _, found = common.found(spark, sf)
    t = F.col("type")
    field = (F.when(t == "Company", "companies").when(t == "Technology", "technologies").otherwise("agencies"))
    return (found.groupBy(field.alias("field"), F.col("alias").alias("value")).agg(F.count("*").alias("n")))


def embed_text(spark, sf):
    a = tables.articles(spark, sf).withColumn("body", F.when(F.col("doc_num") % 9 != 0, F.col("content")))
    return a.select("doc_id", F.md5(text.embedding_text(F.col("title"), F.col("body"), F.col("description"))).alias("embed_md5"),
                    F.md5(text.nlp_text(F.col("description"), F.col("body"))).alias("nlp_md5"))


def search_doc(spark, sf):
    """Index rows: '' for absent text, link as url, typed dates."""
    vec = tables.doc_vectors(spark, sf)
    a = tables.articles(spark, sf).join(vec, "doc_num", "left")
    return a.select(
        "doc_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("title", "source", "topic_name", "topic_key", "image")],
        F.coalesce("link", F.lit("")).alias("url"), F.md5(F.coalesce("content", F.lit(""))).alias("content_md5"),
        common.iso("published_at"), common.iso("ingestion_timestamp"),
        F.coalesce(F.size("embedding"), F.lit(0)).cast("bigint").alias("dims"))


def preview_slug(spark, sf):
    a = F.col("raw_article")
    rows = tables.raw_items(spark, sf)
    exported = ingest.export_rows(rows).select("doc_id", "topic_slug", "relevance_score", "similarity_score",
                                               F.size("categories").cast("bigint").alias("labels"),
                                               F.md5(text.preview(F.col("content"))).alias("preview_md5"),
                                               F.md5(text.one_line(F.col("content"))).alias("line_md5"),
                                               F.length("description").cast("bigint").alias("description_chars"))
    dates = rows.select(
        F.concat(F.lit("doc_"), F.col("doc_num").cast("string")).alias("doc_id"),
        text.slug(F.col("topic_name")).alias("topic_slug"), F.lit(None).cast("double").alias("relevance_score"),
        F.lit(None).cast("double").alias("similarity_score"), F.lit(None).cast("bigint").alias("labels"),
        text.day_key(text.parse_iso(a["dateTime"]), "yyyy/MM/dd").alias("preview_md5"),
        text.category_labels(a["categories"]).alias("line_md5"), F.lit(None).cast("bigint").alias("description_chars"))
    return exported.unionByName(dates)


BROADCAST_KEYS = 200_000   # merged rows broadcast at most
PERIODS = (("early", "2024-01-01", "2024-01-10"), ("middle", "2024-01-05", "2024-01-24"), ("whole", "2024-01-01", "2024-01-31"))


def range_sketches(spark, sf):
    """Day sketches merged for ranges of days: rows, and whether distinct urls,
    distinct sources and the median length agree with the exact values within
    the stated errors."""
    a = tables.articles(spark, sf).select("topic_name", "source", F.col("link").alias("url"), F.length("content").cast("bigint").alias("length"),
                                          F.date_format("published_at", "yyyy-MM-dd").alias("date"))
    root = scratch(spark, "sketches")
    sketches.store(sketches.day_sketches(a, "date", ["topic_name"], ["url", "source"], ["length"]), root, "all")
    kept = sketches.stored(spark, root).withColumn("day", F.col("day").cast("string"))
    def of(rows, day):
        within = [F.when(F.col(day).between(first, last), F.lit(name)) for name, first, last in PERIODS]
        return rows.withColumn("period", F.explode(F.array_compact(F.array(*within))))
    keys = ["period", "topic_name"]
    about = materialize(sketches.merged(of(kept, "day"), keys, ["url", "source"], ["length"]), "merged")
    exact = of(a, "date").join(small(about.select(*keys, "length_at"), BROADCAST_KEYS), keys).groupBy(*keys).agg(
        F.count_distinct("url").alias("urls"), F.count_distinct("source").alias("sources"), F.count("length").alias("lengths"),
        F.count_if(F.col("length") < F.col("length_at")).alias("below"), F.count_if(F.col("length") <= F.col("length_at")).alias("upto"))
    def near(estimate, true):
        return F.abs(F.col(estimate) - F.col(true)) <= F.col(true) * sketches.DISTINCT_ERROR
    middle = ((F.col("below") <= F.col("lengths") * (0.5 + sketches.RANK_ERROR)) & (F.col("upto") >= F.col("lengths") * (0.5 - sketches.RANK_ERROR)))
    return about.join(exact, keys).select(*keys, "n", near("url_distinct", "urls").alias("urls_within"), near("source_distinct", "sources").alias("sources_within"), middle.alias("median_within"))


QUERIES = {f.__name__: f for f in (
    top_sources, by_date, by_publish_day, by_category, by_country, score_stats, length_stats, completeness,
    cross_topic_sources, topic_sources, date_coverage, dup_urls, field_profile, facets, entity_facets,
    embed_text, search_doc, preview_slug, range_sketches)}

_TWO = "two AS (SELECT * FROM raw UNION ALL SELECT * REPLACE ('Topic all' AS topic_name) FROM raw WHERE wgt >= 500)"
_LABELS = """
labels_ AS (
  SELECT topic_name AS category FROM raw UNION ALL SELECT 'lang/' || lang FROM raw
  UNION ALL SELECT 'image/' || (image IS NOT NULL)::VARCHAR FROM raw UNION ALL SELECT 'source/' || source FROM raw)
"""
_FIELDS = (("uri", "string", "uri"), ("url", "string", "url"), ("title", "string", "title"), ("body", "string", "body"),
           ("date", "string", "day"), ("dateTime", "string", "dtx"), ("sentiment", "double", "sentiment"), ("wgt", "double", "wgt"),
           ("relevance", "double", "relevance"), ("sim", "double", "sim"), ("image", "string", "image"),
           ("source", "struct", "1"), ("categories", "array", "1"))

ORACLES = {
    "range_sketches": with_(ARTICLES, "p AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{a}', '{b}')" for n, a, b in PERIODS) + ") v(period, first_day, last_day))", body="""
SELECT period, topic_name, count(*) AS n, true AS urls_within, true AS sources_within, true AS median_within
FROM articles JOIN p ON strftime(published_at, '%Y-%m-%d') BETWEEN first_day AND last_day GROUP BY 1, 2"""),
    "top_sources": with_(ARTICLES, RAW, body="SELECT coalesce(source_title, 'Unknown') AS source, count(*) AS n FROM raw GROUP BY 1 ORDER BY n DESC, source LIMIT 15"),
    "by_date": with_(ARTICLES, RAW, body="SELECT day, count(*) AS n FROM raw GROUP BY 1 ORDER BY day DESC LIMIT 7"),
    "by_publish_day": with_(ARTICLES, RAW, body="SELECT strftime(dt, '%Y-%m-%d') AS day, count(*) AS n FROM raw WHERE dt IS NOT NULL GROUP BY 1"),
    "by_category": with_(ARTICLES, RAW, _LABELS, body="SELECT category, count(*) AS n FROM labels_ GROUP BY 1 ORDER BY n DESC, category LIMIT 10"),
    "by_country": with_(ARTICLES, RAW, body="SELECT coalesce(country, 'Unknown') AS country, count(*) AS n FROM raw GROUP BY 1 ORDER BY n DESC, country LIMIT 10"),
    "score_stats": with_(ARTICLES, RAW, body="""
SELECT 'relevance' AS score, count(relevance) AS n, min(relevance) AS min, max(relevance) AS max, round(avg(relevance), 6) AS avg FROM raw
UNION ALL SELECT 'sim', count(sim), min(sim), max(sim), round(avg(sim), 6) FROM raw"""),
    "length_stats": with_(ARTICLES, RAW, body="""
SELECT 'body' AS field, count(*) AS n, min(length(body)) AS min, max(length(body)) AS max, (sum(length(body)) // count(*))::BIGINT AS avg FROM raw WHERE body <> ''
UNION ALL SELECT 'title', count(*), min(length(title)), max(length(title)), (sum(length(title)) // count(*))::BIGINT FROM raw WHERE title <> ''"""),
    "completeness": with_(ARTICLES, RAW, body="""
SELECT topic_name, count(*) AS n, count(*) FILTER (title <> '') AS has_title, count(*) FILTER (body <> '') AS has_body,
       count(*) FILTER (image <> '') AS has_image FROM raw GROUP BY 1"""),
    "cross_topic_sources": with_(ARTICLES, RAW, _TWO, body="""
SELECT coalesce(source_title, 'Unknown') AS source, count(DISTINCT topic_name) AS topics,
       string_agg(DISTINCT topic_name, ',' ORDER BY topic_name) AS topic_list
FROM two GROUP BY 1 HAVING count(DISTINCT topic_name) > 1 ORDER BY topics DESC, source LIMIT 10"""),
    "topic_sources": with_(ARTICLES, RAW, _TWO, body="SELECT topic_name, count(DISTINCT coalesce(source_title, 'Unknown')) AS sources FROM two GROUP BY 1"),
    "date_coverage": with_(ARTICLES, RAW, body="SELECT topic_name, min(day) AS first_day, max(day) AS last_day, count(DISTINCT day) AS days FROM raw GROUP BY 1"),
    "dup_urls": with_(ARTICLES, RAW, body="""
SELECT url, count(*) AS occurrences, count(DISTINCT topic_name) AS topics, string_agg(DISTINCT topic_name, ',' ORDER BY topic_name) AS topic_list
FROM raw GROUP BY 1 HAVING count(*) > 1"""),
    "field_profile": with_(ARTICLES, RAW, "r AS (SELECT *, CASE WHEN doc_num % 7 = 0 THEN NULL ELSE 'x' END AS dtx FROM raw)", body=" UNION ALL ".join(
        f"SELECT '{n}' AS field, '{t}' AS type, count({c}) AS present, count(*) AS rows FROM r" for n, t, c in _FIELDS)),
    "facets": with_(ARTICLES, body="""
SELECT coalesce(source, '*') AS source, coalesce(topic_name, '*') AS topic_name, coalesce(source_type, '*') AS source_type, count(*) AS n
FROM articles GROUP BY GROUPING SETS ((source), (topic_name), (source_type), (source, topic_name))"""),
    "entity_facets": with_(TOKENS, GAZETTEER, body="""
SELECT CASE type WHEN 'Company' THEN 'companies' WHEN 'Technology' THEN 'technologies' ELSE 'agencies' END AS field,
       alias AS value, count(*) AS n FROM mentions GROUP BY 1, 2"""),
    "embed_text": with_(ARTICLES, "b AS (SELECT *, CASE WHEN doc_num % 9 <> 0 THEN content END AS body FROM articles)", body="""
SELECT doc_id, md5(title || chr(10) || chr(10) || coalesce(body, description)) AS embed_md5,
       md5(description || ' ' || coalesce(body, '')) AS nlp_md5 FROM b"""),
    "search_doc": with_(ARTICLES, body="""
SELECT doc_id, title, source, topic_name, topic_key, coalesce(image, '') AS image, link AS url, md5(content) AS content_md5,
       strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, strftime(ingestion_timestamp, '%Y-%m-%d %H:%M:%S') AS ingestion_timestamp,
       coalesce(len(embedding), 0)::BIGINT AS dims FROM articles LEFT JOIN embeddings ON doc_num = vec_id"""),
    "preview_slug": with_(ARTICLES, RAW, body="""
SELECT CASE WHEN uri = '' THEN 'newsapi_ai_' || md5(url) ELSE replace(uri, '/', '_') END AS doc_id,
       replace(lower(topic_name), ' ', '_') AS topic_slug, coalesce(relevance, 0) AS relevance_score, coalesce(sim, 0) AS similarity_score,
       4::BIGINT AS labels, md5(CASE WHEN length(body) > 200 THEN substring(body, 1, 200) || '...' ELSE body END) AS preview_md5,
       md5(replace(substring(body, 1, 150), chr(10), ' ')) AS line_md5, length(substring(body, 1, 500)) AS description_chars FROM raw
UNION ALL
SELECT 'doc_' || doc_num, replace(lower(topic_name), ' ', '_'), NULL, NULL, NULL, strftime(dt, '%Y/%m/%d'),
       topic_name || ', lang/' || lang || ', image/' || (image IS NOT NULL)::VARCHAR, NULL FROM raw"""),
}
