"""Queries: declared tests, gates, dimension scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings import vocab
from tidings.operators import clean, quality
from tidings.operators.ingest import union_all
from tidings.plans.ingest import _STAGING, raw_newsapi
from tidings.plans.sql import ARTICLES, EDGES, with_
from tidings.sources import tables


def _staging(spark, sf):
    return clean.staging(raw_newsapi(spark, sf))


def _rules():
    return {"article_id_not_null": F.col("article_id").isNotNull(), "title_not_null": F.col("title_clean").isNotNull(),
            "published_at_not_null": F.col("published_at").isNotNull(), "description_not_null": F.col("description_clean").isNotNull(),
            "title_not_blank": F.col("title_clean") != ""}


def _counts(spark, sf):
    s = _staging(spark, sf)
    return (quality.rule_counts(s, _rules()), quality.unique_count(s, "article_id_unique", "article_id"), quality.unique_count(s, "url_unique", "url"))


def dq_tests(spark, sf):
    a, b, c = _counts(spark, sf)
    return a.unionByName(b).unionByName(c)


def dq_failures(spark, sf):
    s = _staging(spark, sf)
    return quality.failing_rows(s, _rules(), "article_id").unionByName(quality.repeated_rows(s, "url_unique", "url", "article_id"))


def dq_gate(spark, sf):
    return quality.gate(*_counts(spark, sf))


def dq_gate_graph(spark, sf):
    """Whether entities and relations may be loaded: keys, names, types and
    endpoints; customers without an address in the first nations are left out,
    so some endpoints are missing."""
    t = lambda n: tables.table(spark, sf, n)
    ents = (t("supplier").select(F.concat(F.lit("s:"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name"))
            .unionByName(t("customer").where("c_nationkey > 2").select(F.concat(F.lit("c:"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("name"))))
    rel = tables.awards(spark, sf)
    gates = {"entities": (quality.rule_counts(ents, {"id_set": F.col("id").isNotNull(), "name_set": F.col("name") != ""}), quality.unique_count(ents, "id_unique", "id")),
             "relations": (quality.rule_counts(rel, {"type_allowed": F.col("type").isin(*vocab.RELATION_TYPES), "value_positive": F.col("value") > 0}),
                           quality.reference_count(rel, "source_known", "src", ents, "id"), quality.reference_count(rel, "target_known", "dst", ents, "id"))}
    return union_all(*[quality.gate(*counts).withColumn("part", F.lit(part)) for part, counts in gates.items()])


def dq_dimensions(spark, sf):
    a = tables.articles(spark, sf)
    newest = a.agg(F.max("published_at")).scalar()
    wide = a.agg(
        F.count("*").alias("n"), F.count_if((F.col("title") != "") & F.col("image").isNotNull()).alias("completeness"),
        F.count_if(F.col("ingestion_timestamp") >= F.col("published_at")).alias("consistency"),
        F.count_if(clean.since("published_at", newest, 21)).alias("timeliness"),
        F.count_if(F.col("wgt") >= 100).alias("relevance"))
    acc = tables.table(spark, sf, "labels").agg(
        F.lit("accuracy").alias("dimension"), F.count_if(F.col("quality") == 1).alias("good"), F.count("*").alias("total"))
    rows = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("good"), F.col("n").alias("total"))
                     for d in ("completeness", "consistency", "timeliness", "relevance")])
    return quality.dimensions(wide.select(F.explode(rows).alias("x")).select("x.*").unionByName(acc))


QUERIES = {f.__name__: f for f in (dq_tests, dq_failures, dq_gate, dq_gate_graph, dq_dimensions)}

_TESTS = """
st AS (SELECT s.*, CASE WHEN doc_num % 13 <> 0 THEN link END AS url FROM staging s JOIN articles a ON s.article_id = a.doc_id),
tests AS (
  SELECT 'article_id_not_null' AS rule, count(*) AS rows, count(*) FILTER (article_id IS NULL) AS violations FROM st
  UNION ALL SELECT 'title_not_null', count(*), count(*) FILTER (title_clean IS NULL) FROM st
  UNION ALL SELECT 'published_at_not_null', count(*), count(*) FILTER (published_at IS NULL) FROM st
  UNION ALL SELECT 'description_not_null', count(*), count(*) FILTER (description_clean IS NULL) FROM st
  UNION ALL SELECT 'title_not_blank', count(*), count(*) FILTER (coalesce(title_clean, '') = '') FROM st
  UNION ALL SELECT 'article_id_unique', count(*), count(*) - count(DISTINCT article_id) FROM st
  UNION ALL SELECT 'url_unique', count(*), count(*) - count(DISTINCT url) FROM st)
"""

_DIM = """SELECT dimension, good, total, round(good / total, 6) AS ratio, round(good / total, 6) >= 0.75 AS passed FROM (
  SELECT 'completeness' AS dimension, count(*) FILTER (title <> '' AND image IS NOT NULL) AS good, count(*) AS total FROM articles
  UNION ALL SELECT 'consistency', count(*) FILTER (ingestion_timestamp >= published_at), count(*) FROM articles
  UNION ALL SELECT 'timeliness', count(*) FILTER (published_at >= (SELECT max(published_at) FROM articles) - INTERVAL 21 DAY), count(*) FROM articles
  UNION ALL SELECT 'relevance', count(*) FILTER (wgt >= 100), count(*) FROM articles
  UNION ALL SELECT 'accuracy', count(*) FILTER (quality = 1), count(*) FROM labels)"""

ORACLES = {
    "dq_tests": with_(ARTICLES, _STAGING, _TESTS, body="SELECT * FROM tests"),
    "dq_gate_graph": with_(EDGES, f"""
ents AS (SELECT 's:' || s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT 'c:' || c_custkey, c_name FROM customer WHERE c_nationkey > 2),
rules AS (
  SELECT 'entities' AS part, count(*) FILTER (id IS NULL) AS violations FROM ents UNION ALL SELECT 'entities', count(*) FILTER (coalesce(name, '') = '') FROM ents
  UNION ALL SELECT 'entities', count(*) - count(DISTINCT id) FROM ents
  UNION ALL SELECT 'relations', count(*) FILTER (type NOT IN ({", ".join(f"'{x}'" for x in vocab.RELATION_TYPES)})) FROM awards
  UNION ALL SELECT 'relations', count(*) FILTER (NOT value > 0) FROM awards
  UNION ALL SELECT 'relations', count(*) FILTER (src NOT IN (SELECT id FROM ents)) FROM awards
  UNION ALL SELECT 'relations', count(*) FILTER (dst NOT IN (SELECT id FROM ents)) FROM awards)""", body="""
SELECT part, count(*) AS rules, count(*) FILTER (violations > 0) AS failed_rules, sum(violations)::BIGINT AS violations, count(*) FILTER (violations > 0) = 0 AS passed
FROM rules GROUP BY part"""),
    "dq_failures": with_(ARTICLES, _STAGING, _TESTS, body="""
SELECT article_id, 'description_not_null' AS rule FROM staging WHERE description_clean IS NULL
UNION ALL SELECT article_id, 'title_not_blank' FROM staging WHERE title_clean = ''
UNION ALL SELECT article_id, 'url_unique' FROM st WHERE url IN (SELECT url FROM st GROUP BY 1 HAVING count(*) > 1)"""),
    "dq_gate": with_(ARTICLES, _STAGING, _TESTS, body="""
SELECT count(*) AS rules, count(*) FILTER (violations > 0) AS failed_rules, sum(violations)::BIGINT AS violations, count(*) FILTER (violations > 0) = 0 AS passed FROM tests"""),
    "dq_dimensions": with_(ARTICLES, body=_DIM),
}
