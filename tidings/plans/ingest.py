"""Queries: ingestion, cleaning, mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings import vocab
from tidings.functions import ids, text
from tidings.operators import clean, ingest, search
from tidings.plans import common
from tidings.plans.sql import ARTICLES, GAZETTEER, RAW, TOKENS, with_
from tidings.session import materialize
from tidings.sources import tables

TOPICS = (
    ("t0", "6f1e-0", "Topic t0", 100, "date"), ("t1", "6f1e-1", "Topic t1", 100, "date"),
    ("t2", "YOUR_T2_TOPIC_URI", "Topic t2", 100, "fq"), ("t3", "6f1e-3", "Topic t3", 5, "fq"),
    ("t9", "6f1e-9", "Topic t9", 100, "fq"),
)


def topics(spark, limit=None):
    df = spark.createDataFrame(TOPICS, "topic_key string, uri string, name string, max_articles int, sort_by string")
    return df if limit is None else df.withColumn("max_articles", F.lit(limit))


def ingest_canonical(spark, sf):
    items = tables.raw_items(spark, sf)
    rows = ingest.flatten(ingest.canonical(items, now=text.parse_iso(F.col("fetched_at"))))
    return rows.select(
        "doc_id", F.md5("title").alias("title_md5"), F.md5("content").alias("content_md5"),
        F.md5("description").alias("description_md5"), "link", common.iso("published_at"), "source",
        "source_type", "topic_name", "topic_key", text.joined(F.col("categories")).alias("categories"),
        common.iso("ingestion_timestamp"), "sentiment", "wgt", "image")


def ingest_topic_cap(spark, sf):
    capped = ingest.cap_per_topic(tables.articles(spark, sf).select("doc_id", "topic_key", "wgt", "published_at"),
                                  topics(spark, 10), F.desc("wgt"), F.asc("doc_id"))
    return capped.select("topic_key", "doc_id", "wgt", "position")


def topic_gate_runlog(spark, sf):
    counts = tables.articles(spark, sf).groupBy("topic_key").agg(F.count("*").alias("items"))
    log = ingest.run_log(topics(spark), counts)
    return (log.rollup("status", "topic_key")
            .agg(F.count("*").alias("topics"), F.sum("items_processed").alias("items"),
                 F.max("reason").alias("reason"))
            .select(F.coalesce("status", F.lit("all")).alias("status"),
                    F.coalesce("topic_key", F.lit("all")).alias("topic_key"), "topics", "items", "reason"))


def _feeds(spark, sf):
    """The topics feed and a later single-topic feed without the three extras."""
    all_topics = tables.articles(spark, sf)
    single = (all_topics.where(F.col("topic_key") == "t0").drop("sentiment", "wgt", "image")
              .withColumn("doc_id", F.concat(F.lit("single_"), "doc_id"))
              .withColumn("ingestion_timestamp", F.col("ingestion_timestamp") + F.expr("INTERVAL 1 HOUR")))
    return all_topics, single


def union_topics_dedup(spark, sf):
    narrow = [f.select("doc_id", "link", "topic_key", "ingestion_timestamp", *(["wgt"] if "wgt" in f.columns else []))
              for f in _feeds(spark, sf)]
    kept = ingest.first_per_key(ingest.union_all(*narrow), "link", F.asc("ingestion_timestamp"), F.asc("doc_id"))
    return kept.select("link", "doc_id", "topic_key", common.iso("ingestion_timestamp"), "wgt")


def schema_reconcile(spark, sf):
    both = ingest.union_all(*_feeds(spark, sf))
    return both.groupBy("topic_key").agg(
        F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("sentiment", "wgt", "image", "title")])


def source_registry(spark, sf):
    reg = spark.createDataFrame(vocab.SOURCE_REGISTRY, "domain string, name string, url string")
    by_host = reg.select("domain", "name", ids.host(F.col("url")).alias("host"))
    pages = tables.table(spark, sf, "pages").groupBy(ids.host(F.col("url")).alias("host")).agg(F.count("*").alias("pages"))
    known = by_host.select("host", "domain").distinct()
    used = (pages.join(known, "host", "left").groupBy(F.coalesce("domain", F.lit("unregistered")).alias("domain"))
            .agg(F.sum("pages").alias("pages"), F.count("*").alias("hosts")))
    size = by_host.groupBy("domain").agg(F.count("*").alias("registered"))
    return (size.join(used, "domain", "full_outer")
            .select("domain", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("registered", "pages", "hosts")]))


def nonempty_scan(spark, sf):
    return (tables.articles(spark, sf).where(clean.has_content()).groupBy("source")
            .agg(F.count("*").alias("n"), F.sum(F.length("content")).alias("chars")))


def required_fields(spark, sf):
    a = F.col("raw_article")
    staged = tables.raw_items(spark, sf).select(
        F.col("doc_num").alias("id"), a["title"].alias("title"), F.nullif(a["body"], F.lit("")).alias("content"),
        a["source"]["title"].alias("source"), a["dateTime"].alias("timestamp"), "topic_key")
    return staged.groupBy("topic_key").agg(
        F.count_if(clean.is_valid()).alias("valid"), F.count_if(~clean.is_valid()).alias("invalid"))


SOURCE_NAMES = (("src0", "REUTERS wire"), ("src1", "The Associated Press"), ("src2", "Defense and Space News"),
                ("src3", "the wall street journal"))


def raw_newsapi(spark, sf):
    num = F.col("doc_num")
    renamed = F.create_map(*[F.lit(x) for kv in SOURCE_NAMES for x in kv])[F.col("source")]
    return tables.articles(spark, sf).select(
        F.col("doc_id").alias("article_id"), "doc_num", F.nullif("title", F.lit("")).alias("title"), "content",
        F.when(num % 4 != 0, F.col("description")).alias("description"), "published_at",
        F.coalesce(renamed, F.concat(F.col("source"), F.lit(" daily POST"))).alias("source_name"),
        F.when(num % 13 != 0, F.col("link")).alias("url"), F.lit(None).cast("string").alias("author"),
        F.col("image").alias("url_to_image"), F.array("topic_name").alias("search_terms"), "ingestion_timestamp")


def clean_staging(spark, sf):
    return clean.staging(raw_newsapi(spark, sf)).select(
        "article_id", F.md5("title_clean").alias("title_md5"), F.md5("content_clean").alias("content_md5"),
        F.length("content_clean").cast("bigint").alias("content_chars"), F.md5("description_clean").alias("description_md5"),
        F.col("source_name_standardized").alias("source_name"), common.iso("published_at"))


def article_entities(spark, sf):
    """Entity arrays per article from the mentions of its text."""
    _, _, found = common.found(spark, sf)
    def names(cond):
        return F.array_sort(F.collect_list(F.when(cond, F.col("alias"))))
    t = F.col("type")
    return (found.groupBy("doc_num").agg(
        names(t == "Company").alias("companies"), names(t == "Agency").alias("agencies"),
        names(t == "Technology").alias("technologies"), names(t == "Organization").alias("funding_mentions"),
        names((t == "Company") & (F.col("tf") > 1)).alias("contract_mentions"))
        .select(F.concat(F.lit("doc_"), F.col("doc_num").cast("string")).alias("article_id"),
                "companies", "agencies", "technologies", "funding_mentions", "contract_mentions"))


def relevance_mart(spark, sf):
    scored = clean.with_relevance(clean.staging(raw_newsapi(spark, sf)), article_entities(spark, sf))
    return clean.mart(scored).select(
        "article_id", "source_name", F.round("final_relevance_score", 6).alias("final_relevance_score"),
        "priority_level", *[n for n, _ in vocab.TECHNOLOGY_FLAGS], text.joined(F.col("technologies")).alias("technologies"))


def sector_tags(spark, sf):
    """Tags by keyword: the fixed lists, and the words of the benchmark items dealt into five."""
    docs = common.tokenised(spark, sf)
    word = F.explode(text.tokens(F.col("text")))
    listed = materialize(tables.table(spark, sf, "benchmark").select(word.alias("keyword")).distinct()
                         .select("keyword", F.concat(F.lit("list_"), (F.length("keyword") % 5).cast("string")).alias("tag")), "keywords")
    hits = clean.word_tags(docs, listed.unionByName(clean.keyword_table(spark))).unionByName(
        clean.phrase_tags(common.text_articles(spark, sf))).distinct()
    per_doc = hits.groupBy("doc_num").agg(text.joined(F.collect_list("tag")).alias("tags"))
    return per_doc.groupBy("tags").agg(F.count("*").alias("docs"))


def content_router(spark, sf):
    return (clean.route(tables.articles(spark, sf)).groupBy("lang")
            .agg(F.count_if("matched").alias("matched"), F.count_if(~F.col("matched")).alias("unmatched")))


def lookback_filter(spark, sf):
    """Articles of the last seven days before the newest one, per source."""
    newest = tables.articles(spark, sf).agg(F.max("published_at")).scalar()
    return (tables.articles(spark, sf).where(clean.since("published_at", newest, 7))
            .groupBy("source").agg(F.count("*").alias("n"), F.min(F.date_format("published_at", "yyyy-MM-dd HH:mm:ss")).alias("oldest")))


def global_ids(spark, sf):
    p = tables.table(spark, sf, "pages")
    return p.select(
        "page_id", ids.url_md5(F.col("url")).alias("url_md5"), ids.canonical_url(F.col("url")).alias("canonical"),
        ids.article_global_id(F.col("url")).alias("article_gid"),
        ids.entity_global_id(ids.host(F.col("url")), F.lit("Organization")).alias("entity_gid"),
        ids.edge_global_id(F.col("page_id").cast("string"), ids.host(F.col("url")), F.lit("MENTIONS")).alias("edge_gid"))


QUERIES = {f.__name__: f for f in (
    ingest_canonical, ingest_topic_cap, topic_gate_runlog, union_topics_dedup, schema_reconcile,
    source_registry, nonempty_scan, required_fields, clean_staging, relevance_mart, sector_tags,
    content_router, lookback_filter, global_ids)}


def _values(rows):
    q = lambda v: "NULL" if v is None else ("'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v))
    return "(VALUES " + ", ".join("(" + ", ".join(q(v) for v in r) + ")" for r in rows) + ")"


_FEEDS = r"""
single AS (
  SELECT * REPLACE ('single_' || doc_id AS doc_id, ingestion_timestamp + INTERVAL 1 HOUR AS ingestion_timestamp,
                    NULL::DOUBLE AS sentiment, NULL::DOUBLE AS wgt, NULL::VARCHAR AS image)
  FROM articles WHERE topic_key = 't0'),
feeds AS (SELECT * FROM articles UNION ALL SELECT * FROM single)
"""

_WS = r"trim(regexp_replace({}, '[ \t\n\x0B\f\r]+', ' ', 'g'))"
_STAGING = r"""
newsapi AS (
  SELECT doc_id AS article_id, doc_num, nullif(title, '') AS title, content,
         CASE WHEN doc_num % 4 <> 0 THEN description END AS description, published_at,
         CASE source WHEN 'src0' THEN 'REUTERS wire' WHEN 'src1' THEN 'The Associated Press'
           WHEN 'src2' THEN 'Defense and Space News' WHEN 'src3' THEN 'the wall street journal'
           ELSE source || ' daily POST' END AS source_name,
         CASE WHEN doc_num % 13 <> 0 THEN link END AS url
  FROM articles),
staging AS (
  SELECT article_id, """ + _WS.format("title") + " AS title_clean, " + _WS.format("content") + " AS content_clean, " + _WS.format("description") + r""" AS description_clean,
         CASE WHEN lower(source_name) LIKE '%reuters%' THEN 'Reuters'
              WHEN lower(source_name) LIKE '%associated press%' THEN 'Associated Press'
              WHEN lower(source_name) LIKE '%wall street journal%' THEN 'Wall Street Journal'
              WHEN lower(source_name) LIKE '%defense%news%' THEN 'Defense News'
              ELSE 'Src' || substring(split_part(source_name, ' ', 1), 4) || ' Daily Post' END AS source_name,
         published_at
  FROM newsapi WHERE title IS NOT NULL AND url IS NOT NULL AND published_at IS NOT NULL)
"""

_HOST = r"regexp_replace(lower(regexp_extract({}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)), '^www\.', '')"
_CANON = r"""regexp_replace(lower(regexp_extract(regexp_replace(url, '[?#].*$', ''), '^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)', 1))
   || regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', ''), '/+$', '')"""

_SECTORS = _values([(t, " " + " ".join(clean._words(k)) + " ") for t, ws in vocab.SECTOR_KEYWORDS.items() for k in ws])

ORACLES = {
    "ingest_canonical": with_(ARTICLES, RAW, body="""
SELECT 'newsapi_ai_' || CASE WHEN uri = '' THEN md5(url) ELSE replace(replace(uri, '/', '_'), ':', '_') END AS doc_id,
       md5(coalesce(title, '')) AS title_md5, md5(body) AS content_md5, md5(substring(body, 1, 500)) AS description_md5,
       url AS link, strftime(coalesce(dt, fetched_at), '%Y-%m-%d %H:%M:%S') AS published_at,
       coalesce(source_title, 'Unknown') AS source, 'news_article' AS source_type, topic_name, topic_key,
       topic_name AS categories, strftime(fetched_at, '%Y-%m-%d %H:%M:%S') AS ingestion_timestamp, sentiment, wgt, image
FROM raw"""),
    "ingest_topic_cap": with_(ARTICLES, body="""
SELECT topic_key, doc_id, wgt, position FROM (
  SELECT topic_key, doc_id, wgt, row_number() OVER (PARTITION BY topic_key ORDER BY wgt DESC, doc_id) AS position FROM articles)
WHERE position <= 10"""),
    "topic_gate_runlog": with_(ARTICLES, "topics AS (SELECT * FROM " + _values(TOPICS) + " t(topic_key, uri, name, max_articles, sort_by))", """
log AS (
  SELECT t.topic_key, CASE WHEN starts_with(uri, 'YOUR_') THEN 'skipped' ELSE 'success' END AS status,
         CASE WHEN starts_with(uri, 'YOUR_') THEN 'URI not configured' END AS reason,
         CASE WHEN starts_with(uri, 'YOUR_') THEN 0 ELSE coalesce(items, 0) END AS items
  FROM topics t LEFT JOIN (SELECT topic_key, count(*) AS items FROM articles GROUP BY 1) c ON t.topic_key = c.topic_key)""", body="""
SELECT coalesce(status, 'all') AS status, coalesce(topic_key, 'all') AS topic_key, count(*) AS topics,
       sum(items)::BIGINT AS items, max(reason) AS reason
FROM log GROUP BY ROLLUP (status, topic_key)"""),
    "union_topics_dedup": with_(ARTICLES, _FEEDS, body="""
SELECT link, doc_id, topic_key, strftime(ingestion_timestamp, '%Y-%m-%d %H:%M:%S') AS ingestion_timestamp, wgt
FROM feeds QUALIFY row_number() OVER (PARTITION BY link ORDER BY feeds.ingestion_timestamp, doc_id) = 1"""),
    "schema_reconcile": with_(ARTICLES, _FEEDS, body="""
SELECT topic_key, count(*) AS n, count(*) FILTER (sentiment IS NULL) AS null_sentiment,
       count(*) FILTER (wgt IS NULL) AS null_wgt, count(*) FILTER (image IS NULL) AS null_image,
       count(*) FILTER (title IS NULL) AS null_title FROM feeds GROUP BY 1"""),
    "source_registry": with_("reg AS (SELECT domain, name, " + _HOST.format("url") + " AS host FROM " + _values(vocab.SOURCE_REGISTRY) + " t(domain, name, url))",
                             "hosts AS (SELECT " + _HOST.format("url") + " AS host, count(*) AS pages FROM pages GROUP BY 1)", """
used AS (SELECT coalesce(domain, 'unregistered') AS domain, sum(pages)::BIGINT AS pages, count(*) AS hosts
  FROM hosts LEFT JOIN (SELECT DISTINCT host, domain FROM reg) k USING (host) GROUP BY 1),
size AS (SELECT domain, count(*) AS registered FROM reg GROUP BY 1)""", body="""
SELECT coalesce(size.domain, used.domain) AS domain, coalesce(registered, 0) AS registered, coalesce(pages, 0) AS pages,
       coalesce(hosts, 0) AS hosts FROM size FULL JOIN used ON size.domain = used.domain"""),
    "nonempty_scan": """SELECT source, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents
WHERE text IS NOT NULL AND text <> '' GROUP BY 1""",
    "required_fields": with_(ARTICLES, RAW, body="""
SELECT topic_key, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS invalid FROM (
  SELECT topic_key, title IS NOT NULL AND body <> '' AND source_title IS NOT NULL AND doc_num % 7 <> 0 AS ok FROM raw) GROUP BY 1"""),
    "clean_staging": with_(ARTICLES, _STAGING, body="""
SELECT article_id, md5(title_clean) AS title_md5, md5(content_clean) AS content_md5, length(content_clean) AS content_chars,
       md5(description_clean) AS description_md5, source_name, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at FROM staging"""),
    "relevance_mart": with_(ARTICLES, TOKENS, GAZETTEER, _STAGING, """
ents AS (
  SELECT 'doc_' || doc_num AS article_id, count(*) FILTER (type = 'Company') AS companies,
         count(*) FILTER (type = 'Agency') AS agencies, count(*) FILTER (type = 'Technology') AS technologies,
         count(*) FILTER (type = 'Organization') AS funding, count(*) FILTER (type = 'Company' AND tf > 1) AS contracts,
         coalesce(string_agg(alias, ',' ORDER BY alias) FILTER (type = 'Technology'), '') AS tech
  FROM mentions GROUP BY doc_num),
scored AS (
  SELECT s.article_id, s.source_name, coalesce(tech, '') AS tech, least(10.0::DOUBLE,
    (coalesce(companies, 0) * 0.2::DOUBLE + coalesce(agencies, 0) * 0.3::DOUBLE + coalesce(technologies, 0) * 0.1::DOUBLE
     + coalesce(funding, 0) * 0.4::DOUBLE + coalesce(contracts, 0) * 0.3::DOUBLE)
    * CASE WHEN s.source_name IN ('Reuters', 'Associated Press', 'Wall Street Journal') THEN 1.2::DOUBLE ELSE 1.0::DOUBLE END) AS score
  FROM staging s LEFT JOIN ents e ON s.article_id = e.article_id)""", body="""
SELECT article_id, source_name, round(score, 6) AS final_relevance_score,
       CASE WHEN score >= 5 THEN 'High Priority' WHEN score >= 2 THEN 'Medium Priority'
            WHEN score >= 0.5 THEN 'Low Priority' ELSE 'Background' END AS priority_level,
       tech ILIKE '%ai%' OR tech ILIKE '%artificial intelligence%' OR tech ILIKE '%machine learning%' AS has_ai_tech,
       tech ILIKE '%cyber%' OR tech ILIKE '%security%' AS has_cyber_tech,
       tech ILIKE '%space%' OR tech ILIKE '%satellite%' OR tech ILIKE '%orbital%' AS has_space_tech,
       tech ILIKE '%autonomous%' OR tech ILIKE '%unmanned%' OR tech ILIKE '%drone%' AS has_autonomous_tech,
       tech AS technologies
FROM scored WHERE score > 0"""),
    "sector_tags": with_(TOKENS, """
frequent AS (SELECT DISTINCT term, 'list_' || (length(term) % 5) AS tag FROM
  (SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM benchmark)),
lines AS (SELECT doc_num, ' ' || array_to_string(tokens, ' ') || ' ' AS line FROM toks)""",
                         "kw AS (SELECT * FROM " + _SECTORS + " t(tag, keyword))", """
hits AS (
  SELECT DISTINCT doc_num, tag FROM postings JOIN frequent USING (term)
  UNION SELECT DISTINCT doc_num, tag FROM lines JOIN kw ON contains(line, keyword)),
per_doc AS (SELECT doc_num, string_agg(tag, ',' ORDER BY tag) AS tags FROM hits GROUP BY 1)""", body="""
SELECT tags, count(*) AS docs FROM per_doc GROUP BY 1"""),
    "content_router": with_("m AS (SELECT lang, regexp_matches(text, '" + text.any_of(vocab.ROUTE_TERMS) + "') AS matched FROM documents)", body="""
SELECT lang, count(*) FILTER (matched) AS matched, count(*) FILTER (NOT matched) AS unmatched FROM m GROUP BY 1"""),
    "lookback_filter": with_(ARTICLES, body="""
SELECT source, count(*) AS n, strftime(min(published_at), '%Y-%m-%d %H:%M:%S') AS oldest FROM articles
WHERE published_at >= (SELECT max(published_at) FROM articles) - INTERVAL 7 DAY GROUP BY 1"""),
    "global_ids": "SELECT page_id, md5(url) AS url_md5, " + _CANON + " AS canonical, sha256(" + _CANON + ") AS article_gid, sha256("
                  + _HOST.format("url") + " || '|Organization') AS entity_gid, sha256(page_id || '|' || " + _HOST.format("url")
                  + " || '|MENTIONS') AS edge_gid FROM pages",
}
