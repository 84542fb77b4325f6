"""Queries: landed sources, parquet reads, sinks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tidings import schemas, vocab
from tidings.functions import text
from tidings.operators import ingest, nlp
from tidings.plans import common
from tidings.plans.ingest import topics
from tidings.plans.nlp import OCCURRENCES
from tidings.plans.sql import ARTICLES, GAZETTEER, RAW, TOKENS, with_
from tidings.session import materialize, scratch
from tidings.sinks import files
from tidings.sources import landing, tables

PAGE = 100
ARRAY_PAGE = 4000


def _cut(batches):
    """Envelopes of a task: the items (last column) of equal keys, PAGE at most, with the keys of the first."""
    for b in batches:
        if not b.num_rows:
            continue
        *keys, items = b.columns
        own = pa.Table.from_arrays(keys, names=b.schema.names[:-1]).to_pandas().groupby(b.schema.names[:-1], dropna=False, sort=False).ngroup().to_numpy()
        order = np.argsort(own, kind="stable")
        size = np.bincount(own)
        place = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)
        starts = np.flatnonzero(place % PAGE == 0)
        first = pa.array(order[starts])
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(own)).astype(np.int32)), items.take(pa.array(order)))
        yield pa.RecordBatch.from_arrays([*[k.take(first) for k in keys], lists], names=b.schema.names)


def enveloped(rows):
    """Rows of keys and one item column (the last) as envelopes of at most PAGE
    items of equal keys.  They are filled where the rows are read: no text is
    shuffled, and a page read by several tasks is several envelopes."""
    *keys, items = rows.schema.fields
    return rows.mapInArrow(_cut, StructType([*keys]).add(items.name, ArrayType(items.dataType)))


def land_topics(spark, sf, root):
    """Topic responses of at most 100 items per envelope."""
    items = tables.raw_items(spark, sf)
    pages = enveloped(items.select("fetched_at", "topic_name", "topic_key", F.col("raw_article").alias("results")))
    pages.select(F.struct(F.size("results").cast("bigint").alias("totalResults"), "results").alias("articles"),
                 "fetched_at", "topic_name", "topic_key").write.options(**files.PACKED).json(root)


def _title(html):
    return text.collapse(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1))


def land_feed(spark, sf, root):
    p = tables.table(spark, sf, "pages")
    when = F.timestamp_seconds(F.lit(tables.EPOCH_2024) + F.col("page_id") * 3600)
    (p.select(F.when(F.col("page_id") % 8 != 0, _title(F.col("html"))).alias("title"), F.col("url").alias("link"),
              F.concat(F.lit("page "), F.col("page_id").cast("string"), F.lit(" & <more>")).alias("description"),
              F.date_format(when, "E, dd MMM yyyy HH:mm:ss '+0000'").alias("pubDate"))
     .write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(root))


def land_agency(spark, sf, root):
    a = tables.articles(spark, sf)
    item = F.struct(F.col("doc_num").cast("string").alias("id"), "title", F.col("content").alias("body"), F.col("description").alias("excerpt"),
                    F.col("link").alias("url"), F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
                    F.when(F.col("doc_num") % 2 == 0, "solicitation").alias("type"), "categories")
    pages = enveloped(a.select(F.floor(F.col("doc_num") / PAGE).alias("page"), item.alias("items")))
    pages.select("items").write.options(**files.PACKED).json(root)


def land_queries(spark, sf, root):
    """Results of the fixed keyword queries; every article is found by two."""
    a = tables.articles(spark, sf)
    names = F.array(*[F.lit(q) for q in vocab.NEWS_QUERIES])
    n = len(vocab.NEWS_QUERIES)
    found = a.withColumn("q", F.explode(F.array(F.col("doc_num") % n, (F.col("doc_num") + 5) % n))).withColumn("query", F.element_at(names, (F.col("q") + 1).cast("int")))
    item = F.struct(F.struct(F.col("source").alias("id"), F.col("source").alias("name")).alias("source"), F.lit(None).cast("string").alias("author"),
                    "title", "description", F.col("link").alias("url"), F.col("image").alias("urlToImage"),
                    F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"), "content")
    page = F.floor(F.col("doc_num") / PAGE).alias("page")
    lines = enveloped(found.select("query", page, item.alias("articles"))).select(F.to_json(F.struct("query", "articles")).alias("value"))
    broken = found.select("query", page).distinct().select(F.concat(F.lit('{"query": "'), "query", F.lit('", "articles": [')).alias("value"))
    lines.unionByName(broken).write.options(**files.PACKED).text(root)


LANDERS = {"topics": land_topics, "defense_news": land_feed, "darpa": land_agency, "newsapi": land_queries}


def landing_sources(spark, sf):
    """Land every source's files, read them back through the plug-ins."""
    parts = []
    for name, land in LANDERS.items():
        root = scratch(spark, f"landing-{name}")
        land(spark, sf, root)
        rows = landing.load(spark, name, root)
        parts.append(rows.select(F.lit(name).alias("plugin"), *landing.CANONICAL))
    return ingest.union_all(*parts).groupBy("plugin", "source_type").agg(
        F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count("published_at").alias("dated"),
        F.sum(F.length("content")).alias("chars"), F.count_if(F.col("title") == "").alias("untitled"),
        F.min("id").alias("first_id"), F.sum(F.size("categories")).alias("categories"))


def feed_since(spark, sf):
    """Feed items published on or after a start date."""
    root = scratch(spark, "landing-feed")
    land_feed(spark, sf, root)
    start = F.lit("2024-01-05 00:00:00").cast("timestamp")
    return landing.load(spark, "defense_news", root).where(F.col("published_at") >= start).select("id", "title", "link", common.iso("published_at"))


def parquet_reads(spark, sf):
    """The same articles through single, many, glob and JSON-array reads."""
    root, arrays = scratch(spark, "articles"), scratch(spark, "arrays")
    a = tables.articles(spark, sf)
    files.write_articles(a.drop("doc_num", "lang"), root)
    # one file per array: a staging area of at most ARRAY_PAGE articles a file
    item = F.struct("doc_id", "title", "link")
    (a.groupBy("topic_key", F.floor(F.col("doc_num") / ARRAY_PAGE).alias("page")).agg(F.to_json(F.collect_list(item)).alias("value"))
     .write.partitionBy("topic_key", "page").text(arrays))
    def count(df, how):
        return df.groupBy(F.lit(how).alias("read"), "topic_key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    single = files.read_articles(spark, f"{root}/source_name=newsapi_ai_t0", base=root)
    many = files.read_articles(spark, *[f"{root}/source_name=newsapi_ai_t{i}" for i in (1, 2, 3)], base=root)
    glob = files.read_articles(spark, f"{root}/*/date=2024-01-0*", base=root)
    staged = landing.staged_array(spark, arrays, "doc_id string, title string, link string, topic_key string")
    return ingest.union_all(count(single, "single"), count(many, "many"), count(glob, "glob"), count(staged, "array"))


def document_scan(spark, sf):
    """Documents read back from written article files, per source."""
    root = scratch(spark, "articles")
    files.write_articles(tables.articles(spark, sf).drop("doc_num", "lang"), root)
    return files.scan_documents(spark, root).groupBy(F.col("metadata.source").alias("source")).agg(
        F.count("*").alias("documents"), F.sum(F.length("page_content")).alias("chars"), F.min("metadata.id").alias("first"))


def file_inventory(spark, sf):
    """Tables found in the folder by listing, with their rows."""
    found = landing.inventory(tables.configure(spark), sf).select(F.regexp_extract("path", "([^/]+[.]parquet)(/[^/]+)?$", 1).alias("file")).distinct()
    names = [r[0] for r in found.orderBy("file").collect()]   # one per table of the folder
    return ingest.union_all(*[spark.read.parquet(f"{sf}/{n}").agg(F.lit(n).alias("file"), F.count("*").alias("n")) for n in names])


def sinks_roundtrip(spark, sf):
    """Write through every sink, read back, report rows per sink."""
    a = tables.articles(spark, sf)
    p = {n: scratch(spark, n) for n in ("raw", "articles", "combined", "enriched", "index", "objects", "exports", "runs")}
    flat = a.drop("doc_num", "lang")
    files.write_raw_json(flat, p["raw"])
    files.write_articles(flat, p["articles"])
    log = ingest.run_log(topics(spark), a.groupBy("topic_key").agg(F.count("*").alias("items")))
    files.combine_successful(spark, log, p["articles"], p["combined"])
    _, occ, found = common.found(spark, sf)
    adj = nlp.adjacent_relations(occ)
    enriched = materialize(nlp.enrich(a, found, adj), "enriched", **files.DENSE)
    files.vector_objects(enriched).write.options(**files.DENSE).parquet(p["objects"])
    files.write_enriched(enriched, p["enriched"])
    objects = spark.read.parquet(p["objects"])
    emb = a.join(objects.select(F.col("document_id").alias("doc_id"), "embedding"), "doc_id")
    files.write_batch(files.search_documents(emb), p["index"], 0)
    files.write_batch(files.search_documents(emb.where(F.col("topic_key") == "t1").withColumn("title", F.lit("updated"))), p["index"], 1)
    files.write_topic_exports(ingest.export_rows(tables.raw_items(spark, sf)), p["exports"])
    for run, day in (("1", "2024-01-01"), ("2", "2024-01-02"), ("2", "2024-01-02")):   # the second run is retried
        files.write_summary(ingest.run_summary(log), p["runs"], run, day)
    latest = files.read_latest(spark, p["index"], "doc_id", columns=["title"])
    def rows(name, df, *content):
        return df.agg(F.lit(name).alias("sink"), F.count("*").alias("n"), common.digest(*content))
    text_of = ("doc_id", "title", "content")
    return ingest.union_all(
        rows("raw", spark.read.schema(schemas.ARTICLE_15).json(p["raw"]), *text_of),
        rows("articles", files.read_articles(spark, p["articles"]), *text_of),
        rows("combined", spark.read.parquet(p["combined"]), *text_of),
        rows("enriched", files.read_enriched(spark, p["enriched"]).select("doc_id", F.array_join(F.array_sort("entities"), ",").alias("names")), "doc_id", "names"),
        rows("objects", objects, "document_id", "entity_count", "relationship_count"),
        rows("index", latest, "doc_id", "title"),
        rows("exports", spark.read.json(p["exports"], schema="doc_id string, content string"), "content"),
        rows("runs", spark.read.parquet(p["runs"]), "run_date"))


def daily_sinks(spark, sf):
    """Two days through the raw landing, the article tables and the exports,
    the first day sent twice: each day is there once."""
    a = tables.articles(spark, sf).drop("doc_num", "lang")
    items = tables.raw_items(spark, sf)
    p = {n: scratch(spark, n) for n in ("raw", "articles", "exports")}
    early = lambda c: F.date_format(c, "yyyy-MM-dd") < "2024-01-16"
    for first in (True, False, True):
        some = a.where(early("ingestion_timestamp") if first else ~early("ingestion_timestamp"))
        files.write_raw_json(some, p["raw"])
        files.write_articles(some, p["articles"])
        files.write_topic_exports(ingest.export_rows(items.where(early("fetched_at") if first else ~early("fetched_at"))), p["exports"])
    def of(name, df, day):
        return df.groupBy(F.lit(name).alias("sink"), day.alias("day")).agg(F.count("*").alias("n"), common.digest("content"))
    day = F.date_format("ingestion_timestamp", "yyyyMMdd")
    exports = spark.read.schema("doc_id string, content string, topic_slug string, day string").json(p["exports"])
    return ingest.union_all(of("raw", spark.read.schema(schemas.ARTICLE_15).json(p["raw"]), day),
                            of("articles", files.read_articles(spark, p["articles"]), day), of("exports", exports, F.col("day")))


def index_versions(spark, sf):
    """One index, four deltas: two writers that number their batches alike, a
    batch with two versions of its keys, and a delta after compaction."""
    a = tables.articles(spark, sf)
    def rows(title, hours, which):
        emb = a.where(which).withColumn("embedding", F.array(F.lit(0.0))).withColumn("title", F.lit(title)).withColumn(
            "ingestion_timestamp", F.col("ingestion_timestamp") + F.make_interval(hours=F.lit(hours)))
        return files.search_documents(emb)
    n, by = F.col("doc_num"), "ingestion_timestamp"
    root, folded = scratch(spark, "index"), scratch(spark, "folded")
    sent = [files.write_batch(rows("first", 0, n >= 0), root, 0, "a"),
            files.write_batch(rows("other writer", 1, n % 2 == 0), root, 0, "b"),
            files.write_batch(rows("older", 2, n % 3 == 0).unionByName(rows("newer", 3, n % 3 == 0)), root, 1, "a")]
    files.compact(spark, root, folded, "doc_id", order=by)
    sent += [files.write_batch(rows("after", 4, n % 5 == 0), folded, 0, "a"), files.write_batch(rows("late", -9, n % 7 == 0), folded, 0, "c")]
    latest = files.read_latest(spark, folded, "doc_id", order=by)
    return latest.groupBy("title").agg(F.count("*").alias("n"), common.digest("doc_id", "content"), F.lit(sum(sent)).cast("bigint").alias("sent"))


def rejected_lines(spark, sf):
    """Query results read = kept + rejected, and the lines that were not JSON."""
    root = scratch(spark, "landing-newsapi")
    land_queries(spark, sf, root)
    bad = landing.rejected_lines(spark, root)
    return bad.groupBy(F.regexp_extract("line", '"query": "([^"]*)"', 1).alias("query")).agg(F.count("*").alias("rejected"))


QUERIES = {f.__name__: f for f in (landing_sources, feed_since, parquet_reads, document_scan, file_inventory, sinks_roundtrip,
                                    daily_sinks, index_versions, rejected_lines)}

_PAGE_TITLE = r"trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '[ \t\n\x0B\f\r]+', ' ', 'g'))"

_TEXT = common.digest_sql("doc_id", "title", "content")

ORACLES = {
    "landing_sources": with_(ARTICLES, RAW, body=r"""
SELECT 'topics' AS plugin, 'news_article' AS source_type, count(*) AS n, count(DISTINCT id) AS ids, count(*) AS dated, sum(length(body))::BIGINT AS chars,
  count(*) FILTER (title IS NULL) AS untitled, min(id) AS first_id, count(*) AS categories
FROM (SELECT *, 'newsapi_ai_' || CASE WHEN uri = '' THEN md5(url) ELSE replace(replace(uri, '/', '_'), ':', '_') END AS id FROM raw)
UNION ALL SELECT 'defense_news', 'news_article', count(*), count(DISTINCT url), count(*), sum(length('page ' || page_id || ' & <more>'))::BIGINT,
  count(*) FILTER (page_id % 8 = 0 OR """ + _PAGE_TITLE + r""" = ''), 'defense_news_' || min(md5(url)), 0 FROM pages
UNION ALL SELECT 'darpa', CASE WHEN doc_num % 2 = 0 THEN 'solicitation' ELSE 'announcement' END, count(*), count(*), count(*), sum(length(content))::BIGINT,
  count(*) FILTER (title = ''), min('darpa_' || doc_num), count(*) FROM articles GROUP BY 2
UNION ALL SELECT 'newsapi', 'news_article', count(*), count(*), count(*), sum(c)::BIGINT, count(*) FILTER (t = ''), 'newsapi_' || min(md5(link)), count(*)
FROM (SELECT link, any_value(length(content)) AS c, any_value(title) AS t FROM articles GROUP BY 1)"""),
    "feed_since": r"""SELECT 'defense_news_' || md5(url) AS id, CASE WHEN page_id % 8 <> 0 THEN """ + _PAGE_TITLE + r""" ELSE '' END AS title, url AS link,
  strftime(TIMESTAMP '2024-01-01' + to_hours(page_id::INT), '%Y-%m-%d %H:%M:%S') AS published_at FROM pages
WHERE TIMESTAMP '2024-01-01' + to_hours(page_id::INT) >= TIMESTAMP '2024-01-05'""",
    "parquet_reads": with_(ARTICLES, body="""
SELECT 'single' AS read, topic_key, count(*) AS n, min(doc_id) AS first FROM articles WHERE topic_key = 't0' GROUP BY 2
UNION ALL SELECT 'many', topic_key, count(*), min(doc_id) FROM articles WHERE topic_key IN ('t1', 't2', 't3') GROUP BY 2
UNION ALL SELECT 'glob', topic_key, count(*), min(doc_id) FROM articles WHERE strftime(ingestion_timestamp, '%Y-%m-%d') LIKE '2024-01-0%' GROUP BY 2
UNION ALL SELECT 'array', topic_key, count(*), min(doc_id) FROM articles GROUP BY 2"""),
    "document_scan": with_(ARTICLES, body="""
SELECT source, count(*) AS documents, sum(length(title) + 2 + length(content))::BIGINT AS chars, min(doc_id) AS first FROM articles WHERE content <> '' GROUP BY 1"""),
    "sinks_roundtrip": with_(ARTICLES, TOKENS, GAZETTEER, OCCURRENCES, """
names AS (SELECT 'doc_' || doc_id AS doc_id, coalesce(x, '') AS names, coalesce(n, 0) AS n FROM documents LEFT JOIN (
  SELECT doc_num, string_agg(alias, ',' ORDER BY alias) AS x, count(*) AS n FROM mentions GROUP BY 1) m ON doc_num = doc_id),
counted AS (SELECT names.doc_id, names.n, coalesce(r.n, 0) AS r FROM names LEFT JOIN (SELECT doc_num, count(*) AS n FROM adj GROUP BY 1) r ON names.doc_id = 'doc_' || doc_num)""", body=f"""
SELECT 'raw' AS sink, count(*) AS n, {_TEXT} FROM articles
UNION ALL SELECT 'articles', count(*), {_TEXT} FROM articles
UNION ALL SELECT 'combined', count(*), {_TEXT} FROM articles WHERE topic_key <> 't2'
UNION ALL SELECT 'enriched', count(*), {common.digest_sql('doc_id', 'names')} FROM names
UNION ALL SELECT 'objects', count(*), {common.digest_sql('doc_id', 'n', 'r')} FROM counted
UNION ALL SELECT 'index', count(*), {common.digest_sql('doc_id', "CASE WHEN topic_key = 't1' THEN 'updated' ELSE coalesce(title, '') END")} FROM articles
UNION ALL SELECT 'exports', count(*), {common.digest_sql('content')} FROM articles
UNION ALL SELECT 'runs', 2, {common.digest_sql('d')} FROM (VALUES (DATE '2024-01-01'), (DATE '2024-01-02')) t(d)"""),
    "daily_sinks": with_(ARTICLES, """
r AS (SELECT doc_id, content, strftime(ingestion_timestamp, '%Y%m%d') AS day FROM articles)""", body="UNION ALL ".join(
        f"SELECT '{sink}' AS sink, day, count(*) AS n, {common.digest_sql('content')} FROM r GROUP BY day " for sink in ("raw", "articles", "exports"))),
    "index_versions": with_(ARTICLES, """
v AS (SELECT *, CASE WHEN doc_num % 5 = 0 THEN 'after' WHEN doc_num % 3 = 0 THEN 'newer' WHEN doc_num % 2 = 0 THEN 'other writer' ELSE 'first' END AS t FROM articles),
sent AS (SELECT (count(*) + count(*) FILTER (doc_num % 2 = 0) + 2 * count(*) FILTER (doc_num % 3 = 0) + count(*) FILTER (doc_num % 5 = 0)
  + count(*) FILTER (doc_num % 7 = 0))::BIGINT AS sent FROM articles)""", body=f"""
SELECT t AS title, count(*) AS n, {common.digest_sql('doc_id', 'content')}, (SELECT sent FROM sent) AS sent FROM v GROUP BY t"""),
    "rejected_lines": "SELECT query, pages AS rejected FROM (" + " UNION ALL ".join(
        f"""SELECT '{q.replace("'", "''")}' AS query, count(DISTINCT doc_id // {PAGE}) AS pages FROM documents
WHERE doc_id % {len(vocab.NEWS_QUERIES)} = {i} OR (doc_id + 5) % {len(vocab.NEWS_QUERIES)} = {i}""" for i, q in enumerate(vocab.NEWS_QUERIES)) + ") WHERE pages > 0",
    "file_inventory": " UNION ALL ".join(f"SELECT '{t}.parquet' AS file, count(*) AS n FROM {t}" for t in (
        "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()),
}
