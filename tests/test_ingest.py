import datetime as dt
import json

from pyspark.sql import functions as F

from conftest import rows
from tidings import schemas
from tidings.functions import ids, text
from tidings.operators import clean, ingest, profile
from tidings.sinks import files
from tidings.sources import landing


def item(**kw):
    base = dict(uri="a/b:1", url="https://x.org/1", title="T", body="B", dateTime="2025-08-07T20:02:06Z", sentiment=0.5, wgt=3.0,
                image="i", source={"title": "Src", "location": {"country": {"label": {"eng": "Peru"}}}}, categories=[{"label": "c"}, {"label": ""}])
    base.update(kw)
    return base


def landed(spark, tmp_path, *items):
    env = {"articles": {"totalResults": len(items), "results": list(items)}, "fetched_at": "2025-08-08T01:02:03", "topic_name": "Top", "topic_key": "t"}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(env))
    return landing.topic_responses(spark, str(tmp_path / "in"))


def test_canonical_rules(spark, tmp_path):
    long = "é" * 600
    raw = landed(spark, tmp_path, item(), item(uri="", url="https://x.org/2", body=long), item(uri="c", dateTime="bad", body=None, source=None),
                 item(uri="d", dateTime=None, title=None))
    now = F.lit("2030-01-01 00:00:00").cast("timestamp")
    got = {r.doc_id: r for r in ingest.canonical(raw, now).collect()}
    assert got["newsapi_ai_a_b_1"].published_at == dt.datetime(2025, 8, 7, 20, 2, 6)
    import hashlib
    md5 = got["newsapi_ai_" + hashlib.md5(b"https://x.org/2").hexdigest()]
    assert md5.description == "é" * 500 and md5.categories == ["Top"]
    bad = got["newsapi_ai_c"]
    assert (bad.published_at.year, bad.content, bad.description, bad.source) == (2030, "", "", "Unknown")
    assert got["newsapi_ai_d"].title == "" and got["newsapi_ai_d"].published_at.year == 2030
    assert ingest.flatten(ingest.canonical(raw, now)).columns == schemas.ARTICLE_15.names


def test_export_and_labels(spark, tmp_path):
    raw = landed(spark, tmp_path, item(uri="p/q", relevance=None, sim=0.25))
    r = ingest.export_rows(raw).first()
    assert (r.doc_id, r.relevance_score, r.similarity_score, r.categories) == ("p_q", 0.0, 0.25, ["c"])
    assert raw.select(text.category_labels(F.col("raw_article.categories"))).first()[0] == "c"


def test_cap_is_per_topic_and_exact(spark):
    a = spark.createDataFrame([("t0", f"d{i}", float(i)) for i in range(20)] + [("t1", "x", 1.0)], "topic_key string, doc_id string, wgt double")
    topics = spark.createDataFrame([("t0", 3), ("t1", 5)], "topic_key string, max_articles int")
    assert rows(ingest.cap_per_topic(a, topics, F.desc("wgt")).select("doc_id")) == [("d17",), ("d18",), ("d19",), ("x",)]


def test_run_log_statuses(spark):
    topics = spark.createDataFrame([("a", "u", "A"), ("b", "YOUR_X", "B"), ("c", "u", "C")], "topic_key string, uri string, name string")
    counts = spark.createDataFrame([("a", 4, None), ("b", 9, None), ("c", 1, "boom")], "topic_key string, items long, error string")
    log = ingest.run_log(topics, counts)
    assert rows(log.select("topic_key", "status", "items_processed")) == [("a", "success", 4), ("b", "skipped", 0), ("c", "error", 1)]
    assert tuple(ingest.run_summary(log).first()) == (5, 1, 1, 1)


def test_union_and_first_per_key(spark):
    wide = spark.createDataFrame([("u", 2, 1.0)], "link string, at int, wgt double")
    narrow = spark.createDataFrame([("u", 1), ("v", 5)], "link string, at int")
    out = ingest.first_per_key(ingest.union_all(wide, narrow), "link", F.asc("at"))
    assert rows(out) == [("u", 1, None), ("v", 5, None)]


def test_rss_missing_tags(spark, tmp_path):
    d = tmp_path / "rss"
    d.mkdir()
    (d / "f.xml").write_text("<rss><channel><item><title>A &amp; B</title><link>http://l/1</link><description>d</description>"
                             "<pubDate>Thu, 07 Aug 2025 20:02:06 +0000</pubDate></item><item><link>http://l/2</link></item></channel></rss>")
    got = {r.link: r for r in landing.rss_items(spark, str(d)).collect()}
    assert got["http://l/1"].title == "A & B" and got["http://l/1"].published_at == dt.datetime(2025, 8, 7, 20, 2, 6)
    assert got["http://l/2"].title == "" and got["http://l/2"].published_at is None


def test_query_source_drops_broken_and_repeats(spark, tmp_path):
    art = {"source": {"id": "r", "name": None}, "title": "t", "url": "u1", "publishedAt": "2025-01-01T00:00:00Z", "content": "c"}
    d = tmp_path / "q"
    d.mkdir()
    (d / "q.json").write_text("\n".join([json.dumps({"query": "b", "articles": [art]}), json.dumps({"query": "a", "articles": [art]}), '{"query": "z", "articles": [']))
    assert rows(landing.query_items(spark, str(d)).select("link", "source", "categories")) == [("u1", "Unknown", ["a"])]


def test_combine_only_successful(spark, tmp_path):
    a = spark.createDataFrame([("d1", "t0"), ("d2", "t1")], "doc_id string, topic_key string").withColumn("ingestion_timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    files.write_articles(a, str(tmp_path / "p"))
    log = spark.createDataFrame([("t0", "success", 1), ("t1", "error", 1)], "topic_key string, status string, items_processed int")
    out = files.combine_successful(spark, log, str(tmp_path / "p"), str(tmp_path / "c"))
    assert rows(spark.read.parquet(out).select("doc_id")) == [("d1",)]
    assert files.combine_successful(spark, log.where("status = 'none'"), str(tmp_path / "p"), str(tmp_path / "n")) == ""


def test_upsert_table_is_idempotent(spark, tmp_path):
    root = str(tmp_path / "ix")
    a = spark.createDataFrame([("d1", "x"), ("d2", "y")], "doc_id string, v string")
    b = spark.createDataFrame([("d2", "z")], "doc_id string, v string")
    for _ in range(2):      # the same batches delivered twice
        files.write_batch(a, root, 0)
        files.write_batch(b, root, 1)
    want = [("d1", "x"), ("d2", "z")]
    assert rows(files.read_latest(spark, root, "doc_id")) == want
    files.compact(spark, root, str(tmp_path / "c"), "doc_id")
    assert rows(files.read_latest(spark, str(tmp_path / "c"), "doc_id")) == want


def test_staging_rules(spark):
    ts = dt.datetime(2024, 1, 1)
    cols = "article_id string, title string, content string, description string, published_at timestamp, source_name string, url string"
    raw = spark.createDataFrame([
        ("1", "  a \n\t b ", "x  y", None, ts, "REUTERS wire", "u"), ("2", "t", None, "d", ts, "Defense and Space News", "u"),
        ("3", "t", None, "d", ts, "local paper", "u"), ("4", None, "c", "d", ts, "s", "u"), ("5", "t", "c", "d", ts, "s", None), ("6", "t", "c", "d", None, "s", "u")], cols)
    for c, t in (("author", "string"), ("url_to_image", "string"), ("search_terms", "array<string>"), ("ingestion_timestamp", "timestamp")):
        raw = raw.withColumn(c, F.lit(None).cast(t))
    out = rows(clean.staging(raw).select("article_id", "title_clean", "content_clean", "description_clean", "source_name_standardized"))
    assert out == [("1", "a b", "x y", None, "Reuters"), ("2", "t", None, "d", "Defense News"), ("3", "t", None, "d", "Local Paper")]


def test_relevance_and_priority(spark):
    a = spark.createDataFrame([("1", "Reuters"), ("2", "X"), ("3", "X")], "article_id string, source_name_standardized string")
    many = [str(i) for i in range(60)]
    e = spark.createDataFrame([("1", ["c"], ["a"], None, None, []), ("3", many, [], ["Drone kit"], [], [])],
                              "article_id string, companies array<string>, agencies array<string>, technologies array<string>, funding_mentions array<string>, contract_mentions array<string>")
    s = clean.with_relevance(a, e)
    got = {r.article_id: round(r.final_relevance_score, 6) for r in s.collect()}
    assert got == {"1": 0.6, "2": 0.0, "3": 10.0}
    flags = s.where("article_id = '3'").select(*clean.technology_flags(F.col("technologies"))).first()
    assert tuple(flags) == (False, False, False, True)
    assert [r[0] for r in spark.range(1).select(F.explode(F.array(*[clean.priority(F.lit(x)) for x in (5.0, 2.0, 0.5, 0.4)]))).collect()] == [
        "High Priority", "Medium Priority", "Low Priority", "Background"]


def test_phrase_tags_match_whole_words(spark):
    a = spark.createDataFrame([(1, "New naval-systems, and a Digital  Twin."), (2, "naval system"), (3, "")], "doc_num long, content string")
    assert rows(clean.phrase_tags(a)) == [(1, "defense"), (1, "manufacturing"), (1, "tier_1"), (1, "tier_2")]


def test_router_and_filters(spark):
    a = spark.createDataFrame([("the Military said",), ("militaryish",), (None,)], "content string")
    assert [r.matched for r in clean.route(a).collect()] == [True, True, None]


def test_profile_empty_and_null_handling(spark, tmp_path):
    raw = landed(spark, tmp_path, item(body="abc", relevance=1.0), item(body="", relevance=None), item(body="abcd", relevance=2.0))
    assert tuple(profile.length_stats(raw, "body").first()) == ("body", 2, 3, 4, 3)
    assert tuple(profile.score_stats(raw, "relevance").first()) == ("relevance", 2, 1.0, 2.0, 1.5)


def test_ids(spark):
    r = spark.createDataFrame([("HTTPS://WWW.X.org/A/?q=1#f",)], "u string").select(ids.canonical_url(F.col("u")), ids.host(F.col("u"))).first()
    assert tuple(r) == ("https://www.x.org/A", "x.org")


def test_document_scan_skips_unreadable_files(spark, tmp_path):
    a = spark.createDataFrame([("d1", "T", "body"), ("d2", "U", ""), ("d3", "V", None)], "doc_id string, title string, content string")
    for f in schemas.ARTICLE_15.fields:
        if f.name not in a.columns:
            a = a.withColumn(f.name, F.lit(None).cast(f.dataType))
    a.select(schemas.ARTICLE_15.names).write.parquet(str(tmp_path / "p"))
    (tmp_path / "p" / "broken.parquet").write_bytes(b"not parquet")
    docs = files.scan_documents(spark, str(tmp_path / "p"))
    assert rows(docs.select("page_content", "metadata.id", "metadata.categories")) == [("T\n\nbody", "d1", [])]
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "Not(EqualTo(content,))" in plan and "wgt" not in plan


def test_days_are_kept_and_retried(spark, tmp_path):
    a = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "doc_id string, d string").withColumn("topic_key", F.lit("t"))
    a = a.withColumn("ingestion_timestamp", F.to_timestamp("d")).drop("d")
    for which in ("a", "b", "a"):
        files.write_raw_json(a.where(F.col("doc_id") == which), str(tmp_path / "raw"))
    assert rows(spark.read.json(str(tmp_path / "raw")).select("doc_id")) == [("a",), ("b",)]
    for run in ("1", "2", "2"):
        files.write_summary(a.agg(F.count("*").alias("n")), str(tmp_path / "runs"), run, "2024-01-0" + run)
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 2


def test_index_writers_ties_and_compaction(spark, tmp_path):
    def delta(*r):
        return spark.createDataFrame(list(r), "k string, v string, t int")
    root, folded = str(tmp_path / "ix"), str(tmp_path / "folded")
    assert files.write_batch(delta(("a", "old", 1), ("b", "old", 1)), root, 0, "w1") == 2
    files.write_batch(delta(("b", "other", 2)), root, 0, "w2")
    files.write_batch(delta(("a", "late version", 3), ("a", "early version", 2)), root, 1, "w1")
    latest = lambda r: {x.k: x.v for x in files.read_latest(spark, r, "k", order="t").collect()}
    assert latest(root) == {"a": "late version", "b": "other"}
    files.compact(spark, root, folded, "k", order="t")
    files.write_batch(delta(("c", "new", 1)), folded, 0, "w1")
    assert latest(folded) == {"a": "late version", "b": "other", "c": "new"}
    files.write_batch(delta(("c", "new", 1)), folded, 0, "w1")
    assert spark.read.parquet(folded).count() == 3


def test_skipped_files_are_named(spark, tmp_path):
    root = tmp_path / "p"
    spark.createDataFrame([("d", "text")], "doc_id string, content string").coalesce(1).write.parquet(str(root))
    (root / "broken.parquet").write_bytes(b"PAR1 cut off")
    docs = files.scan_documents(spark, str(root))
    assert docs.count() == 1
    assert [r.path.rsplit("/", 1)[1] for r in files.skipped_files(spark, str(root)).collect()] == ["broken.parquet"]


def test_query_items_range_sources_and_rejects(spark, tmp_path):
    from tidings.sources import landing
    item = '{"source": {"name": "%s"}, "url": "%s", "publishedAt": "2024-01-0%dT00:00:00Z"}'
    (tmp_path / "a.json").write_text('{"query": "q", "articles": [%s, %s, %s]}\n{"query": "broken\n' % (item % ("A", "u1", 1), item % ("B", "u2", 2), item % ("A", "u3", 3)))
    day = lambda d: F.lit(f"2024-01-0{d}").cast("timestamp")
    links = lambda **o: sorted(r.link for r in landing.query_items(spark, str(tmp_path), **o).collect())
    assert links() == ["u1", "u2", "u3"] and links(sources=("A",)) == ["u1", "u3"]
    assert links(published_from=day(2)) == ["u2", "u3"] and links(published_from=day(2), published_to=day(2)) == ["u2"]
    assert [r.line for r in landing.rejected_lines(spark, str(tmp_path)).collect()] == ['{"query": "broken']


def test_router_matches_anywhere_and_literally(spark):
    a = spark.createDataFrame([("the militarys plan",), ("xdarpax",), ("a.b",), ("aXb",)], "content string")
    assert [r.matched for r in clean.route(a).collect()] == [True, True, False, False]
    assert [r.matched for r in clean.route(a, ("a.b",)).collect()] == [False, False, True, False]


def test_envelopes_are_filled_where_rows_are_read(spark):
    from tidings.plans import io
    df = spark.range(950).selectExpr("CAST(id % 7 AS STRING) AS topic", "nullif(id % 3, 0) AS page", "named_struct('id', id, 'text', repeat('x', CAST(id % 5 AS INT))) AS items").coalesce(2)
    got = io.enveloped(df)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    pages = got.collect()
    assert all(0 < len(r.items) <= io.PAGE for r in pages)
    assert sorted((r.topic, str(r.page), i.id, i.text) for r in pages for i in r.items) == sorted((r.topic, str(r.page), r["items"].id, r["items"].text) for r in df.collect())
    one = spark.range(250).selectExpr("id % 1 AS k", "named_struct('id', id) AS items").coalesce(1)
    assert sorted(len(r["items"]) for r in io.enveloped(one).collect()) == [50, 100, 100]
    assert io.enveloped(one.limit(0)).count() == 0


def test_latest_rows_shuffle_no_column_that_is_not_asked(spark, tmp_path):
    root = str(tmp_path / "index")
    for batch, title in enumerate(("old", "new")):
        files.write_batch(spark.createDataFrame([(i, title, "x" * 50) for i in range(9 - 5 * batch)], "doc_id long, title string, content string"), root, batch)
    latest = files.read_latest(spark, root, "doc_id", columns=["title"])
    assert rows(latest) == [(i, "new" if i < 4 else "old") for i in range(9)]
    assert rows(latest) == rows(files.read_latest(spark, root, "doc_id").select("doc_id", "title"))


def test_streams_read_packed_and_plain_enriched_files(spark, tmp_path):
    from tidings.streaming import flows
    one = '{"doc_id": "%s", "metadata": {"id": "%s"}}'
    (tmp_path / "w-0").mkdir()
    (tmp_path / "w-0" / "part-0.json").write_text(one % ("a", "a"))
    spark.createDataFrame([(one % ("b", "b"),)], "value string").coalesce(1).write.options(**files.PACKED).mode("append").text(str(tmp_path / "w-1"))
    assert [p.name for p in (tmp_path / "w-1").glob("part-*.gz")]
    for f in (tmp_path / "w-1").glob("part-*.txt.gz"):
        (tmp_path / "w-1" / "part-1.json.gz").write_bytes(f.read_bytes())
    got, chk = str(tmp_path / "got"), str(tmp_path / "chk")
    flows.run_available(flows.enriched_stream(spark, str(tmp_path)), lambda df, k: df.select("doc_id").write.mode("append").parquet(got), chk)
    assert rows(spark.read.parquet(got)) == [("a",), ("b",)]
