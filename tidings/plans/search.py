"""Queries: keyword, vector, hybrid, chunk and entity retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.functions import vectors
from tidings.operators import postings, search, vector
from tidings.plans import common
from tidings.plans.sql import ARTICLES, GAZETTEER, TOKENS, with_
from tidings.session import materialize, scratch
from tidings.sources import tables

DEPTH = 50
ASKED = 50       # similarity searches ask for the ids divisible by it, against all rows


def _hits(df):
    return df.select("query_id", "doc_num", F.round("score", 6).alias("score"), "rank")


def bm25_topk(spark, sf):
    h = search.keyword_search(common.text_articles(spark, sf), tables.search_queries(spark, sf), 5)
    return h.select("query_id", "doc_num", F.round("score", 6).alias("score"), "rank", "total_matches")


def stored_topk(spark, sf):
    """The same search from stored postings, written in two arrivals."""
    root = scratch(spark, "postings")
    docs = common.text_articles(spark, sf)
    postings.add(docs.where("doc_num % 4 <> 3"), root, "first")
    postings.add(docs.where("doc_num % 4 = 3"), root, "second")
    return _hits(postings.topk(spark, root, tables.search_queries(spark, sf), 5))


def vector_topk(spark, sf):
    return _hits(vector.exact_topk(tables.doc_vectors(spark, sf), tables.search_queries(spark, sf), 5))


def hybrid_rrf(spark, sf):
    return _hits(search.hybrid_search(common.text_articles(spark, sf), tables.doc_vectors(spark, sf),
                                      tables.search_queries(spark, sf), 5, DEPTH))


def filtered_search(spark, sf):
    a = tables.spread(tables.articles(spark, sf).select("doc_num", "content", "source", "topic_name", "published_at"), "doc_num")
    where = search.filters(topic="Topic t1", published_from=F.lit("2024-01-11 00:00:00").cast("timestamp"))
    return _hits(search.filtered_search(a, tables.doc_vectors(spark, sf), tables.search_queries(spark, sf), where, 5, DEPTH))


def match_all_filtered(spark, sf):
    a = tables.articles(spark, sf).select("doc_num", "source", "topic_name", "published_at")
    return search.match_all(a, search.filters(source="src7"), 5).select("doc_num", "source", common.iso("published_at"))


def _three(spark, sf, k):
    a, v, q = common.text_articles(spark, sf), tables.doc_vectors(spark, sf), tables.search_queries(spark, sf)
    # depth x queries rows, used several times: searched once
    kw = materialize(search.keyword_leg(a, q, DEPTH), "keyword")
    vec = materialize(vector.exact_topk(v, q, DEPTH), "vector")
    hyb = vector.rank_hits(search.fuse(kw, vec), k)
    return kw.where(F.col("rank") <= k), vec.where(F.col("rank") <= k), hyb


def method_overlap(spark, sf):
    kw, vec, hyb = _three(spark, sf, 10)
    return search.overlap_report(search.method_hits(keyword=kw, vector=vec, hybrid=hyb))


def weighted_fusion(spark, sf):
    a, v, q = common.text_articles(spark, sf), tables.doc_vectors(spark, sf), tables.search_queries(spark, sf)
    _, _, found = common.found(spark, sf)
    degree = found.groupBy("doc_num").agg(F.count("*").alias("centrality"))
    kw, vec = materialize(search.keyword_leg(a, q, DEPTH), "keyword"), materialize(vector.exact_topk(v, q, DEPTH), "vector")
    return _hits(search.weighted_fusion(kw, vec, degree, 5))


def retriever(spark, sf):
    hits = search.hybrid_search(common.text_articles(spark, sf), tables.doc_vectors(spark, sf), tables.search_queries(spark, sf), 5, DEPTH)
    return search.retrieve(hits, tables.articles(spark, sf), 5).select(
        "query_id", "rank", "doc_id", "source", F.round("score", 6).alias("score"), F.md5("preview").alias("preview_md5"), F.md5("content").alias("content_md5"))


def empty_search(spark, sf):
    """Hit counts per query, a query without any match, and the match-all count."""
    q = tables.search_queries(spark, sf).select("query_id", "query_text")
    rare = spark.createDataFrame([(-1, "zzzquantumblockchainzzz")], "query_id bigint, query_text string")
    q = q.unionByName(rare)
    a = common.text_articles(spark, sf)
    counts = search.with_empty(search.bm25_scores(search.tokenised(a), q), q)
    total = a.agg(F.lit(-2).cast("bigint").alias("query_id"), F.count("*").alias("hits"))
    return counts.unionByName(total)


def ann_topk(spark, sf):
    return _hits(vector.approx_topk(tables.doc_vectors(spark, sf), tables.search_queries(spark, sf), 5))


def ann_all_cells(spark, sf):
    """Probing every cell must equal the exact result."""
    return _hits(vector.approx_topk(tables.doc_vectors(spark, sf), tables.search_queries(spark, sf), 5, cells=8, probes=8))


def recall_monitor(spark, sf):
    """Recall of the index per query; below the floor the query fails."""
    v, q = tables.doc_vectors(spark, sf), tables.search_queries(spark, sf)
    return vector.check_recall(vector.recall(vector.approx_topk(v, q, 10), vector.exact_topk(v, q, 10)))


def recall_baseline(spark, sf):
    """How much of the keyword top ten the hybrid top ten keeps."""
    kw, _, hyb = _three(spark, sf, 10)
    return vector.recall(hyb, kw)


def entity_vectors(spark, sf):
    _, _, found = common.found(spark, sf)
    means = (found.join(tables.doc_vectors(spark, sf), "doc_num").groupBy("entity_id", "alias")
             .agg(vectors.mean_vector(F.col("embedding")).alias("embedding"), F.count("*").alias("docs")))
    return materialize(means, "entity_vectors")


def entity_similarity(spark, sf):
    """Neighbours by mean document vector, against all entities, of those whose hashed id is divisible by ASKED."""
    ents = entity_vectors(spark, sf)
    number = F.conv(F.substring(F.md5("alias"), 1, 7), 16, 10).cast("bigint")
    top = ents.where(number % ASKED == 0).select(F.col("alias").alias("query_id"), F.col("embedding").alias("query_vector"))
    hits = vector.exact_topk(ents, top, 6, id_col="alias")
    return hits.select("query_id", F.col("doc_num").alias("alias"), F.round("score", 6).alias("score"), "rank")


def _edge_texts(spark, sf):
    """One line per customer-supplier relation: the text an edge vector is made of."""
    e = tables.awards(spark, sf)
    sums = e.groupBy("src", "dst", "type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))
    return materialize(sums.select(F.concat_ws(">", "src", "dst").alias("edge_id"), "total",
                    F.array(F.concat(F.lit("buyer"), F.col("src")), F.concat(F.lit("seller"), F.col("dst")),
                            F.concat(F.lit("orders"), F.col("n").cast("string")),
                            F.concat(F.lit("size"), F.length(F.floor("total").cast("string")).cast("string"))).alias("tokens")), "edge_texts")


def edge_similarity(spark, sf):
    """Relations most like those of the customers whose id is divisible by ASKED with the suppliers whose id is divisible by 10, among all."""
    e = _edge_texts(spark, sf)
    end = lambda kind: F.regexp_extract("edge_id", kind + r":(\d+)", 1).cast("bigint")
    top = e.where((end("c") % ASKED == 0) & (end("s") % 10 == 0)).select(F.col("edge_id").alias("query_id"), "tokens")
    hits = vector.exact_topk_alike(e, top, 5, vectors.embed_tokens, id_col="edge_id")
    return hits.select("query_id", F.col("doc_num").alias("edge_id"), F.round("score", 6).alias("score"), "rank")


def chunk_retrieval(spark, sf):
    h = search.chunk_search(common.text_articles(spark, sf), tables.search_queries(spark, sf), 5)
    return h.select("query_id", "doc_num", F.round("score", 6).alias("score"), "chunk_no", "rank")


def chunk_vectors(spark, sf):
    """Best chunk per document by the vector of its words, for every benchmark item."""
    h = search.chunk_vector_search(common.text_articles(spark, sf), tables.search_queries(spark, sf), 5)
    return h.select("query_id", "doc_num", F.round("score", 6).alias("score"), "chunk_no", "rank")


def chunk_stats(spark, sf):
    c = search.chunked(common.text_articles(spark, sf))
    return c.groupBy("doc_num").agg(F.count("*").alias("chunks"), F.sum(F.size("tokens")).alias("tokens"),
                                    F.max(F.size("tokens")).cast("bigint").alias("longest"))


def summary_vectors(spark, sf):
    """Document vector beside its chunk vectors: mean of the chunk vectors."""
    c = search.chunked(common.text_articles(spark, sf)).select("doc_num", vectors.embed_tokens(F.col("tokens")).alias("v"))
    out = c.groupBy("doc_num").agg(F.count("*").alias("chunks"), vectors.mean_vector(F.col("v")).alias("summary_v1"))
    return out.select("doc_num", "chunks", F.round(vectors.norm(F.col("summary_v1")), 6).alias("norm"))


def doc_vector_join(spark, sf):
    a = tables.articles(spark, sf).select("doc_num", "source").join(tables.doc_vectors(spark, sf), "doc_num", "left")
    return a.groupBy("source").agg(F.count("*").alias("articles"), F.count("embedding").alias("with_vector"),
                                   F.count_if(F.col("embedding").isNull()).alias("without_vector"))


def embed_hash(spark, sf):
    t = common.tokenised(spark, sf).select("doc_num", vectors.embed_tokens(F.col("tokens")).alias("v"))
    return t.select("doc_num", F.size("v").cast("bigint").alias("dim"), F.round(vectors.norm(F.col("v")), 6).alias("norm"),
                    F.round(F.array_max("v"), 6).alias("largest"), F.round(F.array_min("v"), 6).alias("smallest"))


def embed_summary(spark, sf):
    """Articles read, indexed, files and vector size of an embedding run."""
    docs = (tables.table(spark, sf, "documents").select(F.input_file_name().alias("file"))
            .groupBy("file").agg(F.count("*").alias("n"))
            .agg(F.sum("n").alias("articles_read"), F.count("*").alias("files")))
    done = (tables.table(spark, sf, "embeddings").agg(F.count("*").alias("articles_indexed"), F.max(F.size("embedding")).cast("bigint").alias("dims")))
    return docs.select("articles_read", "files", done.select("articles_indexed").scalar().alias("articles_indexed"), done.select("dims").scalar().alias("dims"))


QUERIES = {f.__name__: f for f in (
    bm25_topk, stored_topk, vector_topk, hybrid_rrf, filtered_search, match_all_filtered, method_overlap, weighted_fusion,
    retriever, empty_search, ann_topk, ann_all_cells, recall_monitor, recall_baseline, entity_similarity,
    edge_similarity, chunk_retrieval, chunk_vectors, chunk_stats, summary_vectors, doc_vector_join, embed_hash, embed_summary)}


def _bm25(name, docs, key="doc_num"):
    """BM25 tables over ``docs(key, tokens)``: <name>_scores(query_id, key, score)."""
    return f"""
{name}_stats AS (SELECT count(*)::DOUBLE AS n, avg(len(tokens)) AS avgdl FROM {docs}),
{name}_seq AS (SELECT {key}, len(tokens) AS dl, unnest(tokens) AS term FROM {docs}),
{name}_tf AS (SELECT {key}, dl, term, count(*)::DOUBLE AS tf FROM {name}_seq WHERE term IN (SELECT term FROM qterms) GROUP BY ALL),
{name}_df AS (SELECT term, count(*)::DOUBLE AS df FROM {name}_tf GROUP BY 1),
{name}_scores AS (
  SELECT query_id, {key}, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
         / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))), 9) AS score
  FROM qterms JOIN {name}_tf USING (term) JOIN {name}_df USING (term), {name}_stats GROUP BY ALL)"""


_Q = r"""
qterms AS (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM benchmark)
"""
_VQ = "vq AS (SELECT item_id AS query_id, embedding::DOUBLE[] AS qv FROM benchmark JOIN embeddings ON item_id = vec_id)"


def _ranked(name, source, k, key="doc_num"):
    return f"""{name} AS (SELECT * FROM (SELECT query_id, {key}, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, {key}) AS rank
  FROM {source}) WHERE rank <= {k})"""


def _vec(name, where=""):
    return f"""{name}_scores AS (SELECT query_id, vec_id AS doc_num, round(list_cosine_similarity(qv, embedding::DOUBLE[]), 9) AS score
  FROM vq, embeddings {where})"""


def _rrf(name, *legs):
    return f"{name}_scores AS (SELECT query_id, doc_num, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM (" + " UNION ALL ".join(
        f"SELECT query_id, doc_num, rank FROM {x}" for x in legs) + ") GROUP BY ALL)"


_HYBRID = (TOKENS, _Q, _VQ, _bm25("kw", "toks"), _ranked("kw", "kw_scores", 50), _vec("vec"), _ranked("vec", "vec_scores", 50), _rrf("hyb", "kw", "vec"))
_OUT = "SELECT query_id, doc_num, round(score, 6) AS score, rank FROM "
_VEC_TOP = with_(_VQ, _vec("vec"), _ranked("vec", "vec_scores", 5), body=_OUT + "vec")

_FUSE = """
cand AS (
  SELECT coalesce(kw.query_id, vec.query_id) AS query_id, coalesce(kw.doc_num, vec.doc_num) AS doc_num,
         coalesce(kw.score, 0) AS b, coalesce(vec.score, 0) AS v
  FROM kw FULL JOIN vec ON kw.query_id = vec.query_id AND kw.doc_num = vec.doc_num),
cent AS (SELECT doc_num, count(*)::DOUBLE AS c FROM mentions GROUP BY 1),
cc AS (SELECT query_id, doc_num, b, v, coalesce(c, 0) AS c FROM cand LEFT JOIN cent USING (doc_num)),
bb AS (SELECT query_id, min(b) AS b0, max(b) AS b1, min(v) AS v0, max(v) AS v1, min(c) AS c0, max(c) AS c1 FROM cc GROUP BY 1),
fused AS (
  SELECT query_id, doc_num, round(
    CASE WHEN v1 > v0 THEN (v - v0) / (v1 - v0) ELSE 0 END * 0.5::DOUBLE
    + CASE WHEN b1 > b0 THEN (b - b0) / (b1 - b0) ELSE 0 END * 0.3::DOUBLE
    + CASE WHEN c1 > c0 THEN (c - c0) / (c1 - c0) ELSE 0 END * 0.2::DOUBLE, 9) AS score
  FROM cc JOIN bb USING (query_id))
"""

_ENT = """
dims AS (SELECT unnest(generate_series(1, 64)) AS i),
ev AS (SELECT alias, count(*) AS docs, list(embedding::DOUBLE[]) AS vs FROM mentions JOIN embeddings ON doc_num = vec_id GROUP BY 1),
em AS (SELECT alias, max(docs) AS docs, list(m ORDER BY i) AS v FROM (
   SELECT alias, docs, i, list_avg(list_transform(vs, lambda x: x[i])) AS m FROM ev, dims) GROUP BY 1),
top AS (SELECT alias AS query_id, v AS qv FROM em WHERE ('0x' || substring(md5(alias), 1, 7))::BIGINT % 50 = 0),
es AS (SELECT query_id, alias, round(list_cosine_similarity(qv, v), 9) AS score FROM top, em)
"""

_EDGE = """
et AS (SELECT src || '>' || dst AS edge_id, count(*) AS n, sum(value::DECIMAL(18,2)) AS total, src, dst FROM awards GROUP BY src, dst),
etok AS (SELECT edge_id, unnest(['buyer' || src, 'seller' || dst, 'orders' || n, 'size' || length((floor(total)::BIGINT)::VARCHAR)]) AS tok FROM et),
es AS MATERIALIZED (SELECT edge_id, ('0x' || substring(md5(tok), 1, 7))::BIGINT % 64 AS slot,
       sum(CASE WHEN ('0x' || substring(md5(tok), 8, 1))::BIGINT % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END) AS val FROM etok GROUP BY 1, 2),
en AS (SELECT edge_id, sqrt(sum(val * val)) AS nrm FROM es GROUP BY 1),
top AS (SELECT edge_id FROM et WHERE substring(src, 3)::BIGINT % 50 = 0 AND substring(dst, 3)::BIGINT % 10 = 0),
asked AS MATERIALIZED (SELECT * FROM es WHERE edge_id IN (SELECT edge_id FROM top)),
dots AS (SELECT a.edge_id AS query_id, b.edge_id, sum(a.val * b.val) AS dot FROM asked a JOIN es b ON a.slot = b.slot GROUP BY 1, 2),
sc AS (SELECT query_id, d.edge_id, round(dot / (na.nrm * nb.nrm), 9) AS score FROM dots d JOIN en na ON na.edge_id = query_id
       JOIN en nb ON nb.edge_id = d.edge_id WHERE nb.nrm > 0)
"""

def _hashed(name, keys, seq):
    """Slot values and norms of the token vectors of ``seq(keys, term)``."""
    return f"""
{name} AS MATERIALIZED (SELECT {keys}, ('0x' || substring(md5(term), 1, 7))::BIGINT % 64 AS slot,
  sum(CASE WHEN ('0x' || substring(md5(term), 8, 1))::BIGINT % 2 = 0 THEN 1 ELSE -1 END)::DOUBLE AS val FROM {seq} GROUP BY ALL),
{name}_norm AS (SELECT {keys}, sqrt(sum(val * val)) AS norm FROM {name} GROUP BY ALL)"""


_HASH = """
slots AS (SELECT {key}, ('0x' || substring(md5(term), 1, 7))::BIGINT % 64 AS slot,
       sum(CASE WHEN ('0x' || substring(md5(term), 8, 1))::BIGINT % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END) AS val FROM {seq} GROUP BY ALL)
"""

_CHUNKS = """
starts AS (SELECT doc_num, tokens, unnest(generate_series(0, greatest(len(tokens) - 1, 0), 300)) AS s FROM toks),
chunks AS (SELECT doc_num, (s // 300)::INT AS chunk_no, tokens[s + 1 : s + 300] AS tokens FROM starts)
"""

ORACLES = {
    "chunk_vectors": with_(TOKENS, r"""
cut AS (SELECT doc_num, (pos - 1) // 300 AS chunk_no, term FROM seq),
asked AS (SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM benchmark)""",
                           _hashed("cv", "doc_num, chunk_no", "cut"), _hashed("qv", "query_id", "asked"), """
dots AS (SELECT query_id, doc_num, chunk_no, sum(q.val * c.val) AS dot FROM qv q JOIN cv c USING (slot) GROUP BY ALL),
scored AS (SELECT query_id, doc_num, chunk_no, round(dot / (a.norm * b.norm), 9) AS score FROM dots JOIN qv_norm a USING (query_id)
  JOIN cv_norm b USING (doc_num, chunk_no) WHERE a.norm > 0 AND b.norm > 0),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY query_id, doc_num ORDER BY score DESC, chunk_no) = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_num) AS rank FROM best)""", body="""
SELECT query_id, doc_num, round(score, 6) AS score, chunk_no, rank FROM placed WHERE rank <= 5"""),
    "bm25_topk": with_(TOKENS, _Q, _bm25("kw", "toks"), _ranked("kw", "kw_scores", 5), body="""
SELECT query_id, doc_num, round(score, 6) AS score, rank, total_matches FROM kw
JOIN (SELECT query_id, count(*) AS total_matches FROM kw_scores GROUP BY 1) t USING (query_id)"""),
    "stored_topk": with_(TOKENS, _Q, _bm25("kw", "toks"), _ranked("kw", "kw_scores", 5), body=_OUT + "kw"),
    "vector_topk": _VEC_TOP,
    "ann_all_cells": _VEC_TOP,
    "hybrid_rrf": with_(*_HYBRID, _ranked("hyb", "hyb_scores", 5), body=_OUT + "hyb"),
    "filtered_search": with_(ARTICLES, TOKENS, _Q, _VQ, """
kept AS (SELECT doc_num FROM articles WHERE topic_name = 'Topic t1' AND published_at >= TIMESTAMP '2024-01-11'),
ktoks AS (SELECT * FROM toks WHERE doc_num IN (SELECT doc_num FROM kept))""", _bm25("kw", "ktoks"), _ranked("kw", "kw_scores", 50),
                             _vec("vec", "WHERE vec_id IN (SELECT doc_num FROM kept)"), _ranked("vec", "vec_scores", 50),
                             _rrf("hyb", "kw", "vec"), _ranked("hyb", "hyb_scores", 5), body=_OUT + "hyb"),
    "match_all_filtered": with_(ARTICLES, body="""
SELECT doc_num, source, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at FROM (
  SELECT * FROM articles WHERE source = 'src7' ORDER BY articles.published_at DESC, doc_num LIMIT 5)"""),
    "method_overlap": with_(*_HYBRID, _ranked("hyb", "hyb_scores", 10), """
k10 AS (SELECT * FROM kw WHERE rank <= 10), v10 AS (SELECT * FROM vec WHERE rank <= 10),
alls AS (SELECT query_id, doc_num FROM k10 UNION SELECT query_id, doc_num FROM v10 UNION SELECT query_id, doc_num FROM hyb),
f AS (SELECT a.query_id, a.doc_num, k10.score AS k, v10.score AS v, hyb.score AS h FROM alls a
  LEFT JOIN k10 USING (query_id, doc_num) LEFT JOIN v10 USING (query_id, doc_num) LEFT JOIN hyb USING (query_id, doc_num))""", body="""
SELECT query_id, count(*) FILTER (k IS NOT NULL AND v IS NOT NULL) AS keyword_vector,
  count(*) FILTER (k IS NOT NULL AND h IS NOT NULL) AS keyword_hybrid, count(*) FILTER (v IS NOT NULL AND h IS NOT NULL) AS vector_hybrid,
  count(*) FILTER (k IS NOT NULL AND v IS NOT NULL AND h IS NOT NULL) AS all_three,
  count(*) FILTER (k IS NOT NULL AND v IS NULL AND h IS NULL) AS only_keyword, count(*) FILTER (v IS NOT NULL AND k IS NULL AND h IS NULL) AS only_vector,
  count(*) FILTER (h IS NOT NULL AND k IS NULL AND v IS NULL) AS only_hybrid,
  round(min(k), 6) AS keyword_min, round(max(k), 6) AS keyword_max, round(min(v), 6) AS vector_min, round(max(v), 6) AS vector_max,
  round(min(h), 6) AS hybrid_min, round(max(h), 6) AS hybrid_max FROM f GROUP BY 1"""),
    "weighted_fusion": with_(TOKENS, GAZETTEER, *_HYBRID[1:], _FUSE, _ranked("out_", "fused", 5), body=_OUT + "out_"),
    "retriever": with_(ARTICLES, *_HYBRID, _ranked("hyb", "hyb_scores", 5), body="""
SELECT query_id, rank, doc_id, source, round(score, 6) AS score, md5(replace(substring(content, 1, 150), chr(10), ' ')) AS preview_md5,
       md5(content) AS content_md5 FROM hyb JOIN articles USING (doc_num)"""),
    "empty_search": with_(TOKENS, _Q, body="""
SELECT item_id AS query_id, coalesce(hits, 0) AS hits FROM benchmark LEFT JOIN (
  SELECT query_id, count(DISTINCT doc_num) AS hits FROM qterms JOIN postings USING (term) GROUP BY 1) h ON item_id = query_id
UNION ALL SELECT -1, 0 UNION ALL SELECT -2, count(*) FROM documents"""),
    "recall_baseline": with_(*_HYBRID, _ranked("hyb", "hyb_scores", 10), body="""
SELECT query_id, count(*) AS k, count(hyb.doc_num) AS matched, round(count(hyb.doc_num) / count(*), 6) AS recall
FROM (SELECT * FROM kw WHERE rank <= 10) k10 LEFT JOIN hyb USING (query_id, doc_num) GROUP BY 1"""),
    "entity_similarity": with_(TOKENS, GAZETTEER, _ENT, _ranked("out_", "es", 6, "alias"), body="SELECT query_id, alias, round(score, 6) AS score, rank FROM out_"),
    "edge_similarity": with_("""awards AS (SELECT 'c:' || o_custkey AS src, 's:' || l_suppkey AS dst, l_extendedprice AS value
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)""", _EDGE, _ranked("out_", "sc", 5, "edge_id"), body="SELECT query_id, edge_id, round(score, 6) AS score, rank FROM out_"),
    "chunk_retrieval": with_(TOKENS, _Q, _CHUNKS, "cd AS (SELECT {'d': doc_num, 'c': chunk_no} AS chunk, tokens FROM chunks)", _bm25("ck", "cd", "chunk"), """
best AS (SELECT query_id, chunk.d AS doc_num, score, chunk.c AS chunk_no FROM ck_scores
  QUALIFY row_number() OVER (PARTITION BY query_id, chunk.d ORDER BY score DESC, chunk.c) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_num) AS rank FROM best)""", body="""
SELECT query_id, doc_num, round(score, 6) AS score, chunk_no, rank FROM r WHERE rank <= 5"""),
    "chunk_stats": with_(TOKENS, _CHUNKS, body="""
SELECT doc_num, count(*) AS chunks, sum(len(tokens))::BIGINT AS tokens, max(len(tokens)) AS longest FROM chunks GROUP BY 1"""),
    "summary_vectors": with_(TOKENS, _CHUNKS, "cs AS (SELECT doc_num, chunk_no, unnest(tokens) AS term FROM chunks)", _HASH.format(key="doc_num, chunk_no", seq="cs"), """
nrm AS (SELECT doc_num, chunk_no, sqrt(sum(val * val)) AS n FROM slots GROUP BY ALL),
cnt AS (SELECT doc_num, count(*) AS chunks FROM chunks GROUP BY 1),
mean AS (SELECT doc_num, slot, sum(CASE WHEN n > 0 THEN val / n ELSE 0 END) / max(chunks) AS m FROM slots JOIN nrm USING (doc_num, chunk_no) JOIN cnt USING (doc_num) GROUP BY 1, 2)""", body="""
SELECT doc_num, chunks, round(coalesce(sqrt(sum(m * m)), 0), 6) AS norm FROM cnt LEFT JOIN mean USING (doc_num) GROUP BY 1, 2"""),
    "doc_vector_join": """SELECT source, count(*) AS articles, count(embedding) AS with_vector, count(*) FILTER (embedding IS NULL) AS without_vector
FROM documents LEFT JOIN embeddings ON doc_id = vec_id GROUP BY 1""",
    "embed_hash": with_(TOKENS, _HASH.format(key="doc_num", seq="seq"), """
full_ AS (SELECT doc_num, unnest(generate_series(0, 63)) AS slot FROM toks),
v AS (SELECT f.doc_num, coalesce(val, 0) AS val FROM full_ f LEFT JOIN slots s ON f.doc_num = s.doc_num AND f.slot = s.slot),
n AS (SELECT doc_num, sqrt(sum(val * val)) AS n, max(val) AS hi, min(val) AS lo FROM v GROUP BY 1)""", body="""
SELECT doc_num, 64::BIGINT AS dim, CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS norm, round(CASE WHEN n > 0 THEN hi / n ELSE hi END, 6) AS largest,
       round(CASE WHEN n > 0 THEN lo / n ELSE lo END, 6) AS smallest FROM n"""),
    "embed_summary": "SELECT count(*) AS articles_read, 1::BIGINT AS files, (SELECT count(*) FROM embeddings) AS articles_indexed, (SELECT max(len(embedding)) FROM embeddings)::BIGINT AS dims FROM documents",
}
