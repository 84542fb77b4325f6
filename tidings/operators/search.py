"""Keyword, hybrid and filtered retrieval over article tables.

A hit list has columns ``query_id, doc_num, score, rank``.  Scores are
rounded to nine digits before ranking so that summation order never decides
a tie; equal scores rank by document id.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings import vocab
from tidings.functions import text, vectors
from tidings.operators.ingest import union_all
from tidings.operators.vector import DIGITS, exact_topk, exact_topk_groups, rank_hits
from tidings.session import materialize, small, within

BROADCAST_TERMS = 200_000   # query-term rows broadcast at most: some 20 MB


def tokenised(articles: DataFrame, id_col: str = "doc_num", content: str = "content") -> DataFrame:
    return articles.select(F.col(id_col), text.tokens(F.col(content)).alias("tokens"))


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, df): distinct terms per row, then map-side-combined counts."""
    return (docs.select(text.explode_tokens(F.array_distinct("tokens")).alias("term"))
            .where(F.col("term").isNotNull()).groupBy("term").agg(F.count("*").alias("df")))


def query_terms(queries: DataFrame) -> DataFrame:
    """Distinct terms of each query."""
    return (queries.select("query_id", text.explode_tokens(F.array_distinct(text.tokens(F.col("query_text")))).alias("term"))
            .where(F.col("term").isNotNull()))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once: a lambda would repeat it
    for every element it is called on."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def term_counts(tokens: Column) -> Column:
    """Distinct tokens of one row with their counts, from the sorted tokens:
    a run of equal ones ends where the next differs."""
    def runs(ranked):
        n = F.size(ranked)
        ends = F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (F.get(ranked, i - 1) != F.get(ranked, i)))
        return _bound(ends, lambda e: F.transform(e, lambda end, k: F.struct(
            F.get(ranked, end - 1).alias("term"), (end - F.when(k > 0, F.get(e, k - 1)).otherwise(0)).cast("double").alias("tf"))))
    return F.when(F.size(tokens) > 0, _bound(F.array_sort(tokens), runs))


def bm25_scores(docs: DataFrame, queries: DataFrame, id_col: str = "doc_num") -> DataFrame:
    """(query_id, id, score) for every document sharing a term with a query.

    ``docs`` holds ``id_col`` and ``tokens``, one row per document.  Each task
    counts the terms of its own rows and drops those outside the query
    vocabulary; these counts are written once and serve document frequencies
    and scores.  A document's scores are summed where it was read, so what is
    shuffled is one row per query and document.  The query terms are counted
    first: up to ``BROADCAST_TERMS`` rows they are broadcast, so a stop word
    in most documents never meets a shuffle by term; beyond that the joins
    shuffle and adaptive execution splits hot terms.
    """
    terms = query_terms(queries)
    hint = F.broadcast if within(terms, BROADCAST_TERMS) else (lambda df: df)
    n_docs, avgdl = docs.agg(F.count("*").cast("double"), F.avg(F.size("tokens"))).first()

    counted = docs.select(F.col(id_col), F.size("tokens").cast("double").alias("dl"), F.explode_outer(term_counts(F.col("tokens"))).alias("t"))
    hits = materialize(counted.select(id_col, "dl", "t.*").join(hint(terms.select("term").distinct()), "term"), "hits")
    df = hits.groupBy("term").agg(F.count("*").cast("double").alias("df"))
    # one row per query term, carrying its idf
    weights = terms.join(hint(df), "term").select(
        "query_id", "term", F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    tf, k1, b = F.col("tf"), vocab.BM25_K1, vocab.BM25_B
    gain = F.col("idf") * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("dl") / avgdl))
    return (hits.join(hint(weights), "term").groupBy("query_id", id_col)
            .agg(F.round(F.sum(gain), DIGITS).alias("score")))


def keyword_search(articles: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """BM25 top-k per query with the total number of matches."""
    scores = materialize(bm25_scores(tokenised(articles), queries), "scores")
    totals = scores.groupBy("query_id").agg(F.count("*").alias("total_matches"))
    return rank_hits(scores, k).join(totals, "query_id")


def keyword_leg(articles: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    return rank_hits(bm25_scores(tokenised(articles), queries), k)


def fuse(*legs: DataFrame) -> DataFrame:
    """Reciprocal rank fusion of hit lists."""
    part = union_all(*[leg.select("query_id", "doc_num", (F.lit(1.0) / (vocab.RRF_K + F.col("rank"))).alias("p")) for leg in legs])
    return part.groupBy("query_id", "doc_num").agg(F.round(F.sum("p"), DIGITS).alias("score"))


def hybrid_search(articles: DataFrame, vectors: DataFrame, queries: DataFrame, k: int = 5, depth: int = 50) -> DataFrame:
    return rank_hits(fuse(keyword_leg(articles, queries, depth), exact_topk(vectors, queries, depth)), k)


def filters(source: str | None = None, topic: str | None = None, published_from: Column | None = None) -> Column:
    """Conjunction of the filters given; values are literals, never spliced text."""
    conds = []
    if source is not None:
        conds.append(F.col("source") == F.lit(source))
    if topic is not None:
        conds.append(F.col("topic_name") == F.lit(topic))
    if published_from is not None:
        conds.append(F.col("published_at") >= published_from)
    return reduce(and_, conds, F.lit(True))


def filtered_search(articles: DataFrame, vectors: DataFrame, queries: DataFrame, where: Column, k: int = 5, depth: int = 50) -> DataFrame:
    """Filter first, then search what is left."""
    kept = articles.where(where)
    return hybrid_search(kept, vectors.join(kept.select("doc_num"), "doc_num", "left_semi"), queries, k, depth)


def match_all(articles: DataFrame, where: Column, k: int = 5) -> DataFrame:
    """``*`` with filters: newest first."""
    return articles.where(where).orderBy(F.desc("published_at"), "doc_num").limit(k)


def with_empty(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """Hits per query; a query without hits is a row with zero."""
    counted = hits.groupBy("query_id").agg(F.count("*").alias("hits"))
    return queries.select("query_id").join(counted, "query_id", "left").select("query_id", F.coalesce("hits", F.lit(0)).alias("hits"))


def method_hits(**methods: DataFrame) -> DataFrame:
    return union_all(*[h.select(F.lit(m).alias("method"), "query_id", "rank", "doc_num", "score") for m, h in methods.items()])


def overlap_report(hits: DataFrame) -> DataFrame:
    """Per query: pairwise and triple overlaps, ids unique to each method and
    score ranges, from one grouping of the hit table."""
    by_doc = hits.groupBy("query_id", "doc_num").agg(
        *[F.max(F.when(F.col("method") == m, F.col("score"))).alias(m) for m in ("keyword", "vector", "hybrid")])
    k, v, h = (F.col(m).isNotNull() for m in ("keyword", "vector", "hybrid"))
    ranges = [f(m).alias(f"{m}_{n}") for m in ("keyword", "vector", "hybrid")
              for n, f in (("min", lambda c: F.round(F.min(c), 6)), ("max", lambda c: F.round(F.max(c), 6)))]
    return by_doc.groupBy("query_id").agg(
        F.count_if(k & v).alias("keyword_vector"), F.count_if(k & h).alias("keyword_hybrid"),
        F.count_if(v & h).alias("vector_hybrid"), F.count_if(k & v & h).alias("all_three"),
        F.count_if(k & ~v & ~h).alias("only_keyword"), F.count_if(v & ~k & ~h).alias("only_vector"),
        F.count_if(h & ~k & ~v).alias("only_hybrid"), *ranges)


def weighted_fusion(keyword: DataFrame, vector: DataFrame, centrality: DataFrame, k: int) -> DataFrame:
    """Min-max normalised scores of both legs and a per-document centrality,
    combined with fixed weights over the union of candidates."""
    both = (keyword.select("query_id", "doc_num", F.col("score").alias("bm25"))
            .join(vector.select("query_id", "doc_num", F.col("score").alias("vector")), ["query_id", "doc_num"], "full_outer")
            .join(centrality.select("doc_num", F.col("centrality").cast("double")), "doc_num", "left"))
    names = tuple(vocab.FUSION_WEIGHTS)
    bounds = both.groupBy("query_id").agg(
        *[f(F.coalesce(n, F.lit(0.0))).alias(f"{n}_{m}") for n in names for m, f in (("lo", F.min), ("hi", F.max))])

    def scaled(n):
        span = F.col(f"{n}_hi") - F.col(f"{n}_lo")
        return F.when(span > 0, (F.coalesce(n, F.lit(0.0)) - F.col(f"{n}_lo")) / span).otherwise(0.0)

    total = reduce(lambda a, b: a + b, [scaled(n) * F.lit(w) for n, w in vocab.FUSION_WEIGHTS.items()])
    scored = both.join(bounds, "query_id").select("query_id", "doc_num", F.round(total, DIGITS).alias("score"))
    return rank_hits(scored, k)


def retrieve(hits: DataFrame, articles: DataFrame, k: int = 5) -> DataFrame:
    """Content previews and metadata for the first ``k`` hits.

    The hits are few and written first; the articles are read once and never
    shuffled.
    """
    top = materialize(hits.where(F.col("rank") <= k), "hits")
    return (articles.join(small(top, BROADCAST_TERMS), "doc_num")
            .select("query_id", "rank", "doc_id", "source", "title", "score",
                    text.one_line(F.col("content")).alias("preview"), "content"))


def chunked(articles: DataFrame, size: int = 300) -> DataFrame:
    """Token windows of ``size`` with their number, from 0; all tokens kept."""
    toks = articles.select("doc_num", text.tokens(F.col("content")).alias("all_tokens"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("all_tokens") - 1, F.lit(0)), F.lit(size))
    return (toks.select("doc_num", "all_tokens", F.posexplode_outer(starts).alias("chunk_no", "start"))
            .select("doc_num", "chunk_no", F.slice("all_tokens", F.col("start") + 1, size).alias("tokens")))


def chunk_search(articles: DataFrame, queries: DataFrame, k: int = 5, size: int = 300) -> DataFrame:
    """BM25 over chunks, rolled up to each document's best chunk."""
    chunks = chunked(articles, size).withColumn("chunk", F.struct("doc_num", "chunk_no"))
    scores = bm25_scores(chunks.select("chunk", "tokens"), queries, "chunk")
    best = (scores.groupBy("query_id", F.col("chunk.doc_num").alias("doc_num"))
            .agg(F.max(F.struct(F.col("score"), (-F.col("chunk.chunk_no")).alias("neg"))).alias("b"))
            .select("query_id", "doc_num", F.col("b.score").alias("score"), (-F.col("b.neg")).alias("chunk_no")))
    return rank_hits(best, k)


def chunk_vector_search(articles: DataFrame, queries: DataFrame, k: int = 5, size: int = 300, embed=vectors.embed_tokens) -> DataFrame:
    """Vector search over chunks, rolled up to each document's best chunk.

    Chunks are embedded once and written.  Each task keeps its k best
    documents, so one very long document takes one place, not many.
    """
    chunks = materialize(chunked(articles, size).select("doc_num", "chunk_no", embed(F.col("tokens")).alias("embedding")), "chunks")
    asked = materialize(queries.select("query_id", embed(text.tokens(F.col("query_text"))).alias("query_vector")), "asked")
    return exact_topk_groups(chunks, asked, k, "chunk_no").select("query_id", "doc_num", "score", "chunk_no", "rank")
