import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidings.functions import vectors
from tidings.operators import search, vector
from tidings.sources import tables

DOCS = [(1, "drone drone radar"), (2, "radar ship"), (3, "ship ship ship port"), (4, "")]
QUERIES = [(1, "drone radar"), (2, "port"), (3, "absent")]


def corpus(spark):
    return spark.createDataFrame(DOCS, "doc_num long, content string")


def queries(spark):
    return spark.createDataFrame(QUERIES, "query_id long, query_text string")


def brute_bm25():
    toks = {d: t.split() for d, t in DOCS}
    n, avg = len(DOCS), sum(map(len, toks.values())) / len(DOCS)
    out = {}
    for q, text in QUERIES:
        for d, ts in toks.items():
            s = 0.0
            for term in set(text.split()):
                tf, df = ts.count(term), sum(term in x for x in toks.values())
                if tf:
                    s += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ts) / avg))
            if s:
                out[q, d] = round(s, 9)
    return out


def test_bm25_against_formula(spark):
    got = {(r.query_id, r.doc_num): r.score for r in search.bm25_scores(search.tokenised(corpus(spark)), queries(spark)).collect()}
    assert got == brute_bm25()


def test_bm25_same_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(search, "BROADCAST_TERMS", 0)
    got = {(r.query_id, r.doc_num): r.score for r in search.bm25_scores(search.tokenised(corpus(spark)), queries(spark)).collect()}
    assert got == brute_bm25()


def test_total_and_empty(spark):
    hits = search.keyword_search(corpus(spark), queries(spark), 1)
    assert rows(hits.select("query_id", "doc_num", "total_matches")) == [(1, 1, 2), (2, 3, 1)]
    assert rows(search.with_empty(hits, queries(spark))) == [(1, 1), (2, 1), (3, 0)]


def random_vectors(spark, n, dim=8, seed=1):
    m = np.random.default_rng(seed).normal(size=(n, dim))
    return m, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "doc_num long, embedding array<double>").repartition(5)


def brute_topk(m, q, k):
    a, b = m / np.linalg.norm(m, axis=1, keepdims=True), q / np.linalg.norm(q, axis=1, keepdims=True)
    s = np.round(b @ a.T, 9)
    return {(j, int(d)) for j in range(len(q)) for d in sorted(range(len(m)), key=lambda d: (-s[j, d], d))[:k]}


def test_vector_topk_against_brute_force(spark):
    m, df = random_vectors(spark, 300)
    q, qdf = random_vectors(spark, 7, seed=2)
    qdf = qdf.select(F.col("doc_num").alias("query_id"), F.col("embedding").alias("query_vector"))
    hits = vector.exact_topk(df, qdf, 10)
    assert {(r.query_id, r.doc_num) for r in hits.collect()} == brute_topk(m, q, 10)
    assert all(-1 <= r.score <= 1 and r["rank"] <= 10 for r in hits.collect())


def test_vector_ties_by_id_and_query_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(50)], "doc_num long, embedding array<double>").repartition(4)
    q = spark.createDataFrame([(i, [2.0, 0.0]) for i in range(9)], "query_id long, query_vector array<double>")
    monkeypatch.setattr(vector, "QUERY_BLOCK", 6)     # forces more than one block
    hits = vector.exact_topk(df, q, 3).collect()
    assert {(r.query_id, r.doc_num) for r in hits} == {(j, d) for j in range(9) for d in range(3)}


def test_no_queries_is_an_empty_table(spark):
    _, df = random_vectors(spark, 5)
    q = spark.createDataFrame([(1, None)], "query_id long, query_vector array<double>")
    assert vector.exact_topk(df, q, 3).count() == 0


def test_recall_grows_with_probes(spark):
    _, df = random_vectors(spark, 400)
    _, qdf = random_vectors(spark, 10, seed=3)
    qdf = qdf.select(F.col("doc_num").alias("query_id"), F.col("embedding").alias("query_vector"))
    cells, exact = vector.fit_cells(df, 8), vector.exact_topk(df, qdf, 10)
    at = [vector.recall(vector.approx_topk(df, qdf, 10, probes=p, centroids=cells), exact).agg(F.avg("recall")).first()[0] for p in (1, 4, 8)]
    assert at[0] <= at[1] <= at[2] == 1.0 and at[1] > 0.5


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_index_reaches_the_floor(spark, sf):
    v, q = (f(spark, f"/root/testdata/{sf}") for f in (tables.doc_vectors, tables.search_queries))
    index, exact = vector.build_index(v, 10), vector.exact_topk(v, q, 10)
    report = vector.recall(vector.search_index(index, q, 10), exact)
    assert vector.check_recall(report).agg(F.avg("recall")).first()[0] >= vector.FLOOR
    assert rows(vector.search_index(index, q, 10, probes=len(index.centroids)).select("query_id", "doc_num", "rank")) == rows(exact.select("query_id", "doc_num", "rank"))
    assert index.rows.count() == v.count() and index.curve[index.probes - 1] >= vector.GOAL and index.curve[-1] == 1.0


def test_index_reads_only_probed_cells(spark):
    _, df = random_vectors(spark, 400)
    index = vector.build_index(df, 10, cells=8)
    read = index.read([0, 3])
    assert "PartitionFilters: [isnotnull(cell" in read._jdf.queryExecution().executedPlan().toString() or "PartitionFilters: [cell" in read._jdf.queryExecution().executedPlan().toString()
    files = [f.select(F.input_file_name()).distinct().count() for f in (read, index.rows)]
    assert files[0] < files[1] and {r.cell for r in read.select("cell").distinct().collect()} <= {0, 3}


def test_recall_below_the_floor_is_an_error(spark):
    report = spark.createDataFrame([(1, 10, 8, 0.8), (2, 10, 9, 0.9)], "query_id long, k long, matched long, recall double")
    with pytest.raises(ValueError, match="below"):
        vector.check_recall(report)


def test_rrf_is_symmetric(spark):
    a = spark.createDataFrame([(1, 10, 0.9, 1), (1, 11, 0.8, 2)], "query_id long, doc_num long, score double, rank int")
    b = spark.createDataFrame([(1, 11, 5.0, 1), (1, 12, 4.0, 2)], "query_id long, doc_num long, score double, rank int")
    assert rows(search.fuse(a, b)) == rows(search.fuse(b, a))
    assert rows(vector.rank_hits(search.fuse(a, b), 1))[0][1] == 11


def test_overlap_report(spark):
    def hits(*ids):
        return spark.createDataFrame([(1, d, 1.0 / (i + 1), i + 1) for i, d in enumerate(ids)], "query_id long, doc_num long, score double, rank int")
    r = search.overlap_report(search.method_hits(keyword=hits(1, 2, 3), vector=hits(2, 4), hybrid=hits(2, 3, 5))).first()
    assert (r.keyword_vector, r.keyword_hybrid, r.vector_hybrid, r.all_three, r.only_keyword, r.only_vector, r.only_hybrid) == (1, 2, 1, 1, 1, 1, 1)


def test_filters_keep_quotes_literal(spark):
    df = spark.createDataFrame([("O'Neil",), ("x",)], "source string")
    assert df.where(search.filters(source="O'Neil")).count() == 1
    assert df.where(search.filters()).count() == 2


def test_chunks_keep_every_token(spark):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(650))), (2, "")], "doc_num long, content string")
    c = search.chunked(df, 300)
    assert rows(c.select("doc_num", "chunk_no", F.size("tokens"))) == [(1, 0, 300), (1, 1, 300), (1, 2, 50), (2, 0, 0)]


def test_hashed_vectors(spark):
    df = spark.createDataFrame([(["a", "b", "a"],), ([],)], "t array<string>").select(vectors.embed_tokens(F.col("t")).alias("v"))
    norms = sorted(r[0] for r in df.select(F.round(vectors.norm(F.col("v")), 9)).collect())
    assert norms == [0.0, 1.0] and df.where(F.size("v") != vectors.HASH_DIM).count() == 0


def test_bm25_plan_has_no_shuffle_by_term_of_the_corpus(spark):
    plan = search.bm25_scores(search.tokenised(corpus(spark)), queries(spark))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("block", [2048, 3])
def test_groups_by_their_best_part(spark, monkeypatch, block):
    monkeypatch.setattr(vector, "QUERY_BLOCK", block)
    rng = np.random.default_rng(3)
    # one group of very many parts that hold all the best scores, ties, a zero vector, rows without vector or group
    parts = [(0, i, [1.0, 0.01 * (i % 5), 0.0]) for i in range(400)] + [(int(g), i, rng.integers(-2, 3, 3).astype(float).tolist()) for g in range(1, 40) for i in range(3)]
    parts += [(50, 0, [0.0, 0.0, 0.0]), (51, 0, None), (None, 0, [1.0, 0.0, 0.0])]
    asked = [(q, rng.integers(1, 4, 3).astype(float).tolist()) for q in range(8)] + [(3, [1.0, 0.0, 0.0])] * 4 + [(9, None)]
    df = spark.createDataFrame(parts, "doc_num long, chunk_no int, embedding array<double>").repartition(5)
    qs = spark.createDataFrame(asked, "query_id long, query_vector array<double>")
    got = {}
    for r in vector.exact_topk_groups(df, qs, 4, "chunk_no").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.doc_num, r.chunk_no, round(r.score, 8)))
    best = {}
    for q, v in asked:
        for g, p, x in parts:
            if v is not None and x is not None and g is not None:
                c = round(float(np.dot(v, x) / (np.linalg.norm(v) * (np.linalg.norm(x) or 1))), 9)
                best[q, g] = min(best.get((q, g), (9, 0)), (-c, p))
    want = {q: [(i + 1, g, p, round(-c, 8)) for i, ((c, p), g) in enumerate(
        sorted(((b, g) for (o, g), b in best.items() if o == q), key=lambda e: (e[0][0], e[1]))[:4])] for q in range(8)}
    assert {q: sorted(v) for q, v in got.items()} == want


def test_no_query_gives_no_group(spark):
    df = spark.createDataFrame([(1, 0, [1.0])], "doc_num long, chunk_no int, embedding array<double>")
    out = vector.exact_topk_groups(df, spark.createDataFrame([(1, None)], "query_id long, query_vector array<double>"), 4, "chunk_no")
    assert out.count() == 0 and out.columns == ["query_id", "doc_num", "chunk_no", "score", "rank"]


def test_vectors_many_rows_share_are_searched_once(spark):
    rng = random.Random(6)
    docs = [(f"d{i:03}", [f"w{rng.randint(0, 3)}" for _ in range(rng.randint(0, 3))]) for i in range(200)]
    corpus = spark.createDataFrame(docs, "edge_id string, tokens array<string>")
    asked = corpus.where("edge_id like '%7'").select(F.col("edge_id").alias("query_id"), "tokens")
    got = vector.exact_topk_alike(corpus, asked, 5, vectors.embed_tokens, id_col="edge_id")
    want = vector.exact_topk(corpus.select("edge_id", vectors.embed_tokens(F.col("tokens")).alias("embedding")),
                             asked.select("query_id", vectors.embed_tokens(F.col("tokens")).alias("query_vector")), 5, id_col="edge_id")
    assert rows(got.select(want.columns)) == rows(want) and got.count() == 100
    assert vector.exact_topk_alike(corpus, asked.limit(0), 5, vectors.embed_tokens, id_col="edge_id").count() == 0
