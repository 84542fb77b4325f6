"""Search in stored postings against search in the texts."""

import random

from conftest import rows
from tidings.operators import postings, search


def _texts(n, seed):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 40)))) for i in range(n)]


def test_equals_search_in_texts_after_two_deltas(spark, tmp_path):
    docs = _texts(400, 1) + [(900, None), (901, ""), (902, "w1 " * 4000), (903, "w1 w2"), (904, "w1 w2")]
    table = spark.createDataFrame(docs, "doc_num long, content string")
    asked = spark.createDataFrame([(i, t) for i, t in _texts(30, 2)] + [(100, ""), (101, "nowhere"), (102, "w1"), (103, "w1 w2 w1")], "query_id long, query_text string")
    root = str(tmp_path / "index")
    postings.add(table.where("doc_num < 300"), root, "a")
    postings.add(table.where("doc_num % 7 = 0"), root, "b")      # a failed run of the second batch
    postings.add(table.where("doc_num >= 300"), root, "b")
    known = spark.createDataFrame([(i, t or "") for i, t in docs], "doc_num long, content string")
    want = rows(search.keyword_leg(known, asked, 5))
    assert rows(postings.topk(spark, root, asked, 5).select("query_id", "doc_num", "score", "rank")) == want and len(want) > 100


def test_frequent_terms_bring_no_documents_in(spark, tmp_path):
    docs = [(i, "the of and" + (" rare word" if i % 100 == 0 else "")) for i in range(1000)]
    root = str(tmp_path / "index")
    postings.add(spark.createDataFrame(docs, "doc_num long, content string"), root, "a")
    asked = spark.createDataFrame([(1, "the rare word of and")], "query_id long, query_text string")
    found, left, _ = postings.candidates(spark, root, asked, 5)
    # one of the two rare words brings all ten in; the other and the frequent ones cannot beat them on their own
    assert found.count() == 10 and {r.term for r in left.collect()} == {"the", "of", "and", "word"}
    assert [r.doc_num for r in postings.topk(spark, root, asked, 5).orderBy("rank").collect()] == [0, 100, 200, 300, 400]


def test_empty_index_and_queries(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_num long, content string")
    asked = spark.createDataFrame([(1, "a")], "query_id long, query_text string")
    root = str(tmp_path / "index")
    postings.add(empty, root, "a")
    assert postings.topk(spark, root, asked, 5).count() == 0
    postings.add(spark.createDataFrame([(1, "a b")], "doc_num long, content string"), root, "b")
    assert postings.topk(spark, root, asked.limit(0), 5).count() == 0
    assert [r.doc_num for r in postings.topk(spark, root, asked, 5).collect()] == [1]


def test_postings_are_written_without_a_shuffle_and_meet_candidates_by_document(spark, tmp_path):
    from tidings.operators.postings import POSTINGS
    root = str(tmp_path / "index")
    table = spark.createDataFrame(_texts(200, 3), "doc_num long, content string").repartition(4, "doc_num")
    postings.add(table, root, "a")
    parts = spark.read.schema(POSTINGS).parquet(f"{root}/postings/batch=a").selectExpr("doc_num", "_metadata.file_path AS at").distinct()
    assert parts.count() == 200 and parts.select("at").distinct().count() > 1     # a document's terms lie in one segment
    asked = spark.createDataFrame(_texts(20, 4), "query_id long, query_text string")
    plan = postings.topk(spark, root, asked, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    assert rows(postings.topk(spark, root, asked, 5).select("query_id", "doc_num", "score", "rank")) == rows(search.keyword_leg(table, asked, 5))
