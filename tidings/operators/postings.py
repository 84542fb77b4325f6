"""Stored postings: keyword search without reading the corpus again.

An index is a folder with one delta per batch of documents and three tables in
each: ``postings`` (term, doc_num, tf, dl), a segment per task that read texts,
sorted by term, so that the statistics of its parts tell which terms they hold
and what a document gains is summed where its segment is read; ``terms`` (term, df, most,
shortest), whose frequencies add up over deltas; and ``corpus`` (docs,
tokens), one row.  A batch written again replaces its own delta and nothing
else.  A document belongs to one batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidings import vocab
from tidings.functions import text
from tidings.operators import search
from tidings.operators.vector import DIGITS, rank_hits
from tidings.session import materialize, small

LEADING = 3        # terms per query, those that weigh most, that set the score to beat
SLACK = 1e-6       # bounds are kept apart by more than rounding
POSTINGS = "term string, doc_num long, tf double, dl double"
TERMS = "term string, df long, most double, shortest double"
CORPUS = "docs long, tokens long"


def add(docs: DataFrame, root: str, batch: str) -> None:
    """Index ``docs`` (doc_num, content) as the delta ``batch`` below ``root``.

    Each text is tokenised once and its postings are written where it was read,
    without a shuffle; the other tables are made from them.  A text that is null
    or empty counts as a document without tokens.
    """
    spark, at = docs.sparkSession, f"{root}/postings/batch={batch}"
    tokens = docs.select("doc_num", F.coalesce(text.tokens(F.col("content")), F.array().cast("array<string>")).alias("tokens"))
    counted = tokens.select("doc_num", F.size("tokens").cast("double").alias("dl"), F.explode_outer(search.term_counts(F.col("tokens"))).alias("t"))
    rows = counted.where("t IS NOT NULL").select("t.term", "doc_num", "t.tf", "dl")
    rows.sortWithinPartitions("term", "doc_num").write.mode("overwrite").option("compression", "zstd").parquet(at)
    kept = spark.read.schema(POSTINGS).parquet(at)
    kept.groupBy("term").agg(F.count("*").alias("df"), F.max("tf").alias("most"), F.min("dl").alias("shortest")).write.mode("overwrite").parquet(f"{root}/terms/batch={batch}")
    length = kept.agg(F.coalesce(F.sum("tf"), F.lit(0)).cast("bigint").alias("tokens"))
    docs.agg(F.count_distinct("doc_num").alias("docs")).crossJoin(length).write.mode("overwrite").parquet(f"{root}/corpus/batch={batch}")


def _read(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{root}/{table}")


def _gain(tf: Column, dl: Column, avgdl: float) -> Column:
    k1, b = vocab.BM25_K1, vocab.BM25_B
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))


def _weights(spark: SparkSession, root: str, queries: DataFrame) -> tuple[DataFrame, float]:
    """(query_id, term, idf, place, rest): a query's terms by how much a
    document can gain from them; ``rest`` is the most it gains from a term and
    all after it."""
    docs, tokens = _read(spark, root, "corpus", CORPUS).agg(F.sum("docs"), F.sum("tokens")).first()
    avgdl = (tokens or 0) / docs if docs and tokens else 1.0
    asked = materialize(search.query_terms(queries), "asked")
    known = _read(spark, root, "terms", TERMS).join(small(asked.select("term").distinct(), search.BROADCAST_TERMS), "term", "left_semi")
    total = known.groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most"), F.min("shortest").alias("shortest"))
    idf = F.log(1 + (F.lit(float(docs or 0)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    each = asked.join(total, "term").select("query_id", "term", idf.alias("idf"), (idf * _gain(F.col("most"), F.col("shortest"), avgdl)).alias("bound"))
    order = Window.partitionBy("query_id").orderBy(F.desc("bound"), "term")
    return materialize(each.select("query_id", "term", "idf", F.row_number().over(order).alias("place"),
                                   F.sum("bound").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("rest")), "weights"), avgdl


def _partial(postings: DataFrame, weights: DataFrame, avgdl: float) -> DataFrame:
    """Sums of what documents gain from the given query terms."""
    gained = postings.join(small(weights.select("query_id", "term", "idf"), search.BROADCAST_TERMS), "term")
    return gained.groupBy("query_id", "doc_num").agg(F.sum(F.col("idf") * _gain(F.col("tf"), F.col("dl"), avgdl)).alias("part"))


def candidates(spark: SparkSession, root: str, queries: DataFrame, k: int = 5) -> tuple[DataFrame, DataFrame, float]:
    """((query_id, doc_num, part) that may reach the first ``k``, the terms
    still to be added, mean length).

    The ``k``-th best sum over the leading terms is a score to beat.  Terms
    which together cannot reach it bring no document in, however many hold
    them, so their postings are not aggregated; documents of the other terms
    stay if their sum and the most the rest can add reach it.
    """
    weights, avgdl = _weights(spark, root, queries)
    postings = _read(spark, root, "postings", POSTINGS)
    lead = _partial(postings, weights.where(F.col("place") <= LEADING), avgdl)
    beaten = rank_hits(lead.select("query_id", "doc_num", F.col("part").alias("score")), k).where(F.col("rank") == k).select("query_id", F.col("score").alias("beat"))
    judged = materialize(weights.join(beaten, "query_id", "left").withColumn("beat", F.coalesce("beat", F.lit(0.0)))
                         .withColumn("brings", F.col("rest") + SLACK >= F.col("beat")), "judged")
    left = judged.where(~F.col("brings"))
    more = judged.groupBy("query_id").agg(F.first("beat").alias("beat"), F.coalesce(F.max(F.when(~F.col("brings"), F.col("rest"))), F.lit(0.0)).alias("more"))
    able = _partial(postings, judged.where("brings"), avgdl).join(small(materialize(more, "more"), search.BROADCAST_TERMS), "query_id")
    return materialize(able.where(F.col("part") + F.col("more") + SLACK >= F.col("beat")).select("query_id", "doc_num", "part"), "candidates"), left, avgdl


def topk(spark: SparkSession, root: str, queries: DataFrame, k: int = 5) -> DataFrame:
    """BM25 hits as ``search.keyword_leg`` finds them, from the stored postings.

    The terms that bring no document in are added for the candidates alone:
    their postings and the candidates meet once, by document, which holds a
    term once, and are summed there.
    """
    found, left, avgdl = candidates(spark, root, queries, k)
    terms = materialize(left.select("query_id", "term", "idf"), "left")
    wanted = small(materialize(terms.select("term").distinct(), "wanted"), search.BROADCAST_TERMS)
    rest = _read(spark, root, "postings", POSTINGS).join(wanted, "term", "left_semi")
    met = found.join(rest, "doc_num", "left").join(small(terms, search.BROADCAST_TERMS), ["query_id", "term"], "left")
    added = F.sum(F.col("idf") * _gain(F.col("tf"), F.col("dl"), avgdl))
    whole = met.groupBy("query_id", "doc_num").agg(F.round(F.max("part") + F.coalesce(added, F.lit(0.0)), DIGITS).alias("score"))
    return rank_hits(whole, k)
