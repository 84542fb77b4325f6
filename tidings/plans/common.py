"""Inputs several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings.functions import text
from tidings.operators import nlp, search, spans
from tidings.operators.ingest import union_all
from tidings.session import materialize
from tidings.sources import tables


def tokenised(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc_num"), F.col("text").alias("content"))
    return search.tokenised(tables.spread(docs, "doc_num"))


def text_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_num and content only: what the search legs read."""
    docs = tables.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc_num"), F.col("text").alias("content"))
    return tables.spread(docs, "doc_num")


def given_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names from the given tables: party and part names, and the first three
    words of each benchmark item."""
    t = lambda name: tables.table(spark, sf_dir, name)
    def of(name, prefix, key, value):
        return t(name).select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("entity_id"), F.col(value).alias("name"))
    first = F.array_join(F.slice(text.tokens(F.col("text")), 1, 3), " ")
    return union_all(of("nation", "n:", "n_nationkey", "n_name"), of("supplier", "s:", "s_suppkey", "s_name"),
                     of("customer", "c:", "c_custkey", "c_name"), of("part", "p:", "p_partkey", "p_name"),
                     t("benchmark").select(F.concat(F.lit("b:"), F.col("item_id").cast("string")).alias("entity_id"), first.alias("name")))


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(alias, entity_id, type): the given names and every two words that
    follow each other in a benchmark item, one row per name.

    A name may have any letters, length and frequency in the corpus.  The type
    is that of the name's table, for phrases of the benchmark one by their
    length; of several the first by text.
    """
    kinds = F.create_map(*[F.lit(x) for x in ("s", "Company", "c", "Company", "p", "Technology", "n", "Agency")])
    def typed(alias):
        by_length = F.element_at(F.array(*[F.lit(t) for t in nlp.TYPE_BY_LENGTH]), F.length(alias) % 4 + 1)
        return F.coalesce(kinds[F.col("origin")], by_length).alias("type")
    given = given_names(spark, sf_dir).select(F.array_join(text.tokens(F.col("name")), " ").alias("alias"), F.substring("entity_id", 1, 1).alias("origin"))
    words = tables.table(spark, sf_dir, "benchmark").select(text.tokens(F.col("text")).alias("words"))
    after = F.slice("words", F.lit(2), F.size("words"))
    pairs = words.where(F.size("words") > 1).select(F.explode(F.slice(
        F.zip_with("words", after, lambda a, b: F.concat_ws(" ", a, b)), F.lit(1), F.size("words") - 1)).alias("alias"), F.lit("b").alias("origin"))
    named = given.unionByName(pairs).where("alias != ''")
    return (named.select("alias", typed(F.col("alias"))).groupBy("alias").agg(F.min("type").alias("type"))
            .select("alias", F.md5(F.concat_ws("|", "alias", "type")).alias("entity_id"), "type"))


def found(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(gazetteer, occurrences, mentions) of the whole corpus.

    Gazetteer and occurrences are written once: the queries join them several
    times, and texts are read by the automaton once.
    """
    gaz = materialize(gazetteer(spark, sf_dir), "gazetteer")
    occ = materialize(spans.occurrences(text_articles(spark, sf_dir), gaz), "occurrences")
    return gaz, occ, nlp.mentions(occ)


def iso(column: str, name: str | None = None):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(name or column)


def digest(*columns):
    """Aggregate: sum of 32-bit codes of the rows' text, the same in any order."""
    row = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in columns])
    return F.sum(F.conv(F.substring(F.md5(row), 1, 8), 16, 10).cast("bigint")).alias("digest")


def digest_sql(*columns):
    row = "concat_ws('|', " + ", ".join(f"coalesce(({c})::VARCHAR, '?')" for c in columns) + ")"
    return f"sum(('0x' || substring(md5({row}), 1, 8))::BIGINT)::BIGINT AS digest"
