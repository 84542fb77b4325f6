"""Mixing sources to target weights.

A source's target is its weight's share of the wanted total, held at a number
of repetitions; target over size is its repetition rate.  A document is taken
floor(rate) times and once more when a number hashed from its id falls below
the remaining fraction.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import numbered, word_count
from tidings.session import materialize, small

WEIGHTS = (5, 2, 1)          # by the source's place, repeating
SHARE = 1.5                  # wanted total over the size of all documents
MOST = 2                     # repetitions at most
SEED = "mix-1"
BROADCAST_SOURCES = 200_000  # rows of the per-source table broadcast at most; beyond it the join shuffles


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and size (words; null text: 0)."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, target of a table with source and size.

    Sources are ordered by code point, null last.  The shared level rises
    until no source is above its cap: each round is one sum over the
    per-source table, and the driver keeps two numbers.  A source of size 0
    has target 0.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = numbered(per_source, [F.col("source").asc_nulls_last()], "_place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_place") % len(weights) + 1).cast("int"))
    t = materialize(place.select("source", "source_size", weight.alias("_weight"), (F.col("source_size") * float(most)).alias("_cap")), "sources")
    budget = share * (t.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("_cap") <= F.lit(level) * F.col("_weight")
        used, free = t.agg(F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("_weight")))).first()
        if not free or (raised := (budget - (used or 0.0)) / free) <= level:
            break
        level = raised
    return t.select("source", "source_size", F.least("_cap", F.lit(level) * F.col("_weight")).alias("target"))


def copies(sizes: DataFrame, targets: DataFrame, seed: str = SEED) -> DataFrame:
    """Rows of ``sizes`` (doc_id, source, ...) with source_size, target and copies.

    The extra copy depends on seed and doc_id alone, so reruns agree and rows
    with one doc_id share their fate; a null doc_id counts as one id.
    """
    t = small(targets, BROADCAST_SOURCES).withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    u = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(1 << 52)
    whole = F.floor(rate)
    return (sizes.join(t, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
            .withColumn("copies", (whole + F.when(u < rate - whole, 1).otherwise(0)).cast("int")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it.

    Columns are those of ``docs``; columns named size, source_size, target or
    copies are not read and survive.  An empty table stays empty.
    """
    kept = docs.select("doc_id", "source", F.struct(*docs.columns).alias("_doc"))
    targets = materialize(source_targets(sized(docs), **options), "targets")
    drawn = copies(kept, targets)
    return drawn.where(F.col("copies") > 0).select("_doc", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("_doc.*")
