"""Training-data pipeline: quality, near duplicates, benchmark passages, mixture, shards.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept.  The first three drop rows, the fourth repeats them, the last adds the
shard.  Columns are those of ``documents`` up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidings.llm import decontaminate, mixing, nearcopies, quality, sharding
from tidings.session import materialize
from tidings.sources.tables import table


def bounded(spark: SparkSession) -> None:
    """Python tasks get whole texts in Arrow batches of a few MB."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier predicts good."""
    bounded(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    bounded(spark)
    return nearcopies.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    bounded(spark)
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as their source's target asks."""
    bounded(spark)
    return mixing.mix(docs)


def pack_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard."""
    bounded(spark)
    return sharding.sharded(docs)


STAGES = [("quality", keep_quality), ("near_duplicates", drop_near_duplicates), ("decontaminate", drop_contaminated),
          ("mix", mix_sources), ("shard", pack_shards)]

# No stage but the mixture can be said in SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
