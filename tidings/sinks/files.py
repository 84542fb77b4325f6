"""File sinks.  Every write is an overwrite of what it owns (the days, the run
or the batch it holds), so a repeat of a failed job gives the same files and
nothing written by another is lost."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidings import schemas
from tidings.functions import text
from tidings.operators.graph import latest_per_key
from tidings.session import materialize, small


PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}   # of text files: a third of their size
BROADCAST_TOPICS = 100_000                                              # topics broadcast at most
DENSE = {"compression": "zstd"}                                         # of tables with texts


def _dated(articles: DataFrame) -> DataFrame:
    """Rows with their folder columns, rebalanced by them: few files per
    folder, and a folder holding most rows is split over several tasks."""
    rows = articles.withColumn("source_name", F.concat(F.lit("newsapi_ai_"), "topic_key")).withColumn(
        "date", F.date_format("ingestion_timestamp", "yyyy-MM-dd"))
    return rows.hint("rebalance", "source_name", "date")


def _by_day(rows: DataFrame, *folders: str):
    """Writer that replaces only the folders present in ``rows``."""
    return rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders)


def write_raw_json(articles: DataFrame, root: str) -> None:
    _by_day(_dated(articles), "source_name", "date").options(**PACKED).json(root)


def write_articles(articles: DataFrame, root: str) -> None:
    """Topic tables by source and day; only the days present are replaced."""
    _by_day(_dated(articles), "source_name", "date").options(**DENSE).parquet(root)


def read_articles(spark: SparkSession, *paths: str, base: str | None = None) -> DataFrame:
    """One or many article files of either variant, missing columns as null."""
    reader = spark.read.schema(schemas.ARTICLE_15)
    return (reader.option("basePath", base) if base else reader).parquet(*paths)


def scan_documents(spark: SparkSession, *paths: str) -> DataFrame:
    """Documents of article files: page content and metadata.

    Reads nine columns of rows with content (both reach the Parquet scan);
    unreadable files are skipped and the others go on: ``skipped_files`` names
    them.
    """
    rows = (spark.read.schema(schemas.ARTICLE_15).option("ignoreCorruptFiles", True).parquet(*paths)
            .where(F.col("content").isNotNull() & (F.col("content") != "")))
    return rows.select(
        text.embedding_text(F.col("title"), F.col("content"), F.col("description")).alias("page_content"),
        F.struct(F.col("doc_id").alias("id"), "title", "description", "link", "published_at", "source", "source_type",
                 F.coalesce("categories", F.array().cast("array<string>")).alias("categories")).alias("metadata"))


def skipped_files(spark: SparkSession, *paths: str) -> DataFrame:
    """path, length of the article files that gave no row: unreadable or empty.

    Files are listed without their content and compared with those the same
    scan read from; listed = read + skipped.
    """
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(list(paths))
              .select(F.col("path"), "length"))
    read = (spark.read.schema(schemas.ARTICLE_15).option("ignoreCorruptFiles", True).parquet(*paths)
            .select(F.col("_metadata.file_path").alias("path"), "doc_id", "content")
            .groupBy("path").agg(F.max(F.xxhash64("doc_id", "content")).alias("code")).where(F.col("code") >= -(1 << 63)))   # reads the pages, not only footers
    name = lambda c: F.regexp_replace(c, "^file:/+", "/")
    return listed.join(read.select(name(F.col("path")).alias("_read")), name(F.col("path")) == F.col("_read"), "left_anti")


def combine_successful(spark: SparkSession, log: DataFrame, root: str, target: str) -> str:
    """All articles of topics that succeeded with items, as one table.

    The run log decides by a semi-join on the partition column, so other
    topics' files are skipped.  Unreadable files are skipped too (``skipped_files``); '' when
    there is nothing to combine.
    """
    good = log.where((F.col("status") == "success") & (F.col("items_processed") > 0)).select(
        F.concat(F.lit("newsapi_ai_"), "topic_key").alias("source_name"))
    good = materialize(good, "successful")   # few and read first, so that no article is shuffled to meet them
    if good.limit(1).count() == 0:
        return ""
    rows = spark.read.option("ignoreCorruptFiles", True).parquet(root).join(small(good, BROADCAST_TOPICS), "source_name", "left_semi")
    rows.drop("source_name", "date").write.mode("overwrite").options(**DENSE).parquet(target)
    return target


def write_enriched(enriched: DataFrame, path: str) -> None:
    enriched.drop("embedding", "content").write.mode("overwrite").options(**PACKED).json(path)


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ENRICHED).json(path)


def vector_objects(enriched: DataFrame) -> DataFrame:
    """Vector-store rows with entity and relationship counts."""
    return enriched.select(
        F.col("doc_id").alias("document_id"), "content", "metadata.source", "metadata.source_type", "metadata.published_at",
        F.size("graph.nodes").alias("entity_count"), F.size("graph.relationships").alias("relationship_count"),
        "entities", "metadata.categories", "embedding")


def write_topic_exports(rows: DataFrame, root: str) -> None:
    """One folder per topic slug and day, beside the combined read of the root;
    days not in ``rows`` stay."""
    _by_day(rows.withColumn("day", F.date_format("fetched_at", "yyyyMMdd")), "topic_slug", "day").options(**PACKED).json(root)


def write_summary(summary: DataFrame, root: str, run_id: str, run_date: str) -> None:
    """The summary row of one run with its date; a retry of the run replaces it."""
    summary.withColumn("run_date", F.lit(run_date).cast("date")).write.mode("overwrite").parquet(f"{root}/run_id=run-{run_id}")


# --- upserted index ------------------------------------------------------------

def search_documents(embedded: DataFrame) -> DataFrame:
    """Index rows: '' for absent text, link as url, typed times, the vector."""
    return embedded.select(
        "doc_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("title", "content", "description", "source", "topic_name", "topic_key")],
        F.coalesce("link", F.lit("")).alias("url"), "published_at", "ingestion_timestamp",
        F.col("embedding").alias("content_vector"))


def writer_id(checkpoint: str) -> str:
    """Name of the stream that owns a checkpoint."""
    return "w" + hashlib.md5(checkpoint.encode()).hexdigest()[:12]


def write_batch(rows: DataFrame, root: str, batch_id: int, writer: str = "main") -> int:
    """One delta of an upserted table; returns the number of rows upserted.

    A batch owns its folder under its writer's, so a re-delivered batch
    replaces itself and never that of another writer, whose batches are
    numbered from 0 as well.  Cost follows the delta's size.
    """
    seen = Observation()
    rows.observe(seen, F.count("*").alias("n")).write.mode("overwrite").options(**DENSE).parquet(f"{root}/writer={writer}/batch_id={batch_id}")
    return seen.get["n"]


def read_deltas(spark: SparkSession, root: str) -> DataFrame:
    """All rows of all batches, without the folders' columns."""
    return spark.read.parquet(root).drop("writer", "batch_id")


def read_latest(spark: SparkSession, root: str, *keys: str, order: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Current rows of an upserted table, with the keys and ``columns`` (default: all); no others are shuffled.

    Per key the row with the greatest ``order`` wins (for example an ingestion
    time), whichever writer sent it; without one the newest batch.  Equal rows
    go by batch, writer and content, so the winner never depends on the run.
    """
    rows = spark.read.parquet(root)
    own = [c for c in rows.columns if c not in ("writer", "batch_id")]
    ranked = rows.withColumn("_content", F.xxhash64(*own))
    by = ([order] if order else []) + ["batch_id", "writer", "_content"]
    asked = own if columns is None else [*keys, *[c for c in columns if c not in keys]]
    return latest_per_key(ranked.select(*dict.fromkeys([*asked, *by])), list(keys), *by).select(*asked)


def compact(spark: SparkSession, root: str, target: str, *keys: str, order: str | None = None) -> None:
    """Fold all deltas into one batch of a new table, older than any other."""
    write_batch(read_latest(spark, root, *keys, order=order), target, -1, "compacted")
