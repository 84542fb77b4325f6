"""Event-driven processing with file streams.

Results go to upserted tables (one folder per micro-batch), so a restarted or
re-delivered batch never duplicates rows and nothing is held on the driver.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings import schemas
from tidings.functions import text, vectors
from tidings.operators import graph, nlp, spans
from tidings.session import materialize
from tidings.sinks import files

COMPLETED, FAILED = "Completed", "Failed"


def file_stream(spark: SparkSession, schema, folder: str, pattern: str = "*.parquet", per_batch: int | None = None) -> DataFrame:
    """New parquet files of a folder, each read once."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(folder)


def run_available(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process everything not yet seen, then stop; state lives in ``checkpoint``."""
    q = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .foreachBatch(each).trigger(availableNow=True).start())
    q.awaitTermination()


def embed_and_index(articles: DataFrame, root: str, checkpoint: str, model_factory=vectors.hash_model) -> None:
    """New articles: embed, shape as search documents, upsert by doc_id."""
    def each(batch: DataFrame, batch_id: int) -> None:
        body = text.embedding_text(F.col("title"), F.col("content"), F.col("description"))
        rows = batch.withColumn("embedding", vectors.embed_tokens(text.tokens(body), model_factory))
        files.write_batch(files.search_documents(rows), root, batch_id, files.writer_id(checkpoint))

    run_available(articles, each, checkpoint)


def enrich_new(articles: DataFrame, gazetteer: DataFrame, root: str, checkpoint: str) -> None:
    """New articles: entities, relations and vectors, as enriched files for
    the graph stream.  ``gazetteer`` is a stored alias table (alias, entity_id,
    type); a batch delivered again replaces its own files."""
    writer = files.writer_id(checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("doc_num", F.col("doc_id"))
        occ = materialize(spans.occurrences(rows, gazetteer), "occurrences")
        files.write_enriched(nlp.enrich(rows, nlp.mentions(occ), nlp.adjacent_relations(occ)), f"{root}/{writer}-{batch_id}")

    run_available(articles, each, checkpoint)


def enriched_stream(spark: SparkSession, root: str) -> DataFrame:
    """Enriched files below ``root``, each read once."""
    return spark.readStream.schema(schemas.ENRICHED).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json{,.gz}").json(root)


def graph_updates(enriched: DataFrame, root: str, checkpoint: str) -> None:
    """New enriched documents: node, mention and relation rows as deltas.

    The deltas of each table are merged on reading by the graph operators.
    """
    writer = files.writer_id(checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        stamp = F.to_timestamp("metadata.published_at")
        node = batch.select("doc_id", stamp.alias("last_updated"), F.explode("graph.nodes").alias("n"))
        rel = batch.select("doc_id", stamp.alias("last_updated"), F.explode("graph.relationships").alias("r"))
        files.write_batch(batch.select(F.col("doc_id").alias("id"), "metadata.source", stamp.alias("published_at"), stamp.alias("last_updated")),
                          f"{root}/documents", batch_id, writer)
        files.write_batch(node.select(F.col("n.id").alias("id"), F.array("n.type").alias("labels"), F.col("n.properties").alias("props"),
                                      F.lit(None).cast("array<float>").alias("embedding"), "last_updated", "doc_id"), f"{root}/entities", batch_id, writer)
        files.write_batch(rel.select(F.col("r.source").alias("src"), F.col("r.target").alias("dst"), F.col("r.type").alias("type"),
                                     F.col("r.properties").alias("props"), F.col("doc_id").alias("source_doc"), "last_updated"), f"{root}/edges", batch_id, writer)

    run_available(enriched, each, checkpoint)


def read_graph(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(documents, entities, mentions, edges) merged over all deltas."""
    docs, nodes, edges = (files.read_deltas(spark, f"{root}/{part}") for part in ("documents", "entities", "edges"))
    documents = graph.upsert_documents(docs.limit(0), docs)
    entities = graph.upsert_entities(nodes.drop("doc_id").limit(0), nodes.drop("doc_id"))
    mentions = graph.mention_edges(nodes.select("doc_id", F.col("id").alias("entity_id")), documents, entities)
    return documents, entities, mentions, graph.upsert_relations(edges.limit(0), edges, entities)


# --- run events -----------------------------------------------------------------

def run_events(events: DataFrame) -> DataFrame:
    """Raw events as flow-run events."""
    kind = F.when(F.col("event_type") == "error", FAILED).when(F.col("event_type") == "purchase", COMPLETED)
    return events.withColumn("state", kind).where(F.col("state").isNotNull()).select(
        "event_id", F.col("ts").cast("timestamp").alias("occurred"), "state",
        F.concat(F.lit("flow-"), (F.col("user_id") % 10).cast("string")).alias("resource"), "user_id", "value")


def threshold_windows(events: DataFrame, within: str = "60 seconds", state: str = COMPLETED) -> DataFrame:
    """Events per resource in tumbling windows of ``within``."""
    w = F.window("occurred", within)
    return events.where(F.col("state") == state).groupBy(w.alias("w"), "resource").agg(F.count("*").alias("events")).select(
        F.col("w.start").alias("start"), "resource", "events")


def daily_summary(events: DataFrame) -> DataFrame:
    return events.groupBy(F.window("occurred", "1 day").alias("w")).agg(
        F.count("*").alias("runs"), F.count_if(F.col("state") == COMPLETED).alias("completed"),
        F.count_if(F.col("state") == FAILED).alias("failed")).select(F.col("w.start").alias("start"), "runs", "completed", "failed")


def keep_counts(events: DataFrame, count: Callable[[DataFrame], DataFrame], root: str, checkpoint: str) -> None:
    """Counts of each micro-batch as deltas; ``files.read_deltas`` summed by
    key is the total (``summed``).

    Counts add up, so no state and no watermark is needed: an event counts
    however late its file arrives, and a batch delivered again replaces its
    own delta.
    """
    run_available(events, lambda batch, batch_id: files.write_batch(count(batch), root, batch_id, files.writer_id(checkpoint)), checkpoint)


def summed(spark: SparkSession, root: str, *keys: str) -> DataFrame:
    deltas = files.read_deltas(spark, root)
    return deltas.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in deltas.columns if c not in keys])


def failure_alerts(events: DataFrame) -> DataFrame:
    """One message row per failed run."""
    failed = events.where(F.col("state") == FAILED)
    return failed.select("event_id", F.lit("Ingestion Failed").alias("subject"), F.concat(
        F.lit("Flow: "), "resource", F.lit("\nRun: "), F.col("event_id").cast("string"), F.lit("\nTime: "),
        F.date_format("occurred", "yyyy-MM-dd HH:mm:ss")).alias("body"))


def dedupe_fetches(events: DataFrame, *args: str, within: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Fetches that are not a repeat: one with the same arguments is dropped
    until ``within`` has passed since the last one kept.

    A state row per argument key holds the time of the last fetch kept, so
    the rule does not depend on how events fall into batches, as long as a
    key's events arrive in order; an event before the last one kept is a
    repeat if less than ``within`` lies between them.  The state of a key is
    removed once the watermark (``late`` behind the newest event) has passed
    its time by ``within``; an event later than the watermark is dropped.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
    gap = pd.Timedelta(within)
    keyed = events.withColumn("key", F.md5(F.concat_ws("|", *[F.col(a).cast("string") for a in args]))).withWatermark("occurred", late)

    def keep(key, batches, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        last = pd.Timestamp(state.get[0]) if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["occurred", "event_id"])
        kept = []
        for at in rows["occurred"]:
            fresh = last is None or abs(at - last) >= gap
            last = at if fresh and (last is None or at > last) else last
            kept.append(fresh)
        if last is not None:
            state.update((last.to_pydatetime(),))
            state.setTimeoutTimestamp(max(int((last + gap).timestamp() * 1000), state.getCurrentWatermarkMs() + 1))
        yield rows[kept]

    return keyed.groupBy("key").applyInPandasWithState(keep, keyed.schema, "last timestamp", "append", GroupStateTimeout.EventTimeTimeout)


def bursts(events: DataFrame, count: int = 3, within: str = "60 seconds", late: str = "1 hour", state: str = COMPLETED) -> DataFrame:
    """resource, fired: moments at which ``count`` events of a resource lie
    within ``within``, wherever a minute begins.

    A burst fires once: the next alert of a resource comes ``within`` after
    its last at the earliest.  The state of a resource is the times of its last
    ``count`` events and of its last alert; it is removed once the watermark
    (``late`` behind the newest event) has passed them by ``within``.  Events
    of a resource are taken in order within a batch; one older than those kept
    counts towards no alert before them.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
    gap = pd.Timedelta(within)
    timed = events.where(F.col("state") == state).select("resource", "occurred").withWatermark("occurred", late)

    def watch(key, batches, kept: GroupState):
        if kept.hasTimedOut:
            kept.remove()
            return
        recent, last = ([pd.Timestamp(t) for t in kept.get[0]], kept.get[1]) if kept.exists else ([], None)
        last = None if last is None or pd.isna(last) else pd.Timestamp(last)
        fired = []
        for at, same in pd.concat(list(batches)).groupby("occurred").size().items():
            recent = sorted([*recent, *[at] * min(same, count)])[-count:]
            if len(recent) == count and recent[-1] - recent[0] <= gap and recent[-1] == at and (last is None or at - last >= gap):
                fired.append(at)
                last = at
        kept.update(([t.to_pydatetime() for t in recent], None if last is None else last.to_pydatetime()))
        kept.setTimeoutTimestamp(max(int((recent[-1] + gap).timestamp() * 1000), kept.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"resource": key[0], "fired": pd.Series(fired, dtype="datetime64[ns]")})

    return timed.groupBy("resource").applyInPandasWithState(
        watch, "resource string, fired timestamp", "recent array<timestamp>, last timestamp", "append", GroupStateTimeout.EventTimeTimeout)


def keep_latest(df: DataFrame, root: str, checkpoint: str, mode: str = "update") -> None:
    """Changed result rows of each micro-batch as deltas of an upserted table."""
    run_available(df, lambda batch, batch_id: files.write_batch(batch, root, batch_id, files.writer_id(checkpoint)), checkpoint, mode)
