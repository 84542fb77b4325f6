"""Vector top-k: exact, and cell-probing approximate with exact re-rank.

The corpus is never shuffled: each task scores its own rows against a bounded
block of queries with one matrix product and keeps its own k best per query.
Only those survivors meet in the final rank.  An index keeps the vectors in one
folder per cell, so that a search opens only the cells it probes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidings.operators.ingest import union_all
from tidings.session import materialize, scratch

QUERY_BLOCK = 2048      # queries held by one task at a time
DIGITS = 9              # ranking precision; equal within it means a tie by id
FIT_ROWS = 200_000      # vectors the cell centres are fitted on at most; every vector is indexed
CALIBRATE = 256         # vectors that are searched exactly to choose the probes
FLOOR = 0.9             # recall an index must reach
GOAL = 0.95             # recall the probes are chosen for, so that other queries reach the floor


def query_blocks(queries: DataFrame, vec: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Query vectors in blocks of at most ``QUERY_BLOCK``, one at the driver at a time.

    One bounded fetch serves the usual case.  A larger set is written to the
    shared folder once with a number per row and split by a hash of it, so
    that repeated ids part too; a block that turns out too full is halved.
    """
    q = queries.where(F.col(vec).isNotNull()).select("query_id", F.col(vec).alias("v"))
    rows = q.limit(QUERY_BLOCK + 1).collect()
    if len(rows) <= QUERY_BLOCK:
        if rows:
            yield _block(rows)
        return
    kept = materialize(q.withColumn("row", F.monotonically_increasing_id()), "queries")
    parts = -(-2 * kept.count() // QUERY_BLOCK)
    left = [(i, parts) for i in reversed(range(parts))]
    while left:
        i, of = left.pop()
        rows = kept.where(F.pmod(F.xxhash64("row"), F.lit(of)) == i).select("query_id", "v").limit(QUERY_BLOCK + 1).collect()
        if len(rows) > QUERY_BLOCK:
            left += [(i + of, 2 * of), (i, 2 * of)]
        elif rows:
            yield _block(rows)


def _by_block(blocks: Iterator, hits_of) -> DataFrame | None:
    """Union of ``hits_of(ids, vectors)`` over the blocks, None without any.

    A single block stays lazy.  Of several each is searched and its hits are
    written before the next is fetched, so neither the driver nor a plan
    holds more than one.
    """
    first = next(blocks, None)
    if first is None:
        return None
    second = next(blocks, None)
    if second is None:
        return hits_of(*first)
    done = [materialize(hits_of(*b), "hits") for b in (first, second)]
    del first, second
    return union_all(*done, *[materialize(hits_of(*b), "hits") for b in blocks])


def _block(rows) -> tuple[np.ndarray, np.ndarray]:
    return np.array([r[0] for r in rows]), _unit(np.array([r[1] for r in rows], dtype=float))


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m / np.where(n == 0, 1.0, n)


def _matrix(column) -> np.ndarray:
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return arr.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(arr), -1)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """k best by (score desc, id asc), ties decided exactly."""
    if len(ids) > k:
        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[keep], scores[keep]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _nearest_cells(qmat: np.ndarray, centroids: np.ndarray, probes: int) -> np.ndarray:
    return np.argsort(-(qmat @ centroids.T), axis=1, kind="stable")[:, :probes]


def _scorer(qids: np.ndarray, qmat: np.ndarray, k: int, centroids=None, probes=None):
    """Arrow-batch function: (id, vector) rows to this task's k best per query.
    A third column, if there, is the row's cell."""
    allowed = None
    if centroids is not None:
        near = _nearest_cells(qmat, centroids, probes)
        allowed = np.zeros((len(centroids), len(qids)), dtype=bool)
        for j, cells in enumerate(near):
            allowed[cells, j] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            if b.num_rows == 0:
                continue
            ids = b.column(0).to_numpy(zero_copy_only=False)
            x = _unit(_matrix(b.column(1)))
            # rows of a cell meet only the queries that probe it
            if allowed is None:
                cell = np.zeros(len(ids), int)
            else:
                cell = b.column(2).to_numpy(zero_copy_only=False) if b.num_columns > 2 else np.argmax(x @ centroids.T, axis=1)
            for c in np.unique(cell):
                rows = np.flatnonzero(cell == c)
                asking = np.arange(len(qids)) if allowed is None else np.flatnonzero(allowed[c])
                s = np.round(x[rows] @ qmat[asking].T, DIGITS)
                for at, j in enumerate(asking.tolist()):
                    i, sc = ids[rows], s[:, at]
                    if j in best:
                        i, sc = np.concatenate([best[j][0], i]), np.concatenate([best[j][1], sc])
                    best[j] = _best(i, sc, k)
        for j, (i, sc) in best.items():
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(qids[j], len(i))), pa.array(i), pa.array(sc)],
                    names=["query_id", "doc_num", "score"])

    return run


def rank_hits(hits: DataFrame, k: int, score: str = "score", doc: str = "doc_num") -> DataFrame:
    """k best per query with their position, from 1."""
    w = Window.partitionBy("query_id").orderBy(F.desc(score), F.asc(doc))
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _search(corpus, queries, k, id_col, vec_col, query_vec, centroids=None, probes=None):
    rows = corpus.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("doc_num"), vec_col)
    schema = (f"query_id {queries.schema['query_id'].dataType.simpleString()}, "
              f"doc_num {corpus.schema[id_col].dataType.simpleString()}, score double")
    hits = _by_block(query_blocks(queries, query_vec), lambda q, m: rows.mapInArrow(_scorer(q, m, k, centroids, probes), schema))
    return corpus.sparkSession.createDataFrame([], schema + ", rank int") if hits is None else rank_hits(hits, k)


def exact_topk(corpus: DataFrame, queries: DataFrame, k: int, id_col: str = "doc_num",
               vec_col: str = "embedding", query_vec: str = "query_vector") -> DataFrame:
    """Cosine top-k of every query over the whole corpus."""
    return _search(corpus, queries, k, id_col, vec_col, query_vec)


def _classed(rows: DataFrame, id_col: str, embed: Callable, of: str, most: int | None = None) -> DataFrame:
    """x, y, id, place of the rows (the ``most`` least ids of each vector): a
    vector is told by two 64-bit hashes, and ids are numbered from 1 within it."""
    coded = rows.select(F.col(id_col).alias("id"), embed(F.col(of)).alias("v")).select(
        F.xxhash64("v").alias("x"), F.xxhash64(F.lit(1), "v").alias("y"), "id")
    placed = coded.withColumn("place", F.row_number().over(Window.partitionBy("x", "y").orderBy("id")))
    return materialize(placed if most is None else placed.where(F.col("place") <= most), "classes")


def exact_topk_alike(corpus: DataFrame, queries: DataFrame, k: int, embed: Callable, id_col: str = "doc_num", of: str = "tokens") -> DataFrame:
    """``exact_topk`` of rows (of distinct ids) whose vectors ``embed`` makes
    from a column, for vectors that many rows share.

    Equal vectors score alike, so only the k least ids of a vector can be
    hits, and they stand behind its least id: a search of the least ids, for
    one query of each vector, finds the k best vectors, which hold the k best
    rows.  Rows are shuffled as an id and two hashes, vectors never are.
    """
    members, asked = _classed(corpus, id_col, embed, of, k), _classed(queries, "query_id", embed, of)
    first = F.col("place") == 1

    def led(classes, name):
        return classes.join(classes.where(first).select("x", "y", F.col("id").alias(name)), ["x", "y"]).select(name, "id")

    def leads(rows, classes, name):
        return rows.select(name, of).join(classes.where(first).select(F.col("id").alias(name)), name, "left_semi").dropDuplicates([name])

    corpus_leads = materialize(materialize(leads(corpus, members, id_col), "leads").select(id_col, embed(F.col(of)).alias("embedding")), "vectors")
    query_leads = leads(queries, asked, "query_id").select("query_id", embed(F.col(of)).alias("query_vector"))
    found = exact_topk(corpus_leads, query_leads, k, id_col=id_col)
    # the hits of one query of each vector hold k rows; with the members of theirs at most k * k
    one = materialize(found.select(F.col("query_id").alias("asked"), F.col("doc_num").alias("lead"), "score"), "hits")
    best = rank_hits(one.join(led(members, "lead"), "lead").select(F.col("asked").alias("query_id"), F.col("id").alias("doc_num"), "score"), k)
    alike = led(asked, "asked").withColumnRenamed("id", "alike")
    every = best.withColumnRenamed("query_id", "asked").join(alike, "asked")
    return rank_hits(every.select(F.col("alike").alias("query_id"), "doc_num", "score"), k)


def _group_scorer(qids: np.ndarray, qmat: np.ndarray, k: int):
    """Arrow-batch function: (group, part, vector) rows to this task's k best
    groups per query, each with its best part; ties go to the smaller part, then group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for b in batches:
            if b.num_rows == 0:
                continue
            groups, parts = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            order = np.lexsort((parts, groups))
            groups, parts = groups[order], parts[order]
            s = np.round(_unit(_matrix(b.column(2)))[order] @ qmat.T, DIGITS)
            starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
            ends = np.r_[starts[1:], len(groups)]
            tops = np.maximum.reduceat(s, starts, axis=0)
            for j in range(len(qids)):
                at, sc = _best(np.arange(len(starts)), tops[:, j], k)
                first = np.array([starts[a] + np.argmax(s[starts[a]:ends[a], j]) for a in at])
                g, p = groups[first], parts[first]
                if j in best:
                    g, p, sc = (np.concatenate(pair) for pair in zip(best[j], (g, p, sc), strict=True))
                    once = np.lexsort((p, -sc, g))
                    once = once[np.r_[True, g[once][1:] != g[once][:-1]]]
                    g, p, sc = g[once], p[once], sc[once]
                    order = np.lexsort((g, -sc))[:k]
                    g, p, sc = g[order], p[order], sc[order]
                best[j] = (g, p, sc)
        for j, (g, p, sc) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qids[j], len(g))), pa.array(g), pa.array(p), pa.array(sc)],
                                             names=["query_id", "doc_num", "part", "score"])

    return run


def exact_topk_groups(corpus: DataFrame, queries: DataFrame, k: int, part: str, group: str = "doc_num",
                      vec_col: str = "embedding", query_vec: str = "query_vector") -> DataFrame:
    """Cosine top-k of groups by their best part: query_id, group, part, score, rank.

    A task keeps k groups per query however many parts a group has.  Rows
    without group, part or vector are left out.
    """
    rows = corpus.where(F.col(vec_col).isNotNull() & F.col(group).isNotNull() & F.col(part).isNotNull()).select(
        F.col(group).alias("doc_num"), F.col(part).alias("part"), vec_col)
    kind = {n: t.simpleString() for n, t in ((f.name, f.dataType) for f in rows.schema)}
    schema = (f"query_id {queries.schema['query_id'].dataType.simpleString()}, doc_num {kind['doc_num']}, part {kind['part']}, score double")
    hits = _by_block(query_blocks(queries, query_vec), lambda q, m: rows.mapInArrow(_group_scorer(q, m, k), schema))
    if hits is None:
        hits = corpus.sparkSession.createDataFrame([], schema)
    best = hits.groupBy("query_id", "doc_num").agg(F.max("score").alias("score"), F.min(F.struct((-F.col("score")).alias("loss"), "part")).alias("b"))
    return rank_hits(best.select("query_id", F.col("doc_num").alias(group), F.col("b.part").alias(part), "score"), k, doc=group)


def fit_cells(corpus: DataFrame, cells: int, vec_col: str = "embedding", seed: int = 7) -> np.ndarray:
    """Cell centres from a distributed k-means over at most some FIT_ROWS of the corpus vectors, chosen by hash."""
    rows = corpus.where(F.col(vec_col).isNotNull())
    share = FIT_ROWS / max(1, rows.count())
    if share < 1:
        rows = rows.where(F.pmod(F.xxhash64(F.lit(seed), vec_col), F.lit(1 << 30)) < int(share * (1 << 30)))
    unit = rows.select(array_to_vector(F.col(vec_col).cast("array<double>")).alias("features"))
    model = KMeans(k=cells, seed=seed, maxIter=10, distanceMeasure="cosine").fit(unit)
    return _unit(np.array(model.clusterCenters()))


@dataclass
class CellIndex:
    """Vectors written in one folder per cell, and how many cells a query reads."""

    rows: DataFrame          # id, vector, cell; partitioned by cell
    centroids: np.ndarray
    probes: int
    curve: list[float]       # recall on the calibration vectors after 1, 2, ... cells

    def read(self, cells) -> DataFrame:
        """Rows of some cells; the other folders are not opened."""
        return self.rows.where(F.col("cell").isin([int(c) for c in cells]))


def _assigned(corpus: DataFrame, id_col: str, vec_col: str, centroids: np.ndarray) -> DataFrame:
    kind, vec = corpus.schema[id_col].dataType.simpleString(), corpus.schema[vec_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            cell = np.argmax(_unit(_matrix(b.column(1))) @ centroids.T, axis=1) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell.astype(np.int32))], names=["doc_num", "v", "cell"])

    rows = corpus.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("doc_num"), F.col(vec_col).alias("v"))
    return rows.mapInArrow(run, f"doc_num {kind}, v {vec}, cell int")


def recall_curve(rows: DataFrame, centroids: np.ndarray, k: int) -> list[float]:
    """Recall at ``k`` after each number of probed cells, over CALIBRATE of the
    indexed vectors (by hash), each without itself: one exact search gives the
    cells of the true neighbours, and their places give every number at once."""
    sample = materialize(rows.orderBy(F.xxhash64(F.lit(3), "doc_num"), "doc_num").limit(CALIBRATE).select(F.col("doc_num").alias("query_id"), F.col("v").alias("query_vector")), "calibrate")
    hits = exact_topk(rows, sample, k + 1, vec_col="v").where(F.col("query_id") != F.col("doc_num"))
    cells = hits.select("query_id", "doc_num").join(rows.select("doc_num", "cell"), "doc_num").select("query_id", "cell").collect()   # CALIBRATE * (k + 1) rows
    if not cells:
        return [1.0] * len(centroids)
    asked = {r[0]: r[1] for r in sample.collect()}
    place = {q: {int(c): i for i, c in enumerate(_nearest_cells(_unit(np.array([v], float)), centroids, len(centroids))[0])} for q, v in asked.items()}
    counts = np.bincount([place[q][c] for q, c in cells], minlength=len(centroids))
    return (np.cumsum(counts) / len(cells)).tolist()


def build_index(corpus: DataFrame, k: int = 10, cells: int | None = None, goal: float = GOAL,
                id_col: str = "doc_num", vec_col: str = "embedding") -> CellIndex:
    """Index of every non-null vector.

    The number of cells grows with the square root of the corpus, so the rows
    of a cell grow no faster.  The probes are the fewest that reach ``goal``
    on the calibration vectors; they follow the data, not a constant.
    """
    spark = corpus.sparkSession
    centroids = fit_cells(corpus, cells or max(16, math.isqrt(corpus.count()) // 4), vec_col)
    path = scratch(spark, "cells")
    placed = _assigned(corpus, id_col, vec_col, centroids)
    placed.hint("rebalance", "cell").write.partitionBy("cell").parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    curve = recall_curve(rows, centroids, k)
    return CellIndex(rows, centroids, next(i for i, r in enumerate(curve, 1) if r >= min(goal, curve[-1])), curve)


def search_index(index: CellIndex, queries: DataFrame, k: int, probes: int | None = None, query_vec: str = "query_vector") -> DataFrame:
    """Top-k over the cells nearest each query, scored exactly; only the
    folders that some query of a block probes are read."""
    n = min(probes or index.probes, len(index.centroids))
    schema = (f"query_id {queries.schema['query_id'].dataType.simpleString()}, "
              f"doc_num {index.rows.schema['doc_num'].dataType.simpleString()}, score double")
    def hits_of(q, m):
        cells = index.read(np.unique(_nearest_cells(m, index.centroids, n)))
        return cells.select("doc_num", "v", "cell").mapInArrow(_scorer(q, m, k, index.centroids, n), schema)

    hits = _by_block(query_blocks(queries, query_vec), hits_of)
    return index.rows.sparkSession.createDataFrame([], schema + ", rank int") if hits is None else rank_hits(hits, k)


def approx_topk(corpus: DataFrame, queries: DataFrame, k: int, cells: int | None = None, probes: int | None = None,
                id_col: str = "doc_num", vec_col: str = "embedding",
                query_vec: str = "query_vector", centroids: np.ndarray | None = None) -> DataFrame:
    """Top-k over the cells nearest each query, scored exactly.

    More probes, more recall; probing every cell equals ``exact_topk``.
    Without ``probes`` an index is built whose probes reach GOAL; with
    ``probes`` and ``centroids`` the corpus is searched in place.
    """
    if centroids is not None:
        return _search(corpus, queries, k, id_col, vec_col, query_vec, centroids, min(probes or len(centroids), len(centroids)))
    return search_index(build_index(corpus, k, cells, id_col=id_col, vec_col=vec_col), queries, k, probes, query_vec)


def check_recall(report: DataFrame, floor: float = FLOOR) -> DataFrame:
    """The report of ``recall``, or an error if the mean is below ``floor``."""
    report = materialize(report, "recall")
    mean = report.agg(F.avg("recall")).first()[0]
    if mean is not None and mean < floor:
        raise ValueError(f"recall {mean:.3f} is below {floor}")
    return report


def recall(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Per query: share of the exact hits that the other list also found."""
    found = approx.select("query_id", "doc_num", F.lit(1).alias("hit"))
    return (exact.join(found, ["query_id", "doc_num"], "left").groupBy("query_id")
            .agg(F.count("*").alias("k"), F.count("hit").alias("matched"),
                 F.round(F.count("hit") / F.count("*"), 6).alias("recall")))
