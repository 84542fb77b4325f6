"""Quality scores, the source mixture, shards and the pipeline."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import corpus, frame, table_dir, vocabulary
from tidings.llm import mixing, quality, queries, sharding


# --- quality ----------------------------------------------------------------------

def labelled_docs(n=900):
    rng, words = random.Random(8), vocabulary(300)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = " ".join(rng.choice(words) for _ in range(rng.randint(20, 120)))
        text = text.capitalize() + "." if good else rng.choice([text.upper() + "!!!", "| ".join(text.split()), "%%% " + text.replace("e", "3#")])
        docs.append((i, text))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = labelled_docs()
    truth = {i: q for i, q, _ in labels}
    got = quality.classify(frame(spark, docs + [(9000, None), (9001, ""), (9002, "z " * 30_000)]),
                           spark.createDataFrame(labels + [(0, None, None), (77777, 1, 1)], "doc_id long, quality int, toxic int")).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.doc_id in truth]
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in held]) > 0.95
    assert len(got) == len(docs) + 3 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = labelled_docs(300)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in labels]
    a, b = (sorted((r.doc_id, r.score) for r in quality.classify(frame(spark, docs), spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect())
            for x in (labels, flipped))
    assert [i for i, _ in a] == [i for i, _ in b] and np.allclose([s for _, s in a], [s for _, s in b])


def test_all_labelled_rows_are_learnt_from(spark, monkeypatch):
    monkeypatch.setattr(quality, "fit", lambda rows: rows.count())
    ids = spark.range(600_000).withColumnRenamed("id", "doc_id")
    labels = ids.withColumn("quality", F.lit(1))
    learnt = quality.learn(ids.withColumn("stats", F.array(F.lit(0.0))), labels)
    assert learnt == ids.where(quality.remainder(F.col("doc_id"), 4) != 2).count() > 400_000


def test_nothing_to_learn_from(spark):
    docs, none = frame(spark, corpus(10)), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(r.score, r.predicted) for r in quality.classify(docs, none).collect()} == {(0.5, 0)}
    assert quality.keep_good(docs, none).count() == docs.count()
    assert quality.classify(docs.limit(0), none).count() == 0
    one = spark.createDataFrame([(i, 1, 0) for i, _ in corpus(10)], "doc_id long, quality int, toxic int")
    assert quality.keep_good(docs, one).count() == docs.count()


def test_keep_good_keeps_columns_and_clean_rows(spark):
    docs, labels = labelled_docs()
    df = frame(spark, docs + [(None, "Some plain words.")])
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = quality.keep_good(df, lab)
    truth = {i: q for i, q, _ in labels}
    ids = {r.doc_id for r in kept.collect()}
    assert kept.schema == df.schema
    assert np.mean([i in ids for i in truth if truth[i]]) > 0.95 and np.mean([i in ids for i in truth if not truth[i]]) < 0.1


def test_monotone():
    got = quality.monotone(np.array([0, 3, 1, 0, 4.0]), np.array([2, 4, 4, 0, 4.0]))
    assert np.allclose(got, [0, 0.5, 0.5, 0.75, 1.0]) and np.allclose(quality.monotone(np.zeros(3), np.zeros(3)), 0.5)


# --- mixture --------------------------------------------------------------------------

def filled(sizes, weights=(5, 2, 1), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    full, budget = set(), share * sum(sizes.values())
    while True:
        free = sum(w[s] for s in order if s not in full)
        level = (budget - sum(most * sizes[s] for s in full)) / free if free else 0
        more = {s for s in order if s not in full and most * sizes[s] <= level * w[s]}
        if not more:
            return {s: most * sizes[s] if s in full else level * w[s] for s in order}
        full |= more


def test_mixture(spark):
    rows = corpus()
    df = frame(spark, rows)
    sizes = mixing.sized(df)
    targets = mixing.source_targets(sizes)
    per = {r.source: r.s for r in sizes.groupBy("source").agg(F.sum("size").alias("s")).collect()}
    want = filled(per)
    got = {r.source: r.target for r in targets.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    drawn = mixing.copies(sizes, targets).collect()
    assert len(drawn) == len(rows) and all(0 <= r.copies <= 2 for r in drawn)
    for r in drawn:
        rate = want[r.source] / per[r.source] if per[r.source] else 0
        assert int(rate) <= r.copies <= int(rate) + 1
    again = mixing.copies(sizes.repartition(3), targets).collect()
    assert sorted(map(str, again)) == sorted(map(str, drawn))
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies for r in drawn)
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixture_comes_near_its_targets(spark):
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 6).cast("string")).alias("source"),
                                    (F.col("id") % 90 + 10).alias("size"))
    got = mixing.copies(df, mixing.source_targets(df)).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("target").alias("target"))
    assert all(abs(r.taken / r.target - 1) < 0.05 for r in got.collect())


def test_mixture_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(queries.ORACLES["op8_mixing"]).fetchall())
    got = sorted(tuple(r[c] for c in ("doc_id", "size", "source_size", "target", "taken")) for r in queries.QUERIES["op8_mixing"](spark, sf).collect())
    assert got == want


# --- shards ---------------------------------------------------------------------------

def test_best_fit_takes_the_tightest_bin():
    rng = random.Random(2)
    sizes = sorted((rng.randint(1, 60) for _ in range(400)), reverse=True)
    bins, rooms = [], []
    for s in sizes:
        fit = [(r, i) for i, r in enumerate(rooms) if r >= s]
        if not fit:
            rooms.append(100)
            fit = [(100, len(rooms) - 1)]
        i = min(fit)[1]
        rooms[i] -= s
        bins.append(i)
    assert sharding.best_fit(sizes, 100) == bins
    assert sharding.best_fit([150, 40, 40], 100) == [0, 1, 1] and sharding.best_fit([], 10) == []
    assert max(sharding.even_fit(sizes, 16)) == 15 and sharding.even_fit([5], 16) == [0]


def test_shards(spark):
    rows = corpus() + corpus(6)[:5]
    got = sharding.shard(frame(spark, rows), 4).collect()
    assert len(got) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t or "")
    where, slots, total = {}, {}, {}
    for r in got:
        t = texts[r.doc_id][0]
        assert (r.size, r.text_crc32) == (len(t.encode()) + 1, zlib.crc32(t.encode()))
        assert where.setdefault(t, r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
        total[r.shard] = total.get(r.shard, 0) + r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard(frame(spark, []), 4).count() == 0
    assert {r.shard for r in sharding.shard(frame(spark, rows), capacity=50_000).collect()} != {0}


def test_shards_of_many_texts_are_even(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.col("id").cast("string"), F.lit(" ")), (F.col("id") % 37 + 1).cast("int")).alias("text"))
    n = [r[0] for r in sharding.shard(df).groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(n) == 16 and max(n) / min(n) < 1.02


# --- pipeline --------------------------------------------------------------------------

def test_pipeline(spark, tmp_path):
    docs, labels = labelled_docs(400)
    item = " ".join(f"word{i}" for i in range(40))
    clean = [i for i, q, _ in labels if q]
    docs += [(5000, dict(docs)[clean[0]]), (5001, dict(docs)[clean[1]][:-1] + " " + item + ".")]
    df = frame(spark, docs)
    sf = table_dir(spark, tmp_path, documents=df, labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
                   benchmark=spark.createDataFrame([(1, item)], "item_id long, text string"))
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == [c for c in df.columns if c != "shard"] + ["shard"]
    rows = out.collect()
    ids = {r.doc_id for r in rows}
    assert 5000 not in ids and 5001 not in ids
    seen = {}
    for r in rows:
        assert seen.setdefault(r.text, (r.doc_id, r.shard)) == (r.doc_id, r.shard) and r.text == dict(docs)[r.doc_id]
    stages = df
    for _, stage in corpus_pipeline.STAGES[:3]:
        stages = stage(spark, stages, sf)
        assert stages.columns == df.columns
    assert ids <= {r.doc_id for r in stages.collect()}
    assert np.mean([i in {r.doc_id for r in stages.collect()} for i in clean]) > 0.9
