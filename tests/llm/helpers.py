"""Small awkward tables that every operator must take."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     T.StructField("size", T.StringType()), T.StructField("shard", T.StringType())])


def vocabulary(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnoprstuvé") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def corpus(n=60, seed=3):
    """(doc_id, text) with copies, near copies, shared passages, nulls, empty and long texts."""
    rng, words = random.Random(seed), vocabulary(400)
    passage = [rng.choice(words) for _ in range(130)]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(1, 200))]
        if i % 4 == 1:
            cut = rng.randint(0, len(text))
            a = rng.randint(0, 40)
            text = text[:cut] + passage[a:a + rng.randint(40, 90)] + text[cut:]
        rows.append((i, " ".join(text) if i % 5 else "\n\t ".join(text).upper()))
        if i % 9 == 2:
            rows.append((i + 1000, rows[-1][1]))
        if i % 9 == 3:
            t = rows[-1][1].split()
            t[len(t) // 2] = "changed"
            rows.append((i + 2000, " ".join(t)))
    rows += [(5000, None), (5001, ""), (5002, " \n "), (5003, "one"), (5004, "one"), (5005, None), (5006, "x " * 40_000), (5007, "x " * 300)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    """documents with null columns and columns whose names operators use themselves."""
    full = [(i, t, None if i is None or i % 3 == 0 else "en", None if i is None or i % 7 == 0 else f"src{i % 4}", None, "?", "?") for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def table_dir(spark, tmp_path, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
