"""Stages hand every column on, whatever its name."""

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import corpus, frame
from tidings.llm import decontaminate, mixing, nearcopies, quality, sharding, simhash

NAMES = ("_row", "_doc", "_score", "_digest", "_key", "group", "label", "node", "score", "digest", "slot", "copies", "item_id", "a.b", "with `ticks`")


def stages(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, dict(corpus())[5][:400])], "item_id long, text string")
    return {"quality": lambda d: quality.keep_good(d, labels), "near": nearcopies.keep_one, "first": simhash.keep_first,
            "clean": lambda d: decontaminate.clean_rows(d, items), "mix": mixing.mix, "shard": sharding.sharded}


@pytest.mark.parametrize("name", ["quality", "near", "first", "clean", "mix", "shard"])
def test_names_of_columns_do_not_matter(spark, name):
    plain = frame(spark, corpus(30) + [(None, None), (None, "no id here"), (3, None)]).drop("shard")
    docs = plain
    for n in NAMES if name != "mix" else NAMES[:12]:
        docs = docs.withColumn(n, F.concat(F.lit(n + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    got = stages(spark)[name](docs)
    extra = ["shard"] if name == "shard" else []
    assert got.columns == docs.columns + extra
    rows = got.collect()
    assert rows and all(r[n] == f"{n}:{'-' if r.doc_id is None else r.doc_id}" for r in rows for n in docs.columns[len(plain.columns):])
    want = stages(spark)[name](plain)
    assert sorted((str(r.doc_id), str(r.text)) for r in rows) == sorted((str(r.doc_id), str(r.text)) for r in want.collect())
