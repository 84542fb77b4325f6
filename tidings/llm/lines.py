"""Line de-duplication.

Every line is normalised and hashed to 128 bits; the distinct documents of a
hash are counted, lines over the threshold are dropped except in one document,
and the texts are put together again by line position.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import ascii_lower
from tidings.session import materialize, small

SPACE = " \t\n\x0b\x0c\r"   # fixed value: what is stripped at both ends of a line
LENGTH = 20                 # code points from which a normalised line counts
DOCUMENTS = 3               # documents from which its lines are dropped
BROADCAST_LINES = 500_000   # dropped lines broadcast at most; beyond it the join shuffles


def key_of(line: Column) -> Column:
    """Stripped, A-Z lower-cased.  Lines of ASCII alone take the faster function, with the same result."""
    bare = F.btrim(line, F.lit(SPACE))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(ascii_lower(bare))


def lines(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """_row, doc_id, pos, line, h1, h2, counts: one row per line of every row, written once.

    A null or empty text is one empty line.  Lines that are too short to count
    get a hash of their own, so they meet no key and crowd no task.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cut = rows.select("_row", "doc_id", F.posexplode_outer(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = cut.withColumn("_key", key_of(F.col("line"))).withColumn("counts", F.char_length("_key") >= length)
    hashed = [F.when(F.col("counts"), F.xxhash64(F.lit(seed), "_key")).otherwise(F.xxhash64(F.lit(seed), "_row", "pos")).alias(f"h{seed}") for seed in (1, 2)]
    return materialize(keyed.select("_row", "doc_id", "pos", "line", *hashed, "counts"), "lines")


def common_lines(split: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """h1, h2, last: lines found in at least ``documents`` documents, and the largest doc_id with each.

    Rows with one doc_id are one document; so are all rows without, and they
    come before every other.  A (line, document) is one row before documents
    are counted, and both counts combine before their shuffle, so a line that
    every document holds is as cheap as any.
    """
    held = split.where("counts").groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
    found = held.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
    return materialize(found.where(F.col("n") >= documents).select("h1", "h2", "last"), "common")


def dedup(docs: DataFrame, length: int = LENGTH, documents: int = DOCUMENTS) -> DataFrame:
    """doc_id, text, n_lines, n_dropped of every row of ``docs``.

    Columns besides doc_id and text are not read.  Repeated rows are one
    document and lose or keep the same lines; a text that loses all its lines
    becomes empty.  A line of the largest doc_id stays as often as it is there.
    """
    split = lines(docs, length)
    common = small(common_lines(split, documents), BROADCAST_LINES)
    marked = split.join(common, ["h1", "h2"], "left").select(
        "_row", "doc_id", "pos", "line",
        (F.col("counts") & F.col("last").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("last"))).alias("drop"))
    kept = F.array_sort(F.collect_list(F.when(~F.col("drop"), F.struct("pos", "line"))))
    whole = marked.groupBy("_row").agg(F.first("doc_id").alias("doc_id"), kept.alias("kept"), F.count("*").alias("n_lines"),
                                       F.count_if("drop").alias("n_dropped"))
    return whole.select("doc_id", F.array_join("kept.line", "\n").alias("text"), "n_lines", "n_dropped")
