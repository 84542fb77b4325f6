"""What several operators of this package share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.session import materialize, small

# Fixed value: a word is a run of anything but space and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
BROADCAST_IDS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def numbered(df: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """Gapless numbers from 0 in the order of ``keys``, over all tasks.

    ``df`` should be narrow: it is dealt by ranges of the keys, sorted within
    each range and written once.  A range adds the number of rows before it,
    from a table with one row per range.  Rows with equal keys are numbered in
    any order.
    """
    ranged = materialize(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
              .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")))
    return (ranged.withColumn("_part", part).join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_start") + row).drop("_part", "_start", "_at"))


def chunk_count(n_bytes: int, at_least: int = 8) -> int:
    """How many parts texts of ``n_bytes`` are dealt into.

    Parts exchange packed blocks with as many buckets, so a part grows with
    the square root of the input (16 KB per block) from 1 up to 32 MB.
    """
    part = min(32 << 20, max(1 << 20, math.isqrt(max(1, n_bytes) * (16 << 10))))
    return max(at_least, -(-n_bytes // part))


def chunked(docs: DataFrame, *others: str) -> tuple[DataFrame, int]:
    """(doc_id, text and ``others`` with a ``chunk``, number of chunks).

    The chunk depends on doc_id alone, so it is the same in every pass.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = chunk_count(total)
    chunk = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(n)).cast("int")
    return docs.select(chunk.alias("chunk"), "doc_id", "text", *others), n


def packed(docs: DataFrame) -> Column:
    """All columns in one struct ``_doc``, so that no name of theirs meets a name of ours."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("_doc")


def with_row(docs: DataFrame) -> DataFrame:
    """_doc, _row: the packed rows, written once, each with a number of its own."""
    return materialize(docs.select(packed(docs), F.monotonically_increasing_id().alias("_row")), "keyed")


def bare(keyed: DataFrame, number: str = "_row") -> DataFrame:
    """The row number (as ``number``), doc_id if that is another column, and text of packed rows."""
    own = [] if number == "doc_id" else [F.col("_doc.doc_id").alias("doc_id")]
    return keyed.select(F.col("_row").alias(number), *own, F.col("_doc.text").alias("text"))


def keep_least(keyed: DataFrame, groups: DataFrame) -> DataFrame:
    """Exactly one row of packed rows for each group of (_row, group): that of
    the smallest doc_id, null last."""
    found = materialize(groups, "groups")
    named = found.join(bare(keyed).select("_row", "doc_id"), "_row")
    kept = materialize(named.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "_row"))["_row"].alias("_row")), "kept")
    gone = materialize(found.select("_row").join(kept.select("_row"), "_row", "left_anti"), "gone")
    return keyed.join(small(gone, BROADCAST_IDS), "_row", "left_anti").select("_doc.*")
