"""Sharding by best-fit-decreasing bin packing.

Groups of equal texts are indivisible.  Packing all of them in one task would
not scale, so cells of groups are packed first into parcels a small fraction
of a shard wide, and the parcels (a bounded number) into shards.  Both steps
are the same procedure: items by falling size enter the bin with the least
room that still holds them, found in a balanced tree over the rooms.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import numbered, packed
from tidings.session import materialize

SHARDS = 16
PARCELS = 128              # parcels of full width per shard
CELL_GROUPS = 50_000       # groups per cell until there are CELLS of them
CELLS = 1024


class Rooms:
    """Ordered set of (room, bin) keys as a treap: balanced in expectation."""

    def __init__(self):
        self.root, self.rng = None, random.Random(7)

    def _split(self, node, key):
        """Subtrees of keys below ``key`` and of the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, key) -> None:
        left, right = self._split(self.root, key)
        self.root = self._merge(self._merge(left, [key, self.rng.random(), None, None]), right)

    def take(self, size: int):
        """Remove and return the key with the least room of at least ``size``."""
        left, right = self._split(self.root, (size, -1))
        if right is None:
            self.root = left
            return None
        node = right
        while node[2] is not None:
            node = node[2]
        _, right = self._split(right, (node[0][0], node[0][1] + 1))
        self.root = self._merge(left, right)
        return node[0]


def best_fit(sizes: Sequence[int], capacity: int) -> list[int]:
    """Bin of each item; ``sizes`` must fall.  An item above ``capacity`` has a bin of its own."""
    rooms, bins, n = Rooms(), [], 0
    for size in sizes:
        found = rooms.take(size)
        room, at = found if found else (max(capacity, size), n)
        n += found is None
        rooms.add((room - size, at))
        bins.append(at)
    return bins


def even_fit(sizes: Sequence[int], shards: int) -> list[int]:
    """Best fit into at most ``shards`` bins of the least capacity found by halving."""
    total = sum(sizes)
    low = max([-(-total // shards), *sizes[:1]])
    high, found = low + max([1, *sizes[:1]]), None
    while found is None:
        bins = best_fit(sizes, high)
        found = bins if max(bins, default=0) < shards else None
        high += 0 if found else max(1, high // 8)
    while high - low > max(1, low >> 12):
        mid = (low + high) // 2
        bins = best_fit(sizes, mid)
        if max(bins, default=0) < shards:
            found, high = bins, mid
        else:
            low = mid
    return found


def _pack_cell(capacity: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "digest"], ascending=[False, True])
        return pdf.assign(parcel=best_fit(pdf["bytes"].tolist(), capacity))[["cell", "digest", "bytes", "parcel"]]
    return pack


def assign(rows: DataFrame, shards: int = SHARDS, capacity: int | None = None) -> DataFrame:
    """(digest, shard) of a table with digest and size: equal digests stay together.

    With ``capacity`` the number of shards is what best fit needs at that
    width (a wider group fills one alone); else it is ``shards`` and the width
    the least that suffices, so sizes come near equal.  All but one parcel of
    a cell are over half full, so at most 2 x PARCELS per shard and one per
    cell reach the driver, whatever the input.
    """
    spark = rows.sparkSession
    groups = materialize(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "groups")
    n, total = groups.agg(F.count("*"), F.sum("bytes")).first()
    total = total or 0
    width = max(1, -(-(capacity or -(-total // shards)) // PARCELS))
    cells = max(1, min(CELLS, -(-n // CELL_GROUPS)))
    packed = materialize(
        groups.withColumn("cell", F.pmod(F.xxhash64("digest"), F.lit(cells)).cast("int")).groupBy("cell")
        .applyInPandas(_pack_cell(width), "cell int, digest binary, bytes long, parcel int"), "packed")
    parcels = packed.groupBy("cell", "parcel").agg(F.sum("bytes").alias("bytes")).toPandas().sort_values(
        ["bytes", "cell", "parcel"], ascending=[False, True, True])
    sizes = parcels["bytes"].tolist()
    parcels["shard"] = best_fit(sizes, capacity) if capacity else even_fit(sizes, shards)
    # as Arrow, which needs no Python worker beside those that packed the cells
    placed = spark.createDataFrame(pa.Table.from_pandas(parcels[["cell", "parcel", "shard"]].astype("int32"), preserve_index=False))
    return packed.join(F.broadcast(placed), ["cell", "parcel"]).select("digest", "shard")


def shard(docs: DataFrame, shards: int = SHARDS, capacity: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row.

    size is the text's UTF-8 bytes plus 1; a null text counts as an empty one.
    Slots are gapless from 0 in each shard, by doc_id.  Repeated rows are in
    one group and get slots of their own.  Other columns are not read.
    """
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = materialize(docs.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
                                   F.unhex(F.md5(body)).alias("digest")), "sized")
    where = materialize(assign(rows, shards, capacity), "assigned")
    placed = rows.join(where, "digest").drop("digest")
    ranked = numbered(placed, [F.col("shard"), F.col("doc_id"), F.col("text_crc32")], "_rank")
    first = ranked.groupBy("shard").agg(F.min("_rank").alias("_first"))
    return (ranked.join(F.broadcast(first) if not capacity else first, "shard")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("_rank") - F.col("_first")).alias("slot")))


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with its shard; a column of that name is replaced."""
    rest = docs.drop("shard")
    digest = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    sizes = docs.select(digest.alias("digest"), (F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 1).cast("long").alias("size"))
    where = materialize(assign(sizes, shards), "assigned").select(F.col("digest").alias("_at"), "shard")
    return docs.select(packed(rest), digest.alias("_digest")).join(where, F.col("_digest") == F.col("_at")).select("_doc.*", "shard")
