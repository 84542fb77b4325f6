"""Benchmark decontamination by SimHash windows.

Every text is cut into windows as long as a benchmark item.  A window's
SimHash of five-word shingles is looked up among those of the items of its
length: fingerprints are split into blocks, and each item is listed under
every value near its own in each block, so all fingerprints within the radius
are found (if no block were that near, the sum would exceed the radius).
Weighted shingle similarity decides.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.blocks import mix
from tidings.llm.common import bare, with_row
from tidings.session import materialize, small

SHINGLE, SIMILAR = 5, 0.8
BLOCKS, NEAR = 8, 2                       # 8 blocks of 8 bits, each listed at up to 2 errors
RADIUS = BLOCKS * (NEAR + 1) - 1          # guaranteed: 23 of 64 bits
ITEMS = 20_000                            # items sent to the tasks at once; more go in further passes
BROADCAST_IDS = 1_000_000

_WORD = re.compile(r"\w+")
_MASKS = [sum(1 << b for b in c) for k in range(NEAR + 1) for c in combinations(range(8), k)]


def codes(text: str | None, known: dict[str, int]) -> np.ndarray:
    """Word codes of a lower-cased text without punctuation."""
    words = _WORD.findall((text or "").lower())
    for w in words:
        if w not in known:
            known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "replace"))
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Code of the shingle starting at each word; of all words if fewer."""
    n = min(n, len(words))
    out = np.zeros(max(0, len(words) - n + 1) if n else 0, np.uint64)
    for i in range(n):
        out = mix(out, words[i:len(words) - n + 1 + i])
    return out


def simhash(rows: np.ndarray) -> np.ndarray:
    """Fingerprints of the shingle codes in each row of a matrix."""
    bits = np.unpackbits(np.ascontiguousarray(rows.astype(">u8")).view(np.uint8).reshape(*rows.shape, 8), axis=2)
    return np.packbits(bits.sum(axis=1, dtype=np.int32) * 2 > rows.shape[1], axis=1).view(">u8").astype(np.uint64).ravel()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two bags of shingle codes."""
    ka, ca = np.unique(a, return_counts=True)
    kb, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    both = np.minimum(ca[i], cb[j]).sum()
    return float(both / (len(a) + len(b) - both))


class Index:
    """Items by number of shingles, and their fingerprints by near block values."""

    def __init__(self, items: list[tuple[int, str]]):
        known: dict[str, int] = {}
        self.ids, self.bags = [], []
        for item, text in items:
            bag = shingles(codes(text, known))
            if len(bag):
                self.ids.append(item)
                self.bags.append(bag)
        self.fps = np.array([simhash(b[None, :])[0] for b in self.bags], np.uint64)
        self.table: dict[tuple[int, int, int], list[int]] = {}
        places: dict[int, set[tuple[int, int]]] = {}
        for k, bag in enumerate(self.bags):
            for block in range(BLOCKS):
                value = int(self.fps[k]) >> (8 * block) & 255
                for m in _MASKS:
                    self.table.setdefault((len(bag), block, value ^ m), []).append(k)
            for at, code in enumerate(bag.tolist()):
                places.setdefault(code, set()).add((len(bag), at))
        self.shingles = np.array(sorted(places), np.uint64)
        self.places = [sorted(places[c]) for c in self.shingles.tolist()]

    def windows(self, bag: np.ndarray) -> dict[int, np.ndarray]:
        """Window starts per window length (in shingles).

        A window without any item's shingle has similarity 0 to all and is
        left out; the others start where a shared shingle puts an item's
        start.  At least 0.8 of the shingles are shared, so the best aligned
        window of a near copy is among them.  A text a little shorter than an
        item is a window as a whole.
        """
        at = np.searchsorted(self.shingles, bag)
        at[at == len(self.shingles)] = 0
        hits = np.flatnonzero(self.shingles[at] == bag) if len(self.shingles) else np.zeros(0, int)
        starts: dict[int, set[int]] = {}
        for h in hits.tolist():
            for length, offset in self.places[at[h]]:
                s = min(max(0, h - offset), max(0, len(bag) - length))
                if len(bag) >= SIMILAR * length:
                    starts.setdefault(length, set()).add(s)
        return {n: np.array(sorted(s), np.int64) for n, s in starts.items()}

    def candidates(self, length: int, fp: int) -> list[int]:
        """Items of this length within the radius of a fingerprint."""
        found: set[int] = set()
        for block in range(BLOCKS):
            found.update(self.table.get((length, block, fp >> (8 * block) & 255), ()))
        return [k for k in sorted(found) if (int(self.fps[k]) ^ fp).bit_count() <= RADIUS]

    def find(self, text: str | None, known: dict[str, int]) -> list[tuple[int, float, int]]:
        """(item, similarity, start of the best window) of the items in a text."""
        bag = shingles(codes(text, known))
        best: dict[int, tuple[float, int]] = {}
        for length, starts in self.windows(bag).items():
            for i in range(0, len(starts), 4096):
                part = starts[i:i + 4096]
                rows = bag[part[:, None] + np.arange(min(length, len(bag)))]
                for s, row, fp in zip(part.tolist(), rows, simhash(rows).tolist(), strict=True):
                    for k in self.candidates(length, fp):
                        sim = similarity(row, self.bags[k])
                        if sim >= SIMILAR and sim > best.get(self.ids[k], (0.0, 0))[0]:
                            best[self.ids[k]] = (sim, s)
        return [(item, sim, s) for item, (sim, s) in sorted(best.items(), key=lambda b: (b[0] is None, b[0] or 0))]


def _search(index):
    def run(batches):
        for pdf in batches:
            known: dict[str, int] = {}
            rows = []
            for doc_id, text in zip(pdf["doc_id"].astype("Int64"), pdf["text"], strict=True):
                rows += [(doc_id, *hit) for hit in index.value.find(text, known)]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "similarity", "start"]).astype({"doc_id": "Int64", "item_id": "Int64"})
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, start: items found in texts, the best
    window each; start counts words without punctuation.  Rows that share a
    doc_id, and items that share an item_id or have none, count as one.

    Words are lower-cased; a text shorter than an item, down to 0.8 of its
    shingles, is compared as a whole.  An item of fewer than five words is one
    shingle of its own length and found only in texts as short.  Empty items and texts
    match nothing.  Items are sent to the tasks ITEMS at a time: each pass
    reads all texts, whatever their number.
    """
    spark = docs.sparkSession
    items = materialize(benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")), "items")
    n = items.count()
    passes = max(1, -(-n // ITEMS))
    found = None
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).orderBy("item_id", "text").collect()
        index = spark.sparkContext.broadcast(Index([(r[0], r[1]) for r in part]))
        hits = docs.select("doc_id", "text").mapInPandas(_search(index), "doc_id long, item_id long, similarity double, start long")
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("s"))).alias("b")).select(
        "doc_id", "item_id", F.col("b.similarity").alias("similarity"), (-F.col("b.s")).alias("start"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id has no item in any row, with all
    columns.  Rows without doc_id stay; ``clean_rows`` tests them as well."""
    dirty = materialize(contaminated(docs, benchmark).where(F.col("doc_id").isNotNull()).select("doc_id").distinct(), "dirty")
    return docs.join(small(dirty, BROADCAST_IDS), "doc_id", "left_anti").select(*docs.columns)


def clean_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, whatever their doc_id, with all columns."""
    keyed = with_row(docs)
    found = contaminated(bare(keyed, "doc_id"), benchmark)
    dirty = materialize(found.select(F.col("doc_id").alias("_row")).distinct(), "dirty")
    return keyed.join(small(dirty, BROADCAST_IDS), "_row", "left_anti").select("_doc.*")
