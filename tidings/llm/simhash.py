"""SimHash near-duplicates by a binary trie self-join.

Distinct fingerprints are the keys of a binary trie.  Pairs of nodes are
walked down together from (root, root), adding up the bits in which their
paths differ; a pair above the error budget is dropped with everything below
it.  The top of the walk is a distributed one: each round takes a few bits
off every pair of subtrees that is still too large for one task.  The rest
of the walk runs inside a task, on sorted arrays whose ranges are the nodes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import bare, keep_least, with_row
from tidings.llm.components import components
from tidings.session import materialize

SHINGLE, SEED, RADIUS = 3, 42, 2
SUBTREE = 65_536      # fingerprints a pair of subtrees may hold in one task
ROUND_BITS = 4        # bits a round takes off
FAN = 50_000          # node pairs a task walks down at once
DIRECT = 64           # pairs of node sizes whose product is below are compared directly


# --- fingerprints -----------------------------------------------------------------

def shingle_hashes(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """XXH64 of the word shingles of an A-Z lower-cased text, repeats included;
    of the whole sequence if it is shorter, none for no words."""
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    flat = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(flat, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    n = len(parts) - words + 1
    return np.fromiter((digest(flat[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[words - 1:].tolist(), strict=True)), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; 0 for none."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 15):    # bounded memory for long texts
        part = hashes[i:i + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every whole text."""
    def run(batches):
        for pdf in batches:
            codes = np.array([majority(shingle_hashes(t)) for t in pdf["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": codes.view(np.int64)})
    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, fp long")


# --- trie walk in one task -----------------------------------------------------------

def _middle(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """Where the ones of ``bit`` begin in each node (a range of equal higher bits)."""
    first = keys[lo]
    high = first >> np.uint64(bit + 1) << np.uint64(bit + 1) if bit < 63 else np.zeros_like(first)
    return np.clip(np.searchsorted(keys, high | (np.uint64(1) << np.uint64(bit))), lo, hi)


def _direct(a, b, lo, hi, lo2, hi2, budget, same):
    """Index pairs within budget of small nodes, compared one by one."""
    na, nb = hi - lo, hi2 - lo2
    size = na * nb
    at = np.repeat(np.arange(len(size)), size)
    step = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
    i, j = lo[at] + step // nb[at], lo2[at] + step % nb[at]
    near = np.bitwise_count(a[i] ^ b[j]) <= budget
    if same:
        near &= i < j
    return i[near], j[near]


def walk(a: np.ndarray, b: np.ndarray, same: bool, bit: int, radius: int = RADIUS):
    """Yield index pairs (i, j) with popcount(a[i] ^ b[j]) <= radius.

    ``a`` and ``b`` are sorted and distinct (unsigned); ``same`` marks one
    array against itself, then i < j.  The walk starts at ``bit``; whatever
    differs above it is counted first.
    """
    if not len(a) or not len(b):
        return
    above = int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(bit + 1))) if bit < 63 else 0
    stack = [(bit, *(np.array([v], np.int64) for v in (0, len(a), 0, len(b), above)))]
    while stack:
        bit, lo, hi, lo2, hi2, err = stack.pop()
        done = ((hi - lo) * (hi2 - lo2) <= DIRECT) | (bit < 0)
        if done.any():
            yield _direct(a, b, lo[done], hi[done], lo2[done], hi2[done], radius, same)
            lo, hi, lo2, hi2, err = (x[~done] for x in (lo, hi, lo2, hi2, err))
        if not len(lo):
            continue
        mid, mid2 = _middle(a, lo, hi, bit), _middle(b, lo2, hi2, bit)
        own = same & (lo == lo2)
        parts = []
        for l1, h1, l2, h2, e, keep in ((lo, mid, lo2, mid2, err, True), (mid, hi, mid2, hi2, err, True),
                                        (lo, mid, mid2, hi2, err + 1, True), (mid, hi, lo2, mid2, err + 1, ~own)):
            alive = (h1 > l1) & (h2 > l2) & (e <= radius) & keep
            parts.append([x[alive] for x in (l1, h1, l2, h2, e)])
        nodes = [np.concatenate(x) for x in zip(*parts, strict=True)]
        for i in range(0, len(nodes[0]), FAN):
            stack.append((bit - 1, *(x[i:i + FAN] for x in nodes)))


class Forest:
    """Union-find over indexes; a root is the smallest of its tree."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def _subtrees(radius: int, bits: int):
    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        """Each linked fingerprint of a subtree pair with the first of its group
        there, and links per fingerprint."""
        fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        first = pdf["first"].to_numpy(bool)
        same = bool((pdf["p"] == pdf["q"]).iloc[0])
        a = np.sort(fp[first])
        b = a if same else np.sort(fp[~first])
        keys = a if same else np.concatenate([a, b])
        forest, degree = Forest(len(keys)), np.zeros(len(keys), np.int64)
        for i, j in walk(a, b, same, 63 - bits, radius):
            j = j if same else j + len(a)
            degree += np.bincount(i, minlength=len(keys)) + np.bincount(j, minlength=len(keys))
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                forest.join(x, y)
        signed, linked = keys.view(np.int64), np.flatnonzero(degree)
        first = np.array([forest.root(i) for i in linked.tolist()], np.int64)
        return pd.DataFrame({"u": signed[linked], "v": signed[first] if len(linked) else signed[linked], "links": degree[linked]})
    return links


def trie_links(keys: DataFrame, radius: int = RADIUS) -> DataFrame:
    """u, v, links of a table of distinct fp (long): a linked fingerprint, the
    one that stands for its group in a subtree pair, and its links there (to
    be summed).  The pairs (u, v) connect what all links connect.

    A round sends each fingerprint to the subtree pairs its next bits allow
    within the budget left.  Pairs with one side empty, or of one fingerprint,
    are dropped; pairs small enough are walked in one task each.  Fingerprints
    within the radius of one are at most 2,081 of 64 bits, so a crowded
    subtree is deep, not wide, and splits on.
    """
    spark = keys.sparkSession
    live = keys.select("fp", F.lit(0).cast("long").alias("p"), F.lit(0).cast("long").alias("q"), F.lit(True).alias("first"), F.lit(0).alias("err"))
    depth, out = 0, []
    while True:
        pair = ["p", "q"]
        sizes = live.groupBy(*pair).agg(F.count_if("first").alias("a"), F.count_if(~F.col("first")).alias("b"))
        sizes = materialize(sizes.where(F.when(F.col("p") == F.col("q"), F.col("a") > 1).otherwise((F.col("a") > 0) & (F.col("b") > 0))), "sizes")
        big = (F.col("a") + F.col("b") > SUBTREE) if depth < 64 else F.lit(False)
        done = live.join(sizes.where(~big).select(*pair), pair).groupBy(*pair).applyInPandas(_subtrees(radius, depth), "u long, v long, links long")
        out.append(done)
        if sizes.where(big).limit(1).count() == 0:
            break
        live = materialize(_descend(live.join(sizes.where(big).select(*pair), pair), depth, ROUND_BITS, radius), "subtrees")
        depth += ROUND_BITS
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return materialize(found, "links")


def _descend(live: DataFrame, depth: int, bits: int, radius: int) -> DataFrame:
    """Each row at the child pairs it takes part in, ``bits`` further down."""
    size = 1 << bits
    child = F.shiftrightunsigned("fp", 64 - depth - bits).bitwiseAND(size - 1)
    flips = F.explode(F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(m.bit_count()).alias("c"))
                                for m in range(size) if m.bit_count() <= radius]))
    rows = live.withColumn("x", child).withColumn("f", flips).where(F.col("err") + F.col("f.c") <= radius)
    other = F.col("x").bitwiseXOR(F.col("f.m"))
    mine, theirs = F.when(F.col("first"), F.col("p")).otherwise(F.col("q")), F.when(F.col("first"), F.col("q")).otherwise(F.col("p"))
    a, b = mine * size + F.col("x"), theirs * size + other
    # of a node against itself the smaller child comes first; of two nodes the side stays
    first = F.when(F.col("p") == F.col("q"), F.col("x") <= other).otherwise(F.col("first"))
    return rows.select("fp", F.when(first, a).otherwise(b).alias("p"), F.when(first, b).otherwise(a).alias("q"), first.alias("first"),
                       (F.col("err") + F.col("f.c")).alias("err"))


# --- documents ------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, copies, links of every row.

    component_id is the smallest doc_id reached over links of fingerprints;
    copies counts rows with the same fingerprint, links the other
    fingerprints within the radius.  Texts without words have fingerprint 0
    and link like any other.  A null doc_id is never the smallest unless it
    is alone.
    """
    coded = materialize(fingerprints(docs), "fingerprints")
    classes = materialize(coded.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
    found = trie_links(classes.select("fp"), radius)
    label = components(found.select("u", "v"))
    links = found.groupBy(F.col("u").alias("fp")).agg(F.sum("links").alias("links"))
    labelled = materialize(
        classes.join(label.withColumnRenamed("node", "fp"), "fp", "left").join(links, "fp", "left")
        .select("fp", "rep", "copies", F.coalesce("label", "fp").alias("label"), F.coalesce("links", F.lit(0)).alias("links")), "labelled")
    least = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    whole = materialize(labelled.join(least, "label").select("fp", "component_id", "copies", "links"), "components")
    return coded.join(whole, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "copies", "links")


def keep_first(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of each near-duplicate component, with all its columns: that of
    the smallest doc_id; one without doc_id only if all are."""
    keyed = with_row(docs)
    found = near_duplicates(bare(keyed, "doc_id"), radius)
    return keep_least(keyed, found.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("group")))
