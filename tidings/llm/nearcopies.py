"""Near copies by SimHash and by similarity of five-word shingles.

Equal texts are one node.  Nodes whose SimHash fingerprints the binary trie
self-join links, directly or over others, share a bucket; so do nodes that
agree in a band of minima of hashed shingles, as most pairs of similarity 0.8
differ in more bits than the trie is walked for.  The exact Jaccard similarity
of the shingle sets decides about a pair.  Only groups are wanted, so a bucket whose nodes are
linked already is done: first its nodes are compared with its smallest; of what
is left, the sets of a bucket travel to one call, once per node, and all pairs
still in different groups are counted there.  A bucket too large for one call is
dealt as pairs of its parts, so every pair of it meets once.  A pair of similarity 0.8
shares no band with probability 3e-5; none of a bucket is left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import bare, keep_least, with_row
from tidings.llm.components import components
from tidings.llm.simhash import majority, shingle_hashes, trie_links
from tidings.session import materialize, small

SHINGLE, SEED = 5, 42
OF = (4, 5)                # similar from 4/5, compared in whole numbers
BANDS, ROWS = 20, 4        # a pair of similarity s shares a band with probability 1 - (1 - s^4)^20
SLICE = 256                # pairs a copy of a shingle set serves
BROADCAST_IDS = 1_000_000

CROWD = 8192               # nodes of a bucket in one call at most; of more, two parts of half as many
CALL = 4_000               # rows of buckets in one Python call
HOLDERS = 1 << 22          # nodes looked up at once as holders of shingles

_RNG = np.random.default_rng(SEED)
_FLIP = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_TIMES = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(shingle_hashes(text, SHINGLE))


def minima(hashes: np.ndarray) -> np.ndarray:
    """Least value of the upper halves of the hashes under each of the 80 permutations."""
    upper = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, ~np.uint32(0))
    for i in range(0, len(upper), 1 << 10):     # small parts stay in the cache, whatever the text's length
        part = (upper[None, i:i + (1 << 10)] ^ _FLIP[:, None]) * _TIMES[:, None]
        least = np.minimum(least, part.min(axis=1))
    return least


def _signed(batches):
    for pdf in batches:
        rows = []
        for row, doc_id, text in zip(pdf["_row"], pdf["doc_id"].astype("Int64"), pdf["text"], strict=True):
            flat = b" ".join((text or "").encode("utf-8", "replace").lower().split())
            own = shingle_set(text)
            low = minima(own)
            keys = [xxhash.xxh64_intdigest(low[b * ROWS:(b + 1) * ROWS].tobytes(), b) for b in range(BANDS)] if len(own) else []
            rows.append((row, doc_id, xxhash.xxh3_128_digest(flat), len(own), np.uint64(majority(own)).view(np.int64), np.array(keys, np.uint64).view(np.int64)))
        yield pd.DataFrame(rows, columns=["_row", "doc_id", "digest", "n", "fp", "keys"]).astype({"doc_id": "Int64"})


def _sets(batches):
    for pdf in batches:
        yield pd.DataFrame({"node": pdf["_row"], "own": [shingle_set(t).view(np.int64) for t in pdf["text"]]})


def _alike(pairs: DataFrame, keyed: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar, by exact count.

    The set of a node in very many pairs is copied for every SLICE of them.
    """
    nodes = materialize(pairs.select(F.col("a").alias("_row")).union(pairs.select("b")).distinct(), "nodes")
    own = materialize(keyed.select("_row", "text").join(small(nodes, BROADCAST_IDS), "_row", "left_semi")
                      .mapInPandas(_sets, "node long, own array<long>"), "sets")
    parts = materialize(pairs.groupBy("a").agg(F.ceil(F.count("*") / SLICE).alias("parts")), "parts")
    dealt = materialize(pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("slice")), "dealt")
    mine = own.select(F.col("node").alias("a"), F.col("own").alias("x")).join(dealt.select("a", "slice").distinct(), "a")
    both = dealt.join(own.select(F.col("node").alias("b"), F.col("own").alias("y")), "b").join(mine, ["a", "slice"])
    shared = both.select("a", "b", (F.size("x") + F.size("y")).alias("n"), F.size(F.array_intersect("x", "y")).alias("c"))
    return materialize(shared.where(F.col("c") * OF[1] >= (F.col("n") - F.col("c")) * OF[0]).select(F.col("a").alias("u"), F.col("b").alias("v")), "alike")


def _holders(own):
    """A function from a node of a bucket to the number of shingles it shares with each."""
    size = np.fromiter(map(len, own), np.int64, len(own))
    ends = np.concatenate([[0], np.cumsum(size)])
    _, at = np.unique(np.concatenate(own), return_inverse=True)
    holder = np.repeat(np.arange(len(own)), size)[np.argsort(at, kind="stable")]
    first = np.concatenate([[0], np.cumsum(np.bincount(at))])

    def shared(i):
        mine, total = at[ends[i]:ends[i + 1]], np.zeros(len(own), np.int64)
        low, many = first[mine], first[mine + 1] - first[mine]
        part = np.cumsum(many) // HOLDERS
        for p in np.unique(part):
            lo, m = low[part == p], many[part == p]
            total += np.bincount(holder[np.repeat(lo - np.cumsum(m) + m, m) + np.arange(m.sum())], minlength=len(own))
        return total

    return shared


def _links(node, n, label, side, own):
    """Similar pairs that join the groups of one bucket, by exact count; a pair
    in one group already is not counted.  With two sides only pairs of both are asked for."""
    found, group, shared = [], label.copy(), _holders(own)
    whole = (side == side[0]).all()
    for i in range(len(node) - 1):
        rest = slice(i + 1, None)
        asked = (group[rest] != group[i]) & (np.minimum(n[i], n[rest]) * OF[1] >= np.maximum(n[i], n[rest]) * OF[0]) & (whole | (side[rest] != side[i]))
        if not asked.any():
            continue
        both = shared(i)[rest]
        for j in np.flatnonzero(asked & (both * OF[1] >= (n[i] + n[rest] - both) * OF[0])) + i + 1:
            if group[j] != group[i]:
                found.append((node[i], node[j]))
                group[group == group[j]] = group[i]
    return found


def _linked(pdf):
    """Links of many buckets."""
    pdf = pdf.sort_values(["bucket", "node"])
    node, n, label, side = (pdf[c].to_numpy(np.int64) for c in ("node", "n", "label", "side"))
    own = pdf["own"].to_numpy()
    ends = np.unique([0, *np.flatnonzero(np.diff(pdf["bucket"].to_numpy(np.int64))) + 1, len(pdf)])
    pairs = {p for a, b in zip(ends[:-1], ends[1:], strict=True) for p in _links(node[a:b], n[a:b], label[a:b], side[a:b], own[a:b])}
    return pd.DataFrame(sorted(pairs), columns=["u", "v"]).astype("int64")


def _parted(asked: DataFrame) -> DataFrame:
    """bucket, node, n, side with every bucket of more than CROWD nodes replaced
    by buckets for each two of its parts, sides 0 and 1, and for each part.

    All pairs of a bucket meet, however large it is; a node comes once for
    each part, so a call stays as small as CROWD."""
    big = materialize(asked.groupBy("bucket").agg(F.ceil(F.count("*") / (CROWD // 2)).cast("int").alias("parts")).where(F.col("parts") > 2), "big")
    if not big.limit(1).count():
        return asked.withColumn("side", F.lit(0))
    own, other = F.pmod(F.xxhash64("node"), "parts"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = asked.join(small(big, BROADCAST_IDS), "bucket").withColumn("own", own).withColumn("other", other)
    parts = dealt.select(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"), "node", "n", (F.col("own") > F.col("other")).cast("int").alias("side"))
    return materialize(asked.join(small(big, BROADCAST_IDS), "bucket", "left_anti").withColumn("side", F.lit(0)).unionByName(parts), "parted")


def trie_buckets(texts: DataFrame) -> DataFrame:
    """node, n, bucket of (node, n, fp): one bucket for each group of
    fingerprints linked by the trie self-join, for all texts with words."""
    own = materialize(texts.where("n > 0"), "coded")
    label = materialize(components(trie_links(own.select("fp").distinct()).select("u", "v")), "linked")
    return own.join(label.withColumnRenamed("node", "fp"), "fp", "left").select("node", "n", F.xxhash64(F.lit("trie"), F.coalesce("label", "fp")).alias("bucket"))


def groups(keyed: DataFrame) -> DataFrame:
    """_row, group of every row of (_row, doc_id, text): rows of one group are
    linked by pairs of similarity 0.8 or more.  Texts without words are copies
    of each other."""
    coded = materialize(keyed.select("_row", "doc_id", "text").mapInPandas(
        _signed, "_row long, doc_id long, digest binary, n long, fp long, keys array<long>"), "signed")
    least = materialize(coded.groupBy("digest").agg(F.min("_row").alias("node")), "texts")
    texts = coded.join(least.select(F.col("node").alias("_row")), "_row", "left_semi").withColumnRenamed("_row", "node")
    placed = materialize(texts.select("node", "n", F.explode("keys").alias("bucket")).unionByName(trie_buckets(texts.select("node", "n", "fp"))), "placed")
    crowded = placed.groupBy("bucket").agg(F.count("*").alias("c"), F.min(F.struct("node", "n")).alias("lead")).where("c > 1")
    live = materialize(placed.join(materialize(crowded.select("bucket", "lead"), "crowded"), "bucket"), "live")

    fits = F.least("n", "lead.n") * OF[1] >= F.greatest("n", "lead.n") * OF[0]
    stars = materialize(live.where((F.col("node") != F.col("lead.node")) & fits).select(F.col("lead.node").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    edges = _alike(stars, keyed)
    label = materialize(components(edges), "label")
    grouped = live.select("bucket", "node", "n").join(label, "node", "left").select("bucket", "node", "n", F.coalesce("label", "node").alias("label"))
    mixed = grouped.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("bucket")
    open_ = _parted(materialize(live.select("bucket", "node", "n").join(materialize(mixed, "mixed"), "bucket"), "open"))
    named = materialize(open_.select(F.col("node").alias("_row")).distinct(), "asked")
    sets = materialize(keyed.select("_row", "text").join(small(named, BROADCAST_IDS), "_row", "left_semi")
                       .mapInPandas(_sets, "node long, own array<long>").join(label, "node", "left"), "sets")
    calls = max(1, -(-open_.count() // CALL))
    dealt = open_.withColumn("call", F.pmod(F.xxhash64("bucket"), F.lit(calls)))
    whole = dealt.join(sets, "node").select("call", "bucket", "node", "n", "side", F.coalesce("label", "node").alias("label"), "own")
    edges = edges.union(materialize(whole.groupBy("call").applyInPandas(_linked, "u long, v long"), "links"))
    label = materialize(components(edges), "label")
    named = materialize(least.join(label, "node", "left").select("digest", F.coalesce("label", "node").alias("group")), "named")
    return coded.select("_row", "digest").join(named, "digest").select("_row", "group")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies, with all its columns: that of the
    smallest doc_id; one without doc_id only if all are."""
    keyed = with_row(docs)
    return keep_least(keyed, groups(bare(keyed)))
