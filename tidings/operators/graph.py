"""Property graph as tables: merges by key and analyses by joins.

Shapes: documents(id, source, published_at, last_updated); entities(id,
labels, props, embedding, last_updated); edges(src, dst, type, props,
source_doc, last_updated).  A merge is a union with the existing table
followed by map-side-combined aggregates, so it is idempotent and a hot key
collapses in the tasks that read it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings import vocab
from tidings.functions import text
from tidings.operators.ingest import union_all
from tidings.session import materialize, small, within

HUB_EDGES = 100_000        # adjacency rows of one node handled by one task
BROADCAST_NODES = 500_000  # node rows broadcast at most: some 30 MB
BROADCAST_PAIRS = 2_000_000   # neighbours a task holds as whole numbers at most: some 100 MB with their names
LIST_ROWS = 200_000        # rows of lists a task hands on at once
BLOCK_PAIRS = 8_000_000    # pairs of neighbours a task holds as numbers: some 500 MB while it deals them out
SEEDS = 10                 # tried until no two nodes share a number


# --- merges --------------------------------------------------------------------

def latest_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Newest row per key; combines inside each task before shuffling."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*"))


def upsert_documents(existing: DataFrame, delta: DataFrame) -> DataFrame:
    return latest_per_key(existing.unionByName(delta), ["id"], "last_updated", "source")


def _merged_props(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Property maps merged key-wise, newest value first.

    Property names are a small fixed vocabulary, so the regrouped map of one
    key is bounded.
    """
    per_key = (rows.select(*keys, "last_updated", F.explode("props").alias("p", "v"))
               .groupBy(*keys, "p").agg(F.max_by("v", F.struct("last_updated", "v")).alias("v")))
    return per_key.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("p", "v")))).alias("props"))


EMPTY_PROPS = "cast(map() as map<string,string>)"


def upsert_entities(existing: DataFrame, delta: DataFrame) -> DataFrame:
    """Labels accumulate, properties merge, an embedding is kept once present."""
    rows = existing.unionByName(delta)
    has = F.when(F.col("embedding").isNotNull(), F.col("last_updated"))
    base = rows.groupBy("id").agg(F.max_by("embedding", has).alias("embedding"), F.max("last_updated").alias("last_updated"))
    # labels come from the fixed node vocabulary: the set is bounded
    labels = rows.select("id", F.explode("labels").alias("l")).groupBy("id").agg(F.array_sort(F.collect_set("l")).alias("labels"))
    return (base.join(labels, "id", "left").join(_merged_props(rows, ["id"]), "id", "left")
            .select("id", F.coalesce("labels", F.array().cast("array<string>")).alias("labels"),
                    F.coalesce("props", F.expr(EMPTY_PROPS)).alias("props"), "embedding", "last_updated"))


def mention_edges(pairs: DataFrame, documents: DataFrame, entities: DataFrame) -> DataFrame:
    """(doc_id, entity_id) once each, only where both ends exist."""
    return (pairs.select("doc_id", "entity_id").distinct()
            .join(documents.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
            .join(entities.select(F.col("id").alias("entity_id")), "entity_id", "left_semi"))


def upsert_relations(existing: DataFrame, delta: DataFrame, entities: DataFrame) -> DataFrame:
    """One edge per (src, dst, type) between existing nodes: properties merge,
    the last writer is the source document."""
    rows = existing.unionByName(delta)
    keys = ["src", "dst", "type"]
    base = rows.groupBy(*keys).agg(F.max_by("source_doc", F.struct("last_updated", "source_doc")).alias("source_doc"),
                                   F.max("last_updated").alias("last_updated"), F.count("*").alias("writes"))
    known = entities.select("id")
    ends = (base.join(known.withColumnRenamed("id", "src"), "src", "left_semi")
            .join(known.withColumnRenamed("id", "dst"), "dst", "left_semi"))
    return ends.join(_merged_props(rows, keys), keys, "left").withColumn("props", F.coalesce("props", F.expr(EMPTY_PROPS)))


def update_statistics(node_rows: DataFrame, edge_rows: DataFrame) -> DataFrame:
    """Upsert counters per mention, with the distinct counts beside them."""
    n = node_rows.agg(F.count("*").alias("nodes"), F.count("embedding").alias("vectors"), F.count_distinct("id").alias("distinct_nodes"))
    e = edge_rows.agg(F.count("*").alias("relations"), F.count_distinct("src", "dst", "type").alias("distinct_relations"))
    cols = ("nodes", "vectors", "distinct_nodes", "relations", "distinct_relations")
    return union_all(n, e).agg(*[F.max(c).alias(c) for c in cols])


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Stop the load when a key repeats; fetches one row at most."""
    if duplicate_keys(df, *keys).limit(1).count():
        raise ValueError(f"duplicate key {keys}")
    return df


# --- adjacency ---------------------------------------------------------------------

def undirected(edges: DataFrame) -> DataFrame:
    """Distinct (a, b) in both directions, without loops; one shuffle of the
    unordered pairs, which are then written out both ways."""
    pairs = edges.where("src <> dst").select(F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y")).distinct()
    return pairs.select(F.inline(F.array(F.struct(F.col("x").alias("a"), F.col("y").alias("b")),
                                         F.struct(F.col("y").alias("a"), F.col("x").alias("b")))))


def degree(edges: DataFrame) -> DataFrame:
    """Relations at each node, counting both ends."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return ends.groupBy("id").agg(F.count("*").alias("degree"))


def split_adjacency(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Adjacency (a, b, salt) and nodes (id, deg, salts) for iterative jobs.

    A hub's rows are dealt over ``salts`` slices of at most ``HUB_EDGES``, so
    no task of an iteration holds more than one slice of one node.  Only hubs
    are looked up, by broadcast while they are few; the adjacency is never
    shuffled by its skewed key.  Both tables live in the shared folder.
    """
    return split_pairs(materialize(undirected(edges), "pairs"))


def split_pairs(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``split_adjacency`` of written (a, b) rows; with weights (w) nodes carry their sum as ``k``."""
    sums = [F.sum("w").alias("k")] if "w" in pairs.columns else []
    deg = pairs.groupBy("a").agg(F.count("*").alias("deg"), *sums)
    nodes = materialize(deg.withColumn("salts", F.ceil(F.col("deg") / HUB_EDGES).cast("int")).withColumnRenamed("a", "id"), "nodes")
    hubs = nodes.where("salts > 1").select(F.col("id").alias("a"), "salts")
    if within(hubs, 0):
        return pairs.withColumn("salt", F.lit(0)), nodes
    slot = F.coalesce(F.pmod(F.xxhash64("b"), F.col("salts")), F.lit(0)).cast("int")
    return materialize(pairs.join(small(hubs, BROADCAST_NODES), "a", "left").withColumn("salt", slot).drop("salts"), "adjacency"), nodes


def _sliced(values: DataFrame) -> DataFrame:
    """Node values repeated for each slice of their node."""
    return values.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")


def _code(column, seed: int) -> Column:
    """A number for a node id; distinct nodes have distinct ones under the seed that ``_numbered`` found."""
    return F.xxhash64(F.lit(seed), column)


def _numbered(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written nodes (id, code, relations) of all edges but loops, and the edges' ends as codes (x, y).

    Ids enter one shuffle, summed up before it; two nodes of one code, as good
    as impossible, are found and lead to another seed.
    """
    ends = edges.where("src <> dst").select(F.array("src", "dst").alias("e"))
    counted = materialize(ends.select(F.explode("e").alias("id")).groupBy("id").agg(F.count("*").alias("relations")), "counted")
    for seed in range(SEEDS):
        nodes = counted.withColumn("code", _code("id", seed))
        if within(nodes.groupBy("code").agg(F.count("*").alias("n")).where("n > 1"), 0):
            return nodes, ends.select(_code(F.col("e")[0], seed).alias("x"), _code(F.col("e")[1], seed).alias("y"))
    raise RuntimeError("nodes share a code under every seed")


def _thinned(batches):
    """A hot pair's copies fall together before they are shuffled."""
    for b in batches:
        yield b.drop_duplicates()


def _owned(edges: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Nodes (id, code, relations), and every pair of neighbours at its end of
    fewer relations as (own, other), dealt by ``own`` over a number of blocks of some ``BLOCK_PAIRS``.

    A block then meets few different nodes besides its own, as most of its
    pairs lead to hubs, and no node owns more than about the root of all pairs.
    Only hubs are looked up: the nodes of many relations, as few as a
    broadcast takes.  A pair that comes several times stays in its block.
    """
    nodes, ends = _numbered(edges)
    rows, count = nodes.agg(F.sum("relations"), F.count("*")).first()
    floor = 4 * (rows or 0) / max(1, count)
    while not within(nodes.where(F.col("relations") > floor), BROADCAST_NODES):
        floor *= 2
    hubs = F.broadcast(nodes.where(F.col("relations") > floor).select("code", "relations"))
    for end in "xy":
        ends = ends.join(hubs.select(F.col("code").alias(end), F.col("relations").alias(f"{end}_relations")), end, "left")
    def weight(end):
        return F.struct(F.coalesce(f"{end}_relations", F.lit(0)), F.col(end))
    first = weight("x") < weight("y")
    pairs = ends.select(F.when(first, F.col("x")).otherwise(F.col("y")).alias("own"), F.when(first, F.col("y")).otherwise(F.col("x")).alias("other"))
    blocks = -(-(rows or 1) // (2 * BLOCK_PAIRS))
    return nodes, pairs.mapInPandas(_thinned, "own long, other long").repartitionById(blocks, F.pmod("own", F.lit(blocks)).cast("int")), blocks


def _block(batches) -> tuple[np.ndarray, ...]:
    """The different nodes a block's pairs lead to, its own nodes, and the pairs as places among both, by own node."""
    cols = [(b.column("own").to_numpy(), b.column("other").to_numpy()) for b in batches]
    if not cols:
        return (np.zeros(0, np.int64),) * 4
    others, j = np.unique(np.concatenate([c[1] for c in cols]), return_inverse=True)
    own, i = np.unique(np.concatenate([c[0] for c in cols]), return_inverse=True)
    pairs = np.unique(i * len(others) + j)
    return others, own, pairs // len(others), pairs % len(others)


def _seats(blocks: int):
    """One row (block, slot, code, ties, near) per node of a block, its own nodes with the slots of their neighbours."""
    def run(batches):
        others, own, i, j = _block(batches)
        if not len(own):
            return
        ties = np.bincount(i, minlength=len(own))
        ends = np.concatenate([[0], np.cumsum(ties)])
        for lo in range(0, len(others), LIST_ROWS):
            hi = min(len(others), lo + LIST_ROWS)
            yield seats(own, others, lo, lo, hi, np.bincount(j, minlength=len(others))[lo:hi], pa.nulls(hi - lo, pa.list_(pa.int32())))
        for lo in range(0, len(own), LIST_ROWS):
            hi = min(len(own), lo + LIST_ROWS)
            near = pa.ListArray.from_arrays(pa.array((ends[lo:hi + 1] - ends[lo]).astype(np.int32)), pa.array(j[ends[lo]:ends[hi]].astype(np.int32)))
            yield seats(own, own, len(others) + lo, lo, hi, ties[lo:hi], near)

    def seats(own, codes, slot, lo, hi, ties, near):
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(hi - lo, own[0] % blocks, np.int32)), pa.array(np.arange(slot, slot + hi - lo, dtype=np.int32)),
            pa.array(codes[lo:hi]), pa.array(ties.astype(np.int64)), near], names=["block", "slot", "code", "ties", "near"])

    return run


def _flow(lists: pa.Table, values: pa.Table) -> pa.Table:
    """What a block's pairs carry in both directions: a sum for each of its seats."""
    slot = values["slot"].to_numpy()
    code, share = np.empty(len(slot), np.int64), np.empty(len(slot))
    code[slot], share[slot] = values["code"].to_numpy(), values["share"].to_numpy()
    inflow = np.zeros(len(slot))
    for b in lists.to_batches(LIST_ROWS):
        own, near, ties = (x.to_numpy() for x in (b.column("slot"), b.column("near").flatten(), pc.list_value_length(b.column("near"))))
        inflow += np.bincount(near, weights=np.repeat(share[own], ties), minlength=len(slot))
        inflow[own] += np.add.reduceat(share[near], np.cumsum(ties) - ties)
    return pa.table({"code": code, "inflow": inflow})


def pagerank(edges: DataFrame, rounds: int = 5, damping: float = 0.85) -> DataFrame:
    """Fixed rounds of rank flow over the undirected graph.

    Pairs lie once, as lists in blocks.  A round brings each block one value
    for every node it holds, takes one sum for each back and writes the
    values, which cuts lineage.
    """
    nodes, pairs, blocks = _owned(edges)
    held = materialize(pairs.mapInArrow(_seats(blocks), "block int, slot int, code long, ties long, near array<int>"), "blocks")
    deg = held.groupBy("code").agg(F.sum("ties").alias("deg"))
    seats = materialize(held.select("block", "slot", "code").join(deg, "code"), "seats")
    lists = held.where("near IS NOT NULL").select("block", "slot", "near").groupBy("block")
    n = float(nodes.count())
    ranks = seats.withColumn("rank", F.lit(1.0 / n))
    for _ in range(rounds):
        values = ranks.select("block", "slot", "code", (F.col("rank") / F.col("deg")).alias("share"))
        flow = lists.cogroup(values.groupBy("block")).applyInArrow(_flow, "code long, inflow double").groupBy("code").agg(F.sum("inflow").alias("inflow"))
        ranks = materialize(seats.join(flow, "code").select(
            "block", "slot", "code", "deg", (F.lit((1 - damping) / n) + damping * F.col("inflow")).alias("rank")), "ranks")
    once = ranks.groupBy("code").agg(F.max("deg").alias("deg"), F.max("rank").alias("rank"))
    return nodes.join(once, "code").select("id", "deg", "rank")


def _stars(batches):
    """Edges (src, dst) that tie each connected part of a block's pairs to one of its nodes."""
    others, own, i, j = _block(batches)
    codes, at = np.unique(np.concatenate([others, own]), return_inverse=True)
    root, a, b = np.arange(len(codes)), at[len(others) + i], at[j]
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
    far = np.flatnonzero(root != np.arange(len(root)))
    for k in range(0, len(far), LIST_ROWS):
        part = far[k:k + LIST_ROWS]
        yield pa.RecordBatch.from_arrays([pa.array(codes[part]), pa.array(codes[root[part]])], names=["src", "dst"])


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Connected groups labelled by their smallest node id.

    Blocks of pairs, each in one task, first become one edge per node and
    block, which connect the same nodes.  Over these, labels spread to
    neighbours and then jump to the label of their label, so the rounds needed
    grow with the logarithm of the diameter at most.
    """
    nodes, pairs, _ = _owned(edges)
    label = _spread_labels(materialize(pairs.mapInArrow(_stars, "src long, dst long"), "stars"), max_rounds)
    members = materialize(nodes.select("id", F.col("code").alias("node")).join(label.withColumnRenamed("id", "node"), "node").select("id", F.col("label").alias("part")), "members")
    names = materialize(members.groupBy("part").agg(F.min("id").alias("label")), "names")
    return members.join(small(names, BROADCAST_NODES), "part").select("id", "label")


def _spread_labels(edges: DataFrame, max_rounds: int) -> DataFrame:
    """(id, label): the smallest node of each connected group.

    Stops when no label changed.  A label becomes hot only as labels become
    few; the jump table has one row per label in use and is then small enough
    to broadcast.
    """
    adj, nodes = split_adjacency(edges)
    labels = nodes.select("id", "salts", F.col("id").alias("label"))
    for _ in range(max_rounds):
        near = (adj.join(_sliced(labels.withColumnRenamed("id", "a")), ["a", "salt"])
                .groupBy(F.col("b").alias("id")).agg(F.min("label").alias("near")))
        spread = materialize(labels.join(near, "id").select("id", "salts", "label", F.least("label", "near").alias("next")), "spread")
        jumps = materialize(spread.select("next").distinct().join(
            spread.select(F.col("id").alias("next"), F.col("next").alias("up")), "next"), "jumps")
        moved = materialize(spread.join(small(jumps, BROADCAST_NODES), "next").select(
            "id", "salts", F.least("next", "up").alias("new"), (F.least("next", "up") != F.col("label")).alias("moved")), "labels")
        labels = moved.select("id", "salts", F.col("new").alias("label"))
        if within(moved.where("moved"), 0):
            return labels.select("id", "label")
    raise RuntimeError("components did not settle")


def _exact(n) -> Column:
    """A whole number whose products with another stay exact."""
    return (n if isinstance(n, Column) else F.lit(n)).cast("decimal(19,0)")


def weighted_pairs(edges: DataFrame) -> DataFrame:
    """(a, b, w) in both directions, without loops; w counts the relations between the two."""
    pairs = edges.where("src <> dst").groupBy(F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y")).agg(F.count("*").alias("w"))
    return pairs.select(F.inline(F.array(F.struct(F.col("x").alias("a"), F.col("y").alias("b"), "w"),
                                         F.struct(F.col("y").alias("a"), F.col("x").alias("b"), "w"))))


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """One row (groups, modularity) of a partition (id, label) of the nodes."""
    pairs = materialize(weighted_pairs(edges), "pairs")
    ends = (pairs.join(labels.withColumnRenamed("id", "a").withColumnRenamed("label", "la"), "a")
            .groupBy("la", "b").agg(F.sum("w").alias("w")).join(labels.withColumnRenamed("id", "b").withColumnRenamed("label", "lb"), "b"))
    groups = ends.groupBy("la").agg(F.sum("w").alias("total"), F.sum(F.when(F.col("la") == F.col("lb"), F.col("w")).otherwise(0)).alias("inner"))
    whole = F.sum("total").cast("double")
    squares = F.sum(_exact(F.col("total")) * _exact(F.col("total"))).cast("double")
    return groups.agg(F.count("*").alias("groups"), (F.sum("inner") / whole - squares / (whole * whole)).alias("modularity"))


def _settle(pairs: DataFrame, whole: int, moves: int) -> tuple[DataFrame, bool]:
    """(id, label) after the best of ``moves`` rounds, and whether any round improved on single nodes.

    In a round every node weighs the groups of its neighbours: the gain of a
    group is whole * w - k * total, with w the weight towards it, k the
    node's own sum and total the group's without it.  It wants the group of
    greatest gain; ties stay, then go to the smaller label.  All nodes moving
    at once would swap for ever, so each round moves the half whose hash has
    a low hexadecimal digit at the place of the round.
    """
    adj, nodes = split_pairs(pairs)
    labels = nodes.select("id", "salts", "k", F.col("id").alias("label"))
    best, top, improved = labels, None, False
    for turn in range(moves + 1):
        totals = labels.groupBy("label").agg(F.sum("k").alias("total"))
        flow = (adj.where("a <> b").join(_sliced(labels.select(F.col("id").alias("a"), "salts", "label")), ["a", "salt"])
                .select(F.col("b").alias("id"), "label", "w"))
        asked = flow.unionByName(labels.select("id", "label", F.lit(0).cast("long").alias("w"))).groupBy("id", "label").agg(F.sum("w").alias("w"))
        own = F.col("label") == F.col("own")
        rest = F.col("total") - F.when(own, F.col("k")).otherwise(0)
        gain = _exact(whole) * _exact(F.col("w")) - _exact(F.col("k")) * _exact(rest)
        wanted = (asked.join(totals, "label").join(labels.select("id", "k", F.col("label").alias("own")), "id")
                  .groupBy("id").agg(F.min(F.struct((-gain).alias("loss"), (~own).alias("away"), "label")).alias("to"),
                                     F.sum(F.when(own, F.col("w"))).alias("inner")))
        step = materialize(labels.join(wanted, "id").select("id", "salts", "k", "label", F.col("to.label").alias("to"), "inner"), "moves")
        sums = step.groupBy("label").agg(F.sum("k").alias("total"), F.sum("inner").alias("inner"), F.count(F.when(F.col("to") != F.col("label"), 1)).alias("moved"))
        inner, restless, squares = sums.agg(F.sum("inner"), F.sum("moved"), F.sum(_exact(F.col("total")) * _exact(F.col("total")))).first()
        quality = whole * inner - int(squares)
        if top is None or quality > top:
            best, top, improved = labels, quality, turn > 0
        if turn == moves or not restless:
            break
        goes = F.substring(F.md5("id"), turn + 1, 1) < "8"
        labels = step.select("id", "salts", "k", F.when(goes, F.col("to")).otherwise(F.col("label")).alias("label"))
    return best.select("id", "label"), improved


def communities(edges: DataFrame, moves: int = 6, levels: int = 3) -> DataFrame:
    """(id, label): groups of dense ties inside components, labelled by their smallest member.

    Rounds of moves by modularity gain, then every group becomes one node
    with its inner weight as a loop, and the rounds start again.  Sums are
    whole numbers, so the result is the same in any order of rows.  A level
    keeps its best round; the first that improves nothing ends the job.
    Adjacency is dealt over hub slices; adaptive execution broadcasts the
    sums of groups when they turn out small; the driver sees one quality a round.
    """
    if not 0 < moves <= 32:
        raise ValueError("a round reads one of 32 hash digits")
    pairs = materialize(weighted_pairs(edges), "pairs")
    whole = pairs.agg(F.sum("w")).first()[0]
    member = pairs.select(F.col("a").alias("id"), F.col("a").alias("label")).limit(0)
    for level in range(levels if whole else 0):
        labels, improved = _settle(pairs, whole, moves)
        up = small(labels.select(F.col("id").alias("label"), F.col("label").alias("up")), BROADCAST_NODES)
        member = labels if level == 0 else materialize(member.join(up, "label").select("id", F.col("up").alias("label")), "members")
        if not improved:
            break
        side = pairs.join(labels.select(F.col("id").alias("a"), F.col("label").alias("la")), "a").groupBy("la", "b").agg(F.sum("w").alias("w"))
        pairs = materialize(side.join(labels.select(F.col("id").alias("b"), F.col("label").alias("lb")), "b")
                            .groupBy(F.col("la").alias("a"), F.col("lb").alias("b")).agg(F.sum("w").alias("w")), "pairs")
    names = member.groupBy("label").agg(F.min("id").alias("name"))
    return member.join(names, "label").select("id", F.col("name").alias("label"))


def _towards(frontier: DataFrame, nodes: DataFrame) -> DataFrame:
    """Frontier rows (id, ...) as (a, salt, ...): a hub's once per slice of its adjacency."""
    hubs = small(nodes.where("salts > 1").select("id", "salts"), BROADCAST_NODES)
    return _sliced(frontier.join(hubs, "id", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))).withColumnRenamed("id", "a")


def neighbourhood(edges: DataFrame, seeds: DataFrame, hops: int = 2) -> DataFrame:
    """(seed, id, hop) for every node within ``hops`` of each seed."""
    adj, nodes = split_adjacency(edges)
    seen = frontier = materialize(seeds.select("seed", F.col("seed").alias("id"), F.lit(0).alias("hop")), "frontier")
    for h in range(1, hops + 1):
        reached = (_towards(frontier.select("seed", "id"), nodes).join(adj, ["a", "salt"])
                   .select("seed", F.col("b").alias("id")).distinct().join(seen, ["seed", "id"], "left_anti"))
        frontier = materialize(reached.withColumn("hop", F.lit(h)), "frontier")
        seen = seen.unionByName(frontier)
    return seen


def shortest_paths(edges: DataFrame, pairs: DataFrame, max_depth: int = 4) -> DataFrame:
    """Shortest path text per (src, dst) pair, up to ``max_depth`` edges.

    Breadth first from each source.  At every depth the frontier first meets
    the neighbours of the targets, a small table; only sources with a target
    still open expand further.  Each reached node keeps one path, the
    smallest by text, and is expanded once.
    """
    adj, nodes = split_adjacency(edges)
    pairs = materialize(pairs.select("src", "dst").distinct(), "wanted")
    doors = materialize(_towards(pairs.select("src", "dst", F.col("dst").alias("id")), nodes).join(adj, ["a", "salt"])
                        .select("src", "dst", F.col("b").alias("id")), "doors")
    frontier = materialize(pairs.select("src", F.col("src").alias("id"), F.col("src").alias("path")).distinct(), "frontier")
    seen = frontier.select("src", "id")
    found = materialize(pairs.where("src = dst").select("src", "dst", F.lit(0).alias("depth"), F.col("src").alias("path")), "found")
    for d in range(1, max_depth + 1):
        hit = (doors.join(frontier, ["src", "id"]).join(found, ["src", "dst"], "left_anti").groupBy("src", "dst")
               .agg(F.lit(d).alias("depth"), F.min(F.concat_ws(">", "path", "dst")).alias("path")))
        found = found.unionByName(materialize(hit, "found"))
        if d == max_depth:
            break
        open_src = pairs.join(found, ["src", "dst"], "left_anti").select("src").distinct()
        step = (_towards(frontier.join(open_src, "src", "left_semi"), nodes).join(adj, ["a", "salt"])
                .groupBy("src", F.col("b").alias("id")).agg(F.min(F.concat_ws(">", "path", "b")).alias("path"))
                .join(seen, ["src", "id"], "left_anti"))
        frontier = materialize(step, "frontier")
        seen = seen.unionByName(frontier.select("src", "id"))
    return pairs.join(found, ["src", "dst"], "left")


# --- lookups and measures -------------------------------------------------------------

def partners(edges: DataFrame, members: DataFrame, kind: str) -> DataFrame:
    """Distinct (id, partner) over relations of one type, either direction."""
    both = edges.where(F.col("type") == kind).select("src", "dst").distinct().select(F.inline(F.array(
        F.struct(F.col("src").alias("id"), F.col("dst").alias("partner")), F.struct(F.col("dst").alias("id"), F.col("src").alias("partner")))))
    return both.distinct().join(members.select("id"), "id", "left_semi")


def route(hits: DataFrame, mentions: DataFrame, limit: int = 20) -> DataFrame:
    """Ranked documents to the entities they mention, best supported first.

    The hits are few and written first, so the mentions are not shuffled to
    meet them.
    """
    top = materialize(hits.select("query_id", "doc_num", "rank"), "hits")
    support = (mentions.join(small(top, BROADCAST_NODES), "doc_num")
               .groupBy("query_id", "entity_id", "alias").agg(F.count("*").alias("hits"), F.min("rank").alias("best_rank")))
    w = Window.partitionBy("query_id").orderBy(F.desc("hits"), "best_rank", "alias")
    return support.withColumn("position", F.row_number().over(w)).where(F.col("position") <= limit)


def set_density(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Per group: relations among its members, capped relevance, density.

    ``members`` holds (grp, id).  A relation counts once per direction of an
    undirected match; density is distinct connected pairs over possible ones.
    """
    m = members.select("grp", "id")
    inside = (edges.select("src", "dst").where("src <> dst")
              .join(m.select(F.col("grp").alias("g1"), F.col("id").alias("src")), "src")
              .join(m.select(F.col("grp").alias("g1"), F.col("id").alias("dst")), ["g1", "dst"]))
    pair = F.struct(F.least("src", "dst"), F.greatest("src", "dst"))
    counted = (inside.groupBy(F.col("g1").alias("grp"), pair.alias("pair")).agg((2 * F.count("*")).alias("c"))
               .groupBy("grp").agg(F.sum("c").alias("connections"), F.count("*").alias("pairs")))
    size = m.groupBy("grp").agg(F.count("*").alias("size"))
    return size.join(counted, "grp", "left").select(
        "grp", "size", F.coalesce("connections", F.lit(0)).alias("connections"),
        network_relevance(F.coalesce("connections", F.lit(0))).alias("relevance"),
        density(F.coalesce("pairs", F.lit(0)), F.col("size")).alias("density"))


def network_relevance(connections: Column) -> Column:
    return F.least(connections / F.lit(10.0), F.lit(1.0))


def density(pairs: Column, size: Column) -> Column:
    return F.round(F.coalesce(F.try_divide(pairs * F.lit(2.0), (size * (size - 1)).cast("double")), F.lit(0.0)), 6)


def strength(edges: DataFrame) -> DataFrame:
    """Interactions and exact value sum per relation."""
    return edges.groupBy("src", "dst", "type").agg(
        F.count("*").alias("interactions"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"))


def team_view(edges: DataFrame, team: str) -> DataFrame:
    return edges.where(F.col("type").isin(*vocab.TEAM_RELATIONS[team]))


LIST_KINDS = {"PARTNERS_WITH": "partners", "COMPETES_WITH": "competitors", "USES": "supply", "DEVELOPS": "supply", "SUPPLIES": "supply",
              "EMPLOYS": "personnel", "LEADS": "personnel", "WORKS_FOR": "personnel"}
LISTS = sorted(set(LIST_KINDS.values()))


def _near(edges: DataFrame) -> DataFrame:
    """(kind, id, other): distinct neighbours by kind of list, written."""
    kinds = F.create_map(*[F.lit(x) for kv in LIST_KINDS.items() for x in kv])[F.col("type")]
    ends = edges.select(kinds.alias("kind"), "src", "dst").where(F.col("kind").isNotNull())
    near = (ends.select("kind", F.col("src").alias("id"), F.col("dst").alias("other"))
            .unionByName(ends.select("kind", F.col("dst").alias("id"), F.col("src").alias("other"))).distinct())
    return materialize(near, "near")


def _listed(ents: DataFrame, near: DataFrame) -> DataFrame:
    """(doc_num, kind, other): distinct neighbours of a document's entities by kind of list."""
    return ents.join(small(near, BROADCAST_NODES), "id").select("doc_num", "kind", "other").distinct()


def _places(values, names: pa.Array) -> np.ndarray:
    """Place of each value in ``names``, -1 for none."""
    return pc.fill_null(pc.index_in(values, value_set=names), -1).to_numpy().astype(np.int64)


class _Neighbours:
    """A fetched table (id, other, ...) as whole numbers, sorted by id: rows
    ``start[i]`` to ``start[i + 1]`` are those of name i."""

    def __init__(self, rows: pa.Table):
        rows = rows.filter(pc.is_valid(rows["id"]))
        self.names = pa.chunked_array([*rows["id"].chunks, *rows["other"].chunks], pa.string()).unique()
        at = _places(rows["id"].combine_chunks(), self.names)
        order = np.argsort(at, kind="stable")
        self.start = np.searchsorted(at[order], np.arange(len(self.names) + 1))
        self.other = _places(rows["other"].combine_chunks(), self.names)[order]
        self.rows = rows.drop_columns(["id", "other"]).take(order)

    def documents(self, b: pa.RecordBatch) -> Iterator[np.ndarray]:
        """Places of the entities of each document of a batch."""
        ids = b.column("ids")
        flat, ends = _places(ids.flatten(), self.names), np.cumsum(pc.list_value_length(ids).to_numpy())
        for first, end in zip(np.r_[0, ends][:-1], ends, strict=True):
            yield flat[first:end][flat[first:end] >= 0]


def _per_document(ents: DataFrame) -> DataFrame:
    return ents.groupBy("doc_num").agg(F.collect_list("id").alias("ids"))


def _marked(near: DataFrame):
    """Broadcast neighbours by kind, and a function from a batch of documents
    to (row of the document, numbers kind * names + other), each once."""
    table = near.toArrow()
    held = _Neighbours(table)
    kind = _places(held.rows["kind"].combine_chunks(), pa.array(LISTS))
    shared = near.sparkSession.sparkContext.broadcast((held, held.other + kind * len(held.names)))

    def run(b):
        held, target = shared.value
        seen = np.zeros(len(LISTS) * len(held.names), bool)
        for k, ids in enumerate(held.documents(b)):
            for i in ids:
                seen[target[held.start[i]:held.start[i + 1]]] = True
            found = np.flatnonzero(seen)
            seen[found] = False
            yield k, found

    return shared, run


def _lists_in_tasks(ents: DataFrame, near: DataFrame) -> DataFrame:
    """``_listed`` with the neighbours held by every task: a document marks
    what its entities lead to, so no row is made twice."""
    shared, marks = _marked(near)

    def rows(b, at, found):
        names = shared.value[0].names
        at, found = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (at, found))
        size = max(1, len(names))
        return pa.RecordBatch.from_arrays([b.column("doc_num").take(pa.array(at)), pa.array(LISTS).take(pa.array(found // size)), names.take(pa.array(found % size))],
                                          names=["doc_num", "kind", "other"])

    def run(batches):
        for b in batches:
            at, lists, n = [], [], 0
            for k, found in marks(b):
                at.append(np.full(len(found), k))
                lists.append(found)
                n += len(found)
                if n >= LIST_ROWS:
                    yield rows(b, at, lists)
                    at, lists, n = [], [], 0
            yield rows(b, at, lists)

    return _per_document(ents).mapInArrow(run, f"doc_num {ents.schema['doc_num'].dataType.simpleString()}, kind string, other string")


def _counts_in_tasks(ents: DataFrame, near: DataFrame) -> DataFrame:
    """doc_num and the length of each list, by the same marks."""
    shared, marks = _marked(near)

    def run(batches):
        for b in batches:
            size = max(1, len(shared.value[0].names))
            counts = np.array([np.bincount(found // size, minlength=len(LISTS)) for _, found in marks(b)], np.int64).reshape(-1, len(LISTS))
            yield pa.RecordBatch.from_arrays([b.column("doc_num"), *(pa.array(c) for c in counts.T)], names=["doc_num", *LISTS])

    return _per_document(ents).mapInArrow(run, f"doc_num {ents.schema['doc_num'].dataType.simpleString()}, " + ", ".join(f"{k} long" for k in LISTS))


def _inside_in_tasks(ents: DataFrame, oriented: DataFrame) -> DataFrame:
    """doc_num, connections, pairs: relations between two entities of one document, each from its one end."""
    held = _Neighbours(oriented.toArrow())
    shared = oriented.sparkSession.sparkContext.broadcast((held, held.rows["n"].to_numpy()))

    def run(batches):
        held, n = shared.value
        own = np.zeros(len(held.names), bool)
        for b in batches:
            sums = []
            for ids in held.documents(b):
                own[ids] = True
                total = pairs = 0
                for i in ids:
                    there = own[held.other[held.start[i]:held.start[i + 1]]]
                    total += int(n[held.start[i]:held.start[i + 1]][there].sum())
                    pairs += int(there.sum())
                own[ids] = False
                sums.append((2 * total, pairs))
            sums = np.array(sums, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column("doc_num"), pa.array(sums[:, 0]), pa.array(sums[:, 1])], names=["doc_num", "connections", "pairs"])

    return _per_document(ents).mapInArrow(run, f"doc_num {ents.schema['doc_num'].dataType.simpleString()}, connections long, pairs long")


def document_lists(mentions: DataFrame, edges: DataFrame, bound: int = BROADCAST_PAIRS) -> DataFrame:
    """Partners, competitors, suppliers and personnel of each document's
    entities as (doc_num, kind, other) rows: no list grows in one row."""
    ents, near = mentions.select("doc_num", F.col("alias").alias("id")), _near(edges)
    return _lists_in_tasks(ents, near) if within(near, bound) else _listed(ents.repartition("doc_num"), near)


def document_network(mentions: DataFrame, edges: DataFrame, bound: int = BROADCAST_PAIRS) -> DataFrame:
    """Per document: partners, competitors and suppliers of its entities,
    centrality sum, relations among its entities, relevance and density.

    Relations among a document's entities are found by expanding each
    undirected pair from its end of lower degree only, then checking the other
    end; pairs of entities are never enumerated.  While the pairs are within
    the bound every task holds them as whole numbers and a document's sets
    are marks there; beyond it they meet by joins.
    """
    ents = mentions.select("doc_num", F.col("alias").alias("id")).repartition("doc_num")
    deg = materialize(degree(edges), "degree")
    near = _near(edges)
    lists = _counts_in_tasks(ents, near) if within(near, bound) else _listed(ents, near).groupBy("doc_num").agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in ("partners", "competitors", "supply")])
    sums = ents.join(deg, "id", "left").groupBy("doc_num").agg(
        F.count("*").alias("entities"), F.coalesce(F.sum("degree"), F.lit(0)).alias("centrality"))
    weight = (edges.where("src <> dst").groupBy(F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y"))
              .agg(F.count("*").alias("n")))
    oriented = materialize(weight.join(deg.select(F.col("id").alias("x"), F.col("degree").alias("dx")), "x")
                           .join(deg.select(F.col("id").alias("y"), F.col("degree").alias("dy")), "y")
                           .select(F.when(F.col("dx") <= F.col("dy"), F.col("x")).otherwise(F.col("y")).alias("id"),
                                   F.when(F.col("dx") <= F.col("dy"), F.col("y")).otherwise(F.col("x")).alias("other"), "n"), "oriented")
    if within(oriented, bound):
        inside = _inside_in_tasks(ents, oriented)
    else:
        inside = (ents.join(small(oriented, BROADCAST_NODES), "id").select("doc_num", F.col("other").alias("id"), "n")
                  .join(ents, ["doc_num", "id"], "left_semi").groupBy("doc_num")
                  .agg((2 * F.sum("n")).alias("connections"), F.count("*").alias("pairs")))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return (sums.join(lists, "doc_num", "left").join(inside, "doc_num", "left").select(
        "doc_num", "entities", zero("partners"), zero("competitors"), zero("supply"), "centrality", zero("connections"),
        network_relevance(F.coalesce("connections", F.lit(0))).alias("network_relevance_score"),
        density(F.coalesce("pairs", F.lit(0)), F.col("entities")).alias("relationship_density")))


# --- entity resolution --------------------------------------------------------------

SHORT_NAME = 16   # up to here deletion forms, beyond it segments: both bounded per name


def _deletions(word: Column) -> Column:
    """The word and every form with one or two characters removed (at most
    some 170, as longer words are not asked)."""
    def drop(w, i):
        return F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w)))
    def once(w):
        return F.when(F.length(w) > 0, F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: drop(w, i))).otherwise(F.array().cast("array<string>"))
    first = once(word)
    return F.array_distinct(F.concat(F.array(word), first, F.flatten(F.transform(first, once))))


def _segment(length: Column, part: int) -> tuple[Column, Column]:
    """(start from 0, size) of a third of a word."""
    third = F.floor(length / 3).cast("int")
    return third * part, (third if part < 2 else (length - third * 2).cast("int"))


def _segments(word: Column) -> Column:
    """A long alias under each of its thirds: two edits leave one untouched."""
    n = F.length(word)
    out = []
    for part in range(3):
        at, size = _segment(n, part)
        out.append(F.concat_ws("|", n.cast("string"), F.lit(str(part)), F.substring(word, at + 1, size)))
    return F.array(*out)


def _segment_probes(word: Column) -> Column:
    """Where those thirds may lie in a word within two edits: shifted by up to
    two, in an alias up to two shorter or longer (75 forms)."""
    out = []
    for change in range(-2, 3):
        n = F.length(word) + change
        for part in range(3):
            at, size = _segment(n, part)
            out += [F.when((n > SHORT_NAME) & (at + shift >= 0), F.concat_ws("|", n.cast("string"), F.lit(str(part)), F.substring(word, at + 1 + shift, size)))
                    for shift in range(-2, 3)]
    return F.array_distinct(F.array_compact(F.array(*out)))


def resolve_entities(names: DataFrame, aliases: DataFrame, letters: int = 0) -> DataFrame:
    """Surface forms to canonical ids: exact alias, else the nearest alias
    within two edits that has at least ``letters`` letters for each of them.

    Two words within two edits share a form with at most two characters
    removed; of a long alias one third is left untouched.  Equi-joins on those
    forms find every candidate without comparing all names with all aliases,
    and a name makes a bounded number of them however long it is.
    """
    exact = names.join(aliases, names["name"] == aliases["alias"]).select("name", "alias", "entity_id", F.lit(0).alias("distance"))
    rest = names.join(aliases.select(F.col("alias").alias("name")), "name", "left_anti")
    none = F.array().cast("array<string>")
    asked = F.concat(F.when(F.length("name") <= SHORT_NAME + 2, _deletions(F.col("name"))).otherwise(none), _segment_probes(F.col("name")))
    listed = F.when(F.length("alias") <= SHORT_NAME, _deletions(F.col("alias"))).otherwise(_segments(F.col("alias")))
    left = rest.select("name", F.explode_outer(asked).alias("form"))
    right = aliases.select("alias", "entity_id", F.explode_outer(listed).alias("form"))
    distance = F.levenshtein("name", "alias")
    near = (left.join(right, "form").where((distance <= 2) & (distance * letters <= F.length("alias")))
            .select("name", "alias", "entity_id", distance.alias("distance")))
    best = near.groupBy("name").agg(F.min(F.struct("distance", "alias", "entity_id")).alias("b")).select(
        "name", "b.alias", "b.entity_id", "b.distance")
    return exact.unionByName(best)
