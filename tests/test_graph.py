import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidings.operators import graph, nlp, quality, temporal
from tidings.session import materialize

E = "src string, dst string, type string"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def entities(spark, *r):
    return spark.createDataFrame(list(r), "id string, labels array<string>, props map<string,string>, embedding array<float>, last_updated timestamp")


def test_entity_upsert_merges_and_is_idempotent(spark):
    old = entities(spark, ("a", ["Company"], {"industry": "x", "sector": "s"}, [1.0], day(0)))
    new = entities(spark, ("a", ["Agency"], {"industry": "y"}, None, day(1)), ("b", ["Person"], {}, None, day(1)))
    once = graph.upsert_entities(old, new)
    got = {r.id: r for r in once.collect()}
    assert got["a"].labels == ["Agency", "Company"] and got["a"].props == {"industry": "y", "sector": "s"}
    assert got["a"].embedding == [1.0] and got["b"].props == {}
    twice = graph.upsert_entities(once.select(old.columns), new)
    assert rows(twice) == rows(once)


def test_relation_upsert_needs_both_ends(spark):
    s = "src string, dst string, type string, props map<string,string>, source_doc string, last_updated timestamp"
    old = spark.createDataFrame([("a", "b", "USES", {"since": "1"}, "d1", day(0))], s)
    new = spark.createDataFrame([("a", "b", "USES", {"value": "9"}, "d2", day(1)), ("a", "ghost", "USES", {}, "d2", day(1))], s)
    ends = spark.createDataFrame([("a",), ("b",)], "id string")
    out = graph.upsert_relations(old, new, ends).collect()
    assert len(out) == 1 and out[0].props == {"since": "1", "value": "9"} and out[0].source_doc == "d2"


def test_mentions_once_and_existing(spark):
    pairs = spark.createDataFrame([("d1", "a"), ("d1", "a"), ("d2", "a"), ("d1", "x")], "doc_id string, entity_id string")
    docs, ents = spark.createDataFrame([("d1",)], "id string"), spark.createDataFrame([("a",)], "id string")
    assert rows(graph.mention_edges(pairs, docs, ents).select("doc_id", "entity_id")) == [("d1", "a")]


def test_require_unique(spark):
    with pytest.raises(ValueError):
        graph.require_unique(spark.createDataFrame([("a",), ("a",)], "id string"), "id")


def random_edges(seed=5, nodes=60, n=70):
    rnd = random.Random(seed)
    return [(f"n{rnd.randrange(nodes)}", f"n{rnd.randrange(nodes)}", "T") for _ in range(n)]


def adjacency(edges):
    adj = {}
    for a, b, _ in edges:
        if a != b:
            adj.setdefault(a, set()).add(b)
            adj.setdefault(b, set()).add(a)
    return adj


def group(adj, start):
    seen, todo = {start}, [start]
    for x in todo:
        todo += adj[x] - seen
        seen |= adj[x]
    return seen


@pytest.mark.parametrize("hub", [100_000, 2])
def test_components_and_pagerank_against_brute_force(spark, monkeypatch, hub):
    """hub=2 deals every node of degree above two over several slices."""
    monkeypatch.setattr(graph, "HUB_EDGES", hub)
    edges = random_edges()
    adj = adjacency(edges)
    label = {}
    for root in sorted(adj):
        if root not in label:
            todo = [root]
            while todo:
                x = todo.pop()
                if x not in label:
                    label[x] = root
                    todo += adj[x]
    df = spark.createDataFrame(edges, E)
    assert rows(graph.components(df)) == sorted(label.items(), key=str)
    rank = {x: 1 / len(adj) for x in adj}
    for _ in range(3):
        rank = {x: 0.15 / len(adj) + 0.85 * sum(rank[y] / len(adj[y]) for y in adj[x]) for x in adj}
    got = {r.id: r["rank"] for r in graph.pagerank(df, 3).collect()}
    assert got.keys() == rank.keys() and all(abs(got[x] - rank[x]) < 1e-12 for x in rank)


@pytest.mark.parametrize("pairs, bound, hub", [(2, 3, 2), (5, 500_000, 100_000), (8_000_000, 0, 100_000)])
def test_blocks_of_any_size_and_few_hubs(spark, monkeypatch, pairs, bound, hub):
    """Pairs lie once, in several blocks, at the end of fewer relations; repeated edges, loops and nulls change nothing."""
    monkeypatch.setattr(graph, "HUB_EDGES", hub)
    edges = random_edges(seed=3, nodes=50, n=45) + [("n1", f"m{i}", "T") for i in range(20)]
    edges += edges[:30] + [("n1", "n1", "T"), ("n1", None, "T"), (None, "x", "T")] + [(b, a, t) for a, b, t in edges[10:40]]
    adj = adjacency([e for e in edges if None not in e])
    df = spark.createDataFrame(edges, E).repartition(3)
    label = {x: min(group(adj, x)) for x in adj}
    monkeypatch.setattr(graph, "BLOCK_PAIRS", pairs)
    monkeypatch.setattr(graph, "BROADCAST_NODES", bound)
    assert rows(graph.components(df)) == sorted(label.items(), key=str)
    rank = {x: 1 / len(adj) for x in adj}
    for _ in range(2):
        rank = {x: 0.15 / len(adj) + 0.85 * sum(rank[y] / len(adj[y]) for y in adj[x]) for x in adj}
    got = {r.id: (r.deg, r["rank"]) for r in graph.pagerank(df, 2).collect()}
    assert got.keys() == rank.keys() and all(got[x][0] == len(adj[x]) and abs(got[x][1] - rank[x]) < 1e-12 for x in rank)
    _, dealt, blocks = graph._owned(df)
    most, held = -(-len(edges) // pairs), {}
    for own, other, part in dealt.select("own", "other", F.spark_partition_id()).distinct().collect():
        assert held.setdefault(own, part) == part
    assert blocks <= most and len(set(held.values())) > (pairs < 6)
    assert dealt.distinct().count() == sum(map(len, adj.values())) // 2 and len(held) < len(adj)


def test_codes_that_clash_lead_to_another_seed(spark, monkeypatch):
    monkeypatch.setattr(graph, "_code", lambda c, seed: F.length(c).cast("long") if seed < 2 else F.xxhash64(F.lit(seed), c))
    df = spark.createDataFrame([("a", "b", "T"), ("c", "d", "T")], E)
    assert rows(graph.components(df)) == [("a", "a"), ("b", "a"), ("c", "c"), ("d", "c")]


def test_rounds_shuffle_no_texts_and_no_pair_twice(spark, monkeypatch):
    """A round of ranks joins two rows per node and block at most, not one per neighbour."""
    written = {}
    def noted(df, name):
        out = materialize(df, name)
        written.setdefault(name, []).append((out.count(), dict(out.dtypes)))
        return out
    monkeypatch.setattr(graph, "materialize", noted)
    edges = [(f"c{i}", f"s{j}", "T") for i in range(60) for j in range(i % 7, 30, 3)]
    assert graph.pagerank(spark.createDataFrame(edges, E), 2).count() == 90
    assert all(n <= 180 and "string" not in kinds.values() for name in ("blocks", "seats", "ranks") for n, kinds in written[name])
    assert graph.components(spark.createDataFrame(edges, E)).select("label").distinct().count() == 3
    assert all(n <= 90 for n, _ in written["stars"])


def test_team_views_count_relations_once(spark):
    """The three views read written counts; none joins orders or orders entities by itself."""
    from tidings.plans import catalogue
    views = catalogue.queries()["team_views"](spark, "/root/testdata/sf0.001")
    plan = views._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
    assert {r.team for r in views.collect()} == {"technology", "market", "full"}


def test_components_on_a_long_chain(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}", "T") for i in range(120)]
    out = graph.components(spark.createDataFrame(chain, E), max_rounds=25)
    assert {r.label for r in out.collect()} == {"n000"}


@pytest.mark.parametrize("hub", [100_000, 2])
def test_paths_and_neighbourhood_against_brute_force(spark, monkeypatch, hub):
    monkeypatch.setattr(graph, "HUB_EDGES", hub)
    edges = random_edges(seed=9, nodes=40, n=60)
    adj = adjacency(edges)
    def bfs(s):
        dist, todo = {s: 0}, [s]
        for x in todo:
            for y in adj.get(x, ()):
                if y not in dist:
                    dist[y] = dist[x] + 1
                    todo.append(y)
        return dist
    ids = sorted(adj)
    pairs = [(ids[i], ids[-1 - i]) for i in range(8)]
    df = spark.createDataFrame(edges, E)
    got = {(r.src, r.dst): (r.depth, r.path) for r in graph.shortest_paths(df, spark.createDataFrame(pairs, "src string, dst string"), 4).collect()}
    for s, t in pairs:
        d = bfs(s).get(t)
        depth, path = got[s, t]
        assert depth == (d if d is not None and d <= 4 else None)
        if depth:
            steps = path.split(">")
            assert len(steps) == depth + 1 and all(b in adj[a] for a, b in zip(steps, steps[1:]))
    near = graph.neighbourhood(df, spark.createDataFrame([(ids[0],)], "seed string"), 2)
    assert {(r.id, r.hop) for r in near.collect()} == {(x, h) for x, h in bfs(ids[0]).items() if h <= 2}


def test_entity_resolution_finds_all_within_two_edits(spark):
    aliases = spark.createDataFrame([("lockheed", "e1"), ("raytheon", "e2")], "alias string, entity_id string")
    names = ["lockheed", "lokheed", "lockeheeds", "lxckhxed", "raytheom", "raytheonics", "hockleed"]
    got = {r.name: (r.entity_id, r.distance) for r in graph.resolve_entities(spark.createDataFrame([(n,) for n in names], "name string"), aliases).collect()}
    assert got == {"lockheed": ("e1", 0), "lokheed": ("e1", 1), "lockeheeds": ("e1", 2), "lxckhxed": ("e1", 2), "raytheom": ("e2", 1), "hockleed": ("e1", 2)}


def test_set_density(spark):
    e = spark.createDataFrame([("a", "b", "T"), ("b", "a", "T"), ("a", "c", "T"), ("a", "z", "T")], E)
    m = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "z")], "grp int, id string")
    assert rows(graph.set_density(e, m)) == [(1, 3, 6, 0.6, round(2 * 2 / 6, 6)), (2, 1, 0, 0.0, 0.0)]


def test_next_in_group_crosses_buckets(spark):
    r = [("k", dt.datetime(2024, m, d), f"o{m}{d}") for m, d in ((1, 1), (1, 9), (4, 2), (7, 3))]
    out = temporal.lifecycle(spark.createDataFrame(r, "k string, start timestamp, object string"), ["k"])
    assert [x.end for x in out.orderBy("start").collect()] == [dt.datetime(2024, 1, 9), dt.datetime(2024, 4, 2), dt.datetime(2024, 7, 3), None]
    held = temporal.as_of(out, ["2024-05-01", "2023-01-01"])
    assert [x.object for x in held.collect()] == ["o42"]


def test_job_change_and_conflicts(spark):
    ev = spark.createDataFrame([("js", "acme", 0.7, day(0)), ("js", "beta", 0.9, day(1)), ("js", "gamma", 0.9, day(2))],
                               "subject string, object string, confidence double, last_updated timestamp")
    assert temporal.resolve_conflicts(ev, ["subject"]).first().object == "gamma"


def test_overlaps_and_inverted(spark):
    iv = spark.createDataFrame([("s", "a", day(0), day(50)), ("s", "b", day(40), day(60)), ("s", "c", day(70), day(65))], "subject string, object string, start timestamp, end timestamp")
    assert rows(temporal.overlaps(iv, ["subject"]).select("object", "earlier", "violation")) == [("b", "a", "overlap"), ("c", "b", "inverted")]


def test_overlap_with_an_interval_further_back(spark):
    iv = spark.createDataFrame([("s", "A", day(1), day(70)), ("s", "B", day(2), day(3)), ("s", "C", day(40), day(41)), ("s", "D", day(80), None), ("s", "E", day(200), day(201))],
                               "subject string, object string, start timestamp, end timestamp")
    assert rows(temporal.overlaps(iv, ["subject"]).select("object", "earlier", "violation")) == [("B", "A", "overlap"), ("C", "A", "overlap"), ("E", "D", "overlap")]


def test_trend_counts_gap_months(spark):
    e = spark.createDataFrame([("x", day(0)), ("x", day(1)), ("x", day(70))], "type string, ts timestamp")
    assert [(r.n, r.change) for r in temporal.trend(e).orderBy("period").collect()] == [(2, None), (0, -2), (1, 1)]


def test_resolution_allows_any_letter_and_any_length(spark):
    long = "abcdefghij" * 3
    aliases = spark.createDataFrame([("definition", "d"), (long, "l"), ("", "e"), ("ab", "s")], "alias string, entity_id string")
    names = ["xefinition", "efinition", "xx" + long[:-1], long[:10] + long[12:], long[:14] + "zz" + long[16:], "a" * 5000, "b", "unrelatedword"]
    got = {r.name: (r.entity_id, r.distance) for r in graph.resolve_entities(spark.createDataFrame([(n,) for n in names], "name string"), aliases).collect()}
    assert got.pop("b") in (("e", 1), ("s", 1))
    assert got == {"xefinition": ("d", 1), "efinition": ("d", 1), long[:10] + long[12:]: ("l", 2), long[:14] + "zz" + long[16:]: ("l", 2)}


def test_resolution_asks_for_letters_per_edit(spark):
    aliases = spark.createDataFrame([("of it", "o"), ("new york", "n"), ("newer", "w")], "alias string, entity_id string")
    names = spark.createDataFrame([(n,) for n in ("ofit", "fit", "newyork", "newyor", "newe", "new", "of")], "name string")
    got = {(r.name, r.entity_id, r.distance) for r in graph.resolve_entities(names, aliases, 4).collect()}
    assert got == {("ofit", "o", 1), ("newyork", "n", 1), ("newyor", "n", 2), ("newe", "w", 1)}


def test_document_lists_are_rows(spark):
    m = spark.createDataFrame([(1, "a"), (2, "b")], "doc_num long, alias string")
    e = spark.createDataFrame([("a", "b", "PARTNERS_WITH"), ("c", "a", "EMPLOYS"), ("a", "z", "LIKES")], E)
    assert rows(graph.document_lists(m, e)) == [(1, "partners", "b"), (1, "personnel", "c"), (2, "partners", "a")]


def test_quality_gate(spark):
    df = spark.createDataFrame([("1", 0.5), ("1", None)], "id string, c double")
    counts = quality.rule_counts(df, {"c_set": F.col("c").isNotNull()})
    uniq = quality.unique_count(df, "id_unique", "id")
    assert tuple(quality.gate(counts, uniq).first()) == (2, 2, 2, False)
    with pytest.raises(quality.QualityError):
        quality.enforce(counts, uniq)
    assert rows(quality.failing_rows(df, {"c_set": F.col("c").isNotNull()}, "id")) == [("1", "c_set")]


def test_document_network_small(spark):
    m = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "a")], "doc_num long, alias string")
    e = spark.createDataFrame([("a", "b", "PARTNERS_WITH"), ("b", "a", "PARTNERS_WITH"), ("a", "z", "COMPETES_WITH")], E)
    got = {r.doc_num: r for r in graph.document_network(m, e).collect()}
    assert (got[1].partners, got[1].competitors, got[1].connections, got[1].network_relevance_score) == (2, 1, 4, 0.4)
    assert (got[2].partners, got[2].connections, got[2].centrality, got[2].relationship_density) == (1, 0, 3, 0.0)


def test_lists_and_networks_are_the_same_by_marks_and_by_joins(spark):
    rng = random.Random(8)
    m = spark.createDataFrame([(d, f"n{rng.randint(0, 30)}") for d in (1, 2, 3, 4, None) for _ in range(12)] + [(7, "unknown"), (8, None)], "doc_num long, alias string")
    kinds = ["PARTNERS_WITH", "COMPETES_WITH", "USES", "SUPPLIES", "EMPLOYS", "LIKES"]
    e = spark.createDataFrame([(f"n{rng.randint(0, 30)}", f"n{rng.randint(0, 30)}", rng.choice(kinds)) for _ in range(80)], E)
    for operator in (graph.document_lists, graph.document_network):
        for edges in (e, e.limit(0)):
            assert rows(operator(m, edges)) == rows(operator(m, edges, 0))
    assert graph.document_network(m, e).where("connections > 0 and supply > 1").count() and graph.document_lists(m, e).count() > 30


def test_vocabulary_filter(spark):
    rel = spark.createDataFrame([("USES",), ("LIKES",)], "type string")
    assert nlp.allowed_relations(rel).count() == 1 and nlp.allowed_relations(rel, strict=False).count() == 2


def test_bitemporal_hides_later_records(spark):
    f = spark.createDataFrame([("k", "a", day(0), day(0)), ("k", "b", day(5), day(30))], "k string, object string, start timestamp, recorded timestamp")
    early = temporal.known_lifecycle(f, ["k"], F.lit("2024-01-10").cast("timestamp")).collect()
    assert [(r.object, r.end) for r in early] == [("a", None)]
    assert temporal.known_lifecycle(f, ["k"], F.lit("2024-03-01").cast("timestamp")).where("end is not null").count() == 1


def best_partition(edges):
    """Greatest modularity over all partitions of a few nodes, by trying each."""
    nodes = sorted({x for e in edges for x in e[:2]})
    ties = [(a, b) for a, b, _ in edges if a != b]
    k = {n: sum((a == n) + (b == n) for a, b in ties) for n in nodes}

    def quality(group):
        inner = sum(2 for a, b in ties if group[a] == group[b])
        totals = {}
        for n in nodes:
            totals[group[n]] = totals.get(group[n], 0) + k[n]
        return inner / (2 * len(ties)) - sum(t * t for t in totals.values()) / (2 * len(ties)) ** 2

    def grow(i, group, used):
        if i == len(nodes):
            yield quality(group)
            return
        for g in range(used + 1):
            group[nodes[i]] = g
            yield from grow(i + 1, group, max(used, g + 1))
    return max(grow(0, {}, 0))


@pytest.mark.parametrize("hub", [100_000, 2])
def test_communities(spark, monkeypatch, hub):
    monkeypatch.setattr(graph, "HUB_EDGES", hub)
    clique = [(a, b, "T") for a in "abcd" for b in "abcd" if a < b]
    edges = clique + [(a.upper(), b.upper(), t) for a, b, t in clique] + [("a", "A", "T"), ("a", "a", "T")]
    df = spark.createDataFrame(edges, E)
    got = graph.communities(df)
    assert sorted(map(tuple, got.collect())) == sorted([(x, "a") for x in "abcd"] + [(x, "A") for x in "ABCD"])
    q = graph.modularity(df, got).first()
    assert q.groups == 2 and q.modularity == pytest.approx(best_partition(edges))
    assert graph.modularity(df, graph.components(df)).first().modularity == pytest.approx(0)
    assert graph.communities(df.limit(0)).count() == 0


def test_communities_beat_components(spark):
    from tidings.sources import tables
    awards = tables.awards(spark, "/root/testdata/sf0.001")
    assert graph.modularity(awards, graph.communities(awards, 4, 2)).first().modularity > graph.modularity(awards, graph.components(awards)).first().modularity + 0.05
    with pytest.raises(ValueError):
        graph.communities(awards, moves=33)
