"""Queries: graph merges and graph analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings import vocab
from tidings.functions import text
from tidings.operators import graph, nlp, search
from tidings.plans import common
from tidings.plans.nlp import OCCURRENCES
from tidings.plans.search import _HYBRID, _ranked
from tidings.plans.sql import ARTICLES, EDGES, GAZETTEER, TOKENS, with_
from tidings.session import materialize
from tidings.sources import tables

_T = tables.table
MOVES, LEVELS = 4, 2   # rounds of a level and levels of the communities query


def _at(day):
    return F.lit(f"{day} 00:00:00").cast("timestamp")


def graph_docs_upsert(spark, sf):
    old = tables.articles(spark, sf).select(F.col("doc_id").alias("id"), "source", "published_at", F.col("ingestion_timestamp").alias("last_updated"), "doc_num")
    again = _T(spark, sf, "labels").select(F.col("doc_id").alias("doc_num"))
    new = old.join(again, "doc_num").withColumn("source", F.concat("source", F.lit("_v2"))).withColumn("last_updated", F.col("last_updated") + F.expr("INTERVAL 1 DAY"))
    out = graph.upsert_documents(old.drop("doc_num"), new.drop("doc_num"))
    return out.select("id", "source", common.iso("published_at"), common.iso("last_updated"))


def company_rows(spark, sf):
    """Customers and suppliers as nodes, and a later delta for the active ones."""
    none = F.lit(None).cast("array<float>").alias("embedding")
    def props(*kv):
        return F.create_map(*kv).alias("props")
    c = _T(spark, sf, "customer").select(
        tables._key("c:", "c_custkey").alias("id"), F.array(F.lit("Company")).alias("labels"),
        props(F.lit("description"), F.col("c_name"), F.lit("sector"), F.col("c_mktsegment")), none, _at("2024-01-01").alias("last_updated"))
    vec = _T(spark, sf, "embeddings").select(F.col("vec_id").alias("s_suppkey"), "embedding")
    s = _T(spark, sf, "supplier").join(vec, "s_suppkey", "left").select(
        tables._key("s:", "s_suppkey").alias("id"), F.array(F.lit("Company")).alias("labels"),
        props(F.lit("description"), F.col("s_name")), "embedding", _at("2024-01-01").alias("last_updated"))
    active = _T(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    delta = active.select(
        tables._key("c:", "o_custkey").alias("id"), F.array(F.lit("Organization")).alias("labels"),
        props(F.lit("sector"), F.lit("active"), F.lit("industry"), F.concat(F.lit("orders "), F.col("n").cast("string"))), none, _at("2024-02-01").alias("last_updated"))
    return c.unionByName(s), delta


LETTERS_PER_EDIT = 4   # a name of fewer than eight letters allows one edit, of fewer than four none


def graph_entities_upsert(spark, sf):
    out = graph.upsert_entities(*company_rows(spark, sf))
    pairs = F.transform(F.map_entries("props"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return out.select("id", text.joined(F.col("labels")).alias("labels"), text.joined(pairs).alias("props"),
                      F.col("embedding").isNotNull().alias("has_embedding"), common.iso("last_updated"))


def graph_mentions(spark, sf):
    gaz, _, found = common.found(spark, sf)
    docs = _T(spark, sf, "embeddings").select(F.col("vec_id").alias("id"))
    ents = gaz.where(F.col("type") != "Organization").select(F.col("entity_id").alias("id"))
    return graph.mention_edges(found.select(F.col("doc_num").alias("doc_id"), "entity_id"), docs, ents)


def relation_rows(spark, sf):
    li = _T(spark, sf, "lineitem")
    rows = li.select(
        tables._key("s:", "l_suppkey").alias("src"), tables._key("p:", "l_partkey").alias("dst"), F.lit("SUPPLIES").alias("type"),
        F.create_map(F.lit("value"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("status"), F.col("l_returnflag")).alias("props"),
        tables._key("o:", "l_orderkey").alias("source_doc"), F.col("l_shipdate").cast("timestamp").alias("last_updated"), "l_linestatus")
    return (rows.where(F.col("l_linestatus") == "F").drop("l_linestatus"), rows.where(F.col("l_linestatus") != "F").drop("l_linestatus"))


def graph_relations_upsert(spark, sf):
    ents = (_T(spark, sf, "supplier").select(tables._key("s:", "s_suppkey").alias("id"))
            .unionByName(_T(spark, sf, "part").where("p_size <= 25").select(tables._key("p:", "p_partkey").alias("id"))))
    out = graph.upsert_relations(*relation_rows(spark, sf), ents)
    return out.select("src", "dst", "type", F.col("props")["value"].alias("value"), F.col("props")["status"].alias("status"),
                      "source_doc", "writes", common.iso("last_updated"))


def graph_update_stats(spark, sf):
    _, occ, found = common.found(spark, sf)
    nodes = found.join(tables.doc_vectors(spark, sf), "doc_num", "left").select(F.col("alias").alias("id"), "embedding")
    return graph.update_statistics(nodes, nlp.adjacent_relations(occ))


def graph_constraint(spark, sf):
    """Keys that break uniqueness when links are used as document ids."""
    return graph.duplicate_keys(tables.articles(spark, sf).select("link"), "link")


def graph_route(spark, sf):
    hits = search.hybrid_search(common.text_articles(spark, sf), tables.doc_vectors(spark, sf), tables.search_queries(spark, sf), 5, 50)
    _, _, found = common.found(spark, sf)
    return graph.route(hits, found).select("query_id", "alias", "hits", "best_rank", "position")


def partners(spark, sf):
    members = _T(spark, sf, "supplier").select(tables._key("s:", "s_suppkey").alias("id"))
    return graph.partners(tables.awards(spark, sf), members, "AWARDS")


def two_hop(spark, sf):
    """Everything within two steps of each region: its nations, and their parties."""
    seeds = _T(spark, sf, "region").select(tables._key("r:", "r_regionkey").alias("seed"))
    return graph.neighbourhood(tables.edges(spark, sf), seeds, 2)


def centrality_degree(spark, sf):
    return graph.degree(tables.edges(spark, sf))


def pagerank_5(spark, sf):
    return graph.pagerank(tables.edges(spark, sf), 5).select("id", "deg", F.round("rank", 12).alias("rank"))


def components(spark, sf):
    """Groups of companies tied by at least three interactions."""
    strong = graph.strength(tables.awards(spark, sf)).where("interactions >= 3")
    return graph.components(materialize(strong, "strong"))   # read several times


def components_all(spark, sf):
    return graph.components(tables.edges(spark, sf)).groupBy("label").agg(F.count("*").alias("members"), F.max("id").alias("last"))


def communities(spark, sf):
    return graph.communities(tables.awards(spark, sf), moves=MOVES, levels=LEVELS)


def shortest_path(spark, sf):
    """Richest customer of each nation to the richest supplier of the next."""
    c = _T(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n")).agg(F.max(F.struct("c_acctbal", "c_custkey")).alias("m"))
    s = _T(spark, sf, "supplier").groupBy(((F.col("s_nationkey") + 24) % 25).alias("n")).agg(F.max(F.struct("s_acctbal", "s_suppkey")).alias("k"))
    pairs = c.join(s, "n").select(tables._key("c:", "m.c_custkey").alias("src"), tables._key("s:", "k.s_suppkey").alias("dst"))
    return graph.shortest_paths(tables.edges(spark, sf), pairs, 4)


def density_relevance(spark, sf):
    c = _T(spark, sf, "customer").select(F.col("c_nationkey").alias("grp"), tables._key("c:", "c_custkey").alias("id"))
    s = _T(spark, sf, "supplier").select(F.col("s_nationkey").alias("grp"), tables._key("s:", "s_suppkey").alias("id"))
    return graph.set_density(tables.awards(spark, sf), c.unionByName(s))


def relation_strength(spark, sf):
    return graph.strength(tables.edges(spark, sf))


def team_views(spark, sf):
    _, occ, _ = common.found(spark, sf)
    adj = nlp.adjacent_relations(occ)
    kinds = adj.select("type").unionByName(tables.edges(spark, sf).select("type"))
    all_edges = materialize(kinds.groupBy("type").agg(F.count("*").alias("n")), "types")   # counted once for all views
    views = [graph.team_view(all_edges, t).groupBy(F.lit(t).alias("team"), "type").agg(F.sum("n").alias("n")) for t in vocab.TEAM_RELATIONS]
    return views[0].unionByName(views[1]).unionByName(views[2])


def enriched_search_doc(spark, sf):
    _, occ, found = common.found(spark, sf)
    adj = nlp.adjacent_relations(occ)
    # both tables feed several joins: extracted once, read from the shared folder after
    return graph.document_network(materialize(found, "mentions"), materialize(adj.select("src", "dst", "type"), "relations"))


def document_lists(spark, sf):
    _, occ, found = common.found(spark, sf)
    adj = nlp.adjacent_relations(occ)
    return graph.document_lists(found, adj.select("src", "dst", "type"))


def entity_resolution(spark, sf):
    """Every word of the corpus against the alias table, with the number of
    documents that support it.  A word may stand for a name of several words
    that lost its blanks; an edit takes LETTERS_PER_EDIT letters of an alias."""
    gaz = materialize(common.gazetteer(spark, sf), "gazetteer")
    freq = search.document_frequencies(common.tokenised(spark, sf))
    names = materialize(freq.select(F.col("term").alias("name"), F.col("df").alias("docs")), "names")
    return graph.resolve_entities(names.select("name"), gaz, LETTERS_PER_EDIT).join(names, "name").select("name", "alias", "entity_id", "distance", "docs")


def entity_provenance(spark, sf):
    """(entity, source) rows: which sources support an entity."""
    _, _, found = common.found(spark, sf)
    src = _T(spark, sf, "documents").select(F.col("doc_id").alias("doc_num"), "source")
    return found.join(src, "doc_num").groupBy("entity_id", "source").agg(F.count("*").alias("docs"))


def index_graph_sync(spark, sf):
    ids = tables.articles(spark, sf).select(F.col("doc_num").alias("id"))
    idx = _T(spark, sf, "embeddings").select(F.col("vec_id").alias("id"))
    return (ids.join(idx, "id", "left_anti").withColumn("missing_in", F.lit("index"))
            .unionByName(idx.join(ids, "id", "left_anti").withColumn("missing_in", F.lit("graph"))))


QUERIES = {f.__name__: f for f in (
    graph_docs_upsert, graph_entities_upsert, graph_mentions, graph_relations_upsert, graph_update_stats, graph_constraint,
    graph_route, partners, two_hop, centrality_degree, pagerank_5, components, components_all, communities, shortest_path,
    density_relevance, relation_strength, team_views, enriched_search_doc, document_lists, entity_resolution, entity_provenance, index_graph_sync)}

_ADJ = """
und AS MATERIALIZED (SELECT DISTINCT a, b FROM (SELECT src AS a, dst AS b FROM {e} UNION ALL SELECT dst, src FROM {e}) WHERE a <> b)
"""


def _pagerank(rounds=5):
    parts = ["deg AS MATERIALIZED (SELECT a AS id, count(*) AS deg FROM und GROUP BY 1)",
             "nn AS (SELECT count(*)::DOUBLE AS n FROM deg)",
             "r0 AS MATERIALIZED (SELECT id, deg, 1.0::DOUBLE / n AS rank FROM deg, nn)"]
    for i in range(rounds):
        parts.append(f"""r{i + 1} AS MATERIALIZED (SELECT d.id, d.deg, 0.15::DOUBLE / n + 0.85::DOUBLE * f AS rank
  FROM deg d JOIN (SELECT b, sum(rank / deg) AS f FROM und JOIN r{i} ON a = id GROUP BY 1) x ON d.id = x.b, nn)""")
    return ",\n".join(parts)


def _communities(e, moves=MOVES, levels=LEVELS):
    """The same rounds of moves and contraction as CTEs; member (id, label) at the end."""
    parts = [f"""adj0 AS MATERIALIZED (WITH p AS (SELECT least(src, dst) AS x, greatest(src, dst) AS y, count(*) AS w FROM {e} WHERE src <> dst GROUP BY 1, 2)
  SELECT x AS a, y AS b, w FROM p UNION ALL SELECT y, x, w FROM p)""", "whole AS MATERIALIZED (SELECT sum(w)::HUGEINT AS m FROM adj0)"]
    for n in range(levels):
        parts.append(f"g{n}_0 AS MATERIALIZED (SELECT a AS id, sum(w)::HUGEINT AS k, a AS label FROM adj{n} GROUP BY 1)")
        for r in range(moves + 1):
            g = f"g{n}_{r}"
            parts.append(f"t{g} AS MATERIALIZED (SELECT label, sum(k)::HUGEINT AS total FROM {g} GROUP BY 1)")
            parts.append(f"""c{g} AS MATERIALIZED (SELECT id, label, sum(w)::HUGEINT AS w FROM (SELECT a AS id, label, w FROM adj{n} JOIN {g} ON b = id WHERE a <> b
  UNION ALL SELECT id, label, 0 FROM {g}) GROUP BY 1, 2)""")
            parts.append(f"""q{g} AS MATERIALIZED (SELECT {r} AS r, m * (SELECT sum(w)::HUGEINT FROM c{g} JOIN {g} USING (id, label))
  - (SELECT sum(total * total)::HUGEINT FROM t{g}) AS q FROM whole)""")
            if r < moves:
                parts.append(f"""g{n}_{r + 1} AS MATERIALIZED (SELECT id, any_value(k) AS k, CASE WHEN substring(md5(id), {r + 1}, 1) < '8'
  THEN arg_min(to_label, (loss, to_label <> own, to_label)) ELSE any_value(own) END AS label
  FROM (SELECT id, k, g.label AS own, c.label AS to_label, k * (total - CASE WHEN c.label = g.label THEN k ELSE 0 END) - m * w AS loss
    FROM c{g} c JOIN {g} g USING (id) JOIN t{g} t ON t.label = c.label, whole) GROUP BY 1)""")
        rounds = " UNION ALL ".join(f"SELECT * FROM qg{n}_{r}" for r in range(moves + 1))
        every = " UNION ALL ".join(f"SELECT {r} AS r, id, label FROM g{n}_{r}" for r in range(moves + 1))
        parts.append(f"b{n} AS MATERIALIZED (SELECT id, label FROM ({every}) WHERE r = (SELECT r FROM ({rounds}) ORDER BY q DESC, r LIMIT 1))")
        parts.append(f"adj{n + 1} AS MATERIALIZED (SELECT x.label AS a, y.label AS b, sum(w) AS w FROM adj{n} JOIN b{n} x ON a = x.id JOIN b{n} y ON b = y.id GROUP BY 1, 2)")
    chain = " ".join(f"JOIN b{n} ON b{n}.id = b{n - 1}.label" for n in range(1, levels))
    parts.append(f"""ends AS (SELECT b0.id, b{levels - 1}.label AS last FROM b0 {chain}),
member AS MATERIALIZED (SELECT id, min(id) OVER (PARTITION BY last) AS label FROM ends)""")
    return ",\n".join(parts)


def _labels(rounds):
    parts = ["l0 AS MATERIALIZED (SELECT DISTINCT a AS id, a AS label FROM und)"]
    for i in range(rounds):
        parts.append(f"""l{i + 1} AS MATERIALIZED (SELECT l.id, least(l.label, m) AS label FROM l{i} l
  JOIN (SELECT b, min(label) AS m FROM und JOIN l{i} ON a = id GROUP BY 1) x ON l.id = x.b)""")
    return ",\n".join(parts)


def _bfs(depth=4):
    parts = ["f0 AS MATERIALIZED (SELECT DISTINCT src AS seed, src AS id, 0 AS depth, src AS path FROM prs)",
             "s0 AS (SELECT * FROM f0)"]
    for i in range(depth):
        parts.append(f"""f{i + 1} AS MATERIALIZED (SELECT seed, b AS id, {i + 1} AS depth, min(path || '>' || b) AS path FROM f{i} JOIN und ON id = a
  WHERE NOT EXISTS (SELECT 1 FROM s{i} s WHERE s.seed = f{i}.seed AND s.id = b) GROUP BY seed, b)""")
        parts.append(f"s{i + 1} AS MATERIALIZED (SELECT * FROM s{i} UNION ALL SELECT * FROM f{i + 1})")
    return ",\n".join(parts)


# the distance of this SQL counts bytes: each letter with an accent becomes one free byte first
_ACCENTS = "".join(map(chr, range(0xDF, 0x100))), "".join(map(chr, (*range(33, 48), *range(58, 65), *range(65, 76))))


def _code_points(name, other="alias"):
    one = lambda c: f"""translate({c}, '{_ACCENTS[0]}', '{_ACCENTS[1].replace("'", "''")}')"""
    return f"levenshtein({one(name)}, {one(other)})"


_LETTERS = "(" + " + ".join(f"CASE WHEN contains({{0}}, '{chr(97 + i)}') THEN {1 << i} ELSE 0 END" for i in range(26)) + ")::BIGINT"

ORACLES = {
    "graph_docs_upsert": with_(ARTICLES, """
u AS (SELECT doc_id AS id, source, published_at, ingestion_timestamp AS lu FROM articles
  UNION ALL SELECT a.doc_id, a.source || '_v2', a.published_at, a.ingestion_timestamp + INTERVAL 1 DAY FROM articles a JOIN labels l ON a.doc_num = l.doc_id)""", body="""
SELECT id, source, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at, strftime(lu, '%Y-%m-%d %H:%M:%S') AS last_updated
FROM u QUALIFY row_number() OVER (PARTITION BY id ORDER BY lu DESC, source DESC) = 1"""),
    "graph_entities_upsert": with_("act AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)", body="""
SELECT 'c:' || c_custkey AS id, CASE WHEN n IS NULL THEN 'Company' ELSE 'Company,Organization' END AS labels,
  CASE WHEN n IS NULL THEN 'description=' || c_name || ',sector=' || c_mktsegment
       ELSE 'description=' || c_name || ',industry=orders ' || n || ',sector=active' END AS props, false AS has_embedding,
  CASE WHEN n IS NULL THEN '2024-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS last_updated
FROM customer LEFT JOIN act ON c_custkey = o_custkey
UNION ALL SELECT 's:' || s_suppkey, 'Company', 'description=' || s_name, vec_id IS NOT NULL, '2024-01-01 00:00:00'
FROM supplier LEFT JOIN embeddings ON s_suppkey = vec_id"""),
    "graph_mentions": with_(TOKENS, GAZETTEER, body="SELECT doc_num AS doc_id, entity_id FROM mentions JOIN embeddings ON doc_num = vec_id WHERE type <> 'Organization'"),
    "graph_relations_upsert": """SELECT src, dst, type, arg_max(v, (ts, v)) AS value, arg_max(st, (ts, st)) AS status, arg_max(sd, (ts, sd)) AS source_doc,
  count(*) AS writes, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_updated FROM (
  SELECT 's:' || l_suppkey AS src, 'p:' || l_partkey AS dst, 'SUPPLIES' AS type, l_extendedprice::DECIMAL(18,2)::VARCHAR AS v, l_returnflag AS st,
         'o:' || l_orderkey AS sd, l_shipdate AS ts FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey WHERE p_size <= 25)
GROUP BY 1, 2, 3""",
    "graph_update_stats": with_(TOKENS, GAZETTEER, OCCURRENCES, body="""
SELECT (SELECT count(*) FROM mentions) AS nodes, (SELECT count(*) FROM mentions JOIN embeddings ON doc_num = vec_id) AS vectors,
  (SELECT count(DISTINCT alias) FROM mentions) AS distinct_nodes, (SELECT count(*) FROM adj) AS relations,
  (SELECT count(*) FROM (SELECT DISTINCT src, dst, type FROM adj)) AS distinct_relations"""),
    "graph_constraint": with_(ARTICLES, body="SELECT link, count(*) AS n FROM articles GROUP BY 1 HAVING count(*) > 1"),
    "graph_route": with_(TOKENS, GAZETTEER, *_HYBRID[1:], _ranked("hyb", "hyb_scores", 5), """
sup AS (SELECT query_id, entity_id, alias, count(*) AS hits, min(rank) AS best_rank FROM hyb JOIN mentions USING (doc_num) GROUP BY ALL),
rr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY hits DESC, best_rank, alias) AS position FROM sup)""", body="""
SELECT query_id, alias, hits, best_rank, position FROM rr WHERE position <= 20"""),
    "partners": """SELECT DISTINCT 's:' || l_suppkey AS id, 'c:' || o_custkey AS partner FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "two_hop": with_(EDGES, _ADJ.format(e="edges"), """
h0 AS MATERIALIZED (SELECT 'r:' || r_regionkey AS seed FROM region),
h1 AS MATERIALIZED (SELECT seed, b AS id FROM h0 JOIN und ON a = seed),
h2 AS (SELECT DISTINCT seed, b AS id FROM h1 JOIN und ON a = id WHERE b <> seed)""", body="""
SELECT seed, seed AS id, 0 AS hop FROM h0 UNION ALL SELECT seed, id, 1 FROM h1
UNION ALL SELECT seed, id, 2 FROM h2 WHERE NOT EXISTS (SELECT 1 FROM h1 WHERE h1.seed = h2.seed AND h1.id = h2.id)"""),
    "centrality_degree": with_(EDGES, body="SELECT id, count(*) AS degree FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges) GROUP BY 1"),
    "pagerank_5": with_(EDGES, _ADJ.format(e="edges"), _pagerank(), body="SELECT id, deg, round(rank, 12) AS rank FROM r5"),
    "components": with_(EDGES, "strong AS MATERIALIZED (SELECT src, dst FROM awards GROUP BY 1, 2 HAVING count(*) >= 3)", _ADJ.format(e="strong"), """
cc AS (SELECT DISTINCT a AS node, a AS label FROM und UNION SELECT und.b, cc.label FROM cc JOIN und ON cc.node = und.a WHERE cc.label < und.b)""", body="""
SELECT node AS id, min(label) AS label FROM cc GROUP BY 1"""),
    "communities": with_(EDGES, _communities("awards"), body="SELECT id, label FROM member"),
    "components_all": with_(EDGES, _ADJ.format(e="edges"), _labels(8), body="SELECT label, count(*) AS members, max(id) AS last FROM l8 GROUP BY 1"),
    "shortest_path": with_(EDGES, _ADJ.format(e="edges"), """
cm AS (SELECT c_nationkey AS n, arg_max(c_custkey, (c_acctbal, c_custkey)) AS c FROM customer GROUP BY 1),
sm AS (SELECT (s_nationkey + 24) % 25 AS n, arg_max(s_suppkey, (s_acctbal, s_suppkey)) AS s FROM supplier GROUP BY 1),
prs AS MATERIALIZED (SELECT 'c:' || c AS src, 's:' || s AS dst FROM cm JOIN sm USING (n))""", _bfs(), body="""
SELECT src, dst, depth, path FROM prs LEFT JOIN s4 ON seed = src AND id = dst"""),
    "density_relevance": with_(EDGES, """
mem AS (SELECT c_nationkey AS grp, 'c:' || c_custkey AS id FROM customer UNION ALL SELECT s_nationkey, 's:' || s_suppkey FROM supplier),
ins AS (SELECT x.grp, src, dst FROM awards JOIN mem x ON src = x.id JOIN mem y ON dst = y.id AND x.grp = y.grp),
cnt AS (SELECT grp, 2 * count(*) AS connections, count(DISTINCT (least(src, dst), greatest(src, dst))) AS pairs FROM ins GROUP BY 1),
sz AS (SELECT grp, count(*) AS size FROM mem GROUP BY 1)""", body="""
SELECT grp, size, coalesce(connections, 0) AS connections, least(coalesce(connections, 0) / 10.0::DOUBLE, 1.0::DOUBLE) AS relevance,
  CASE WHEN size > 1 THEN round(coalesce(pairs, 0) * 2.0::DOUBLE / (size * (size - 1)), 6) ELSE 0 END AS density FROM sz LEFT JOIN cnt USING (grp)"""),
    "relation_strength": with_(EDGES, body="SELECT src, dst, type, count(*) AS interactions, sum(value::DECIMAL(18,2))::DOUBLE AS value FROM edges GROUP BY 1, 2, 3"),
    "team_views": with_(TOKENS, GAZETTEER, OCCURRENCES, EDGES, "u AS (SELECT type FROM adj UNION ALL SELECT type FROM edges)", body="\nUNION ALL ".join(
        f"SELECT '{t}' AS team, type, count(*) AS n FROM u WHERE type IN ({', '.join(repr(r) for r in rs)}) GROUP BY 2" for t, rs in vocab.TEAM_RELATIONS.items())),
    "enriched_search_doc": with_(TOKENS, GAZETTEER, OCCURRENCES, """
deg AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM adj UNION ALL SELECT dst FROM adj) GROUP BY 1),
kinds AS (SELECT *, CASE WHEN type = 'PARTNERS_WITH' THEN 'p' WHEN type = 'COMPETES_WITH' THEN 'c' WHEN type IN ('USES', 'DEVELOPS', 'SUPPLIES') THEN 's' END AS k FROM adj),
near AS (SELECT DISTINCT k, id, other FROM (SELECT k, src AS id, dst AS other FROM kinds UNION ALL SELECT k, dst, src FROM kinds) WHERE k IS NOT NULL),
lists AS (SELECT doc_num, count(DISTINCT other) FILTER (k = 'p') AS partners, count(DISTINCT other) FILTER (k = 'c') AS competitors,
  count(DISTINCT other) FILTER (k = 's') AS supply FROM mentions JOIN near ON alias = id GROUP BY 1),
sums AS (SELECT doc_num, count(*) AS entities, coalesce(sum(degree), 0)::BIGINT AS centrality FROM mentions LEFT JOIN deg ON alias = id GROUP BY 1),
wt AS (SELECT least(src, dst) AS x, greatest(src, dst) AS y, count(*) AS n FROM adj GROUP BY 1, 2),
ins AS (SELECT m1.doc_num, 2 * sum(n) AS connections, count(*) AS pairs FROM mentions m1 JOIN wt ON m1.alias = x
  JOIN mentions m2 ON m2.alias = y AND m2.doc_num = m1.doc_num GROUP BY 1)""", body="""
SELECT doc_num, entities, coalesce(partners, 0) AS partners, coalesce(competitors, 0) AS competitors, coalesce(supply, 0) AS supply, centrality,
  coalesce(connections, 0)::BIGINT AS connections, least(coalesce(connections, 0) / 10.0::DOUBLE, 1.0::DOUBLE) AS network_relevance_score,
  CASE WHEN entities > 1 THEN round(coalesce(pairs, 0) * 2.0::DOUBLE / (entities * (entities - 1)), 6) ELSE 0 END AS relationship_density
FROM sums LEFT JOIN lists USING (doc_num) LEFT JOIN ins USING (doc_num)"""),
    "document_lists": with_(TOKENS, GAZETTEER, OCCURRENCES, """
kinds AS (SELECT src, dst, CASE WHEN type = 'PARTNERS_WITH' THEN 'partners' WHEN type = 'COMPETES_WITH' THEN 'competitors'
  WHEN type IN ('USES', 'DEVELOPS', 'SUPPLIES') THEN 'supply' END AS kind FROM adj)""", body="""
SELECT DISTINCT doc_num, kind, other FROM mentions JOIN (SELECT kind, src AS id, dst AS other FROM kinds UNION ALL SELECT kind, dst, src FROM kinds) n
ON alias = n.id WHERE kind IS NOT NULL"""),
    # two edits change at most four letters of the set a word is made of: a cheap test before the distance
    "entity_resolution": with_(TOKENS, GAZETTEER, """
names AS MATERIALIZED (SELECT term AS name, count(*) AS docs, """ + _LETTERS.format("term") + """ AS letters FROM postings GROUP BY 1),
known AS MATERIALIZED (SELECT alias, entity_id, """ + _LETTERS.format("alias") + """ AS letters, unnest(generate_series(length(alias) - 2, length(alias) + 2)) AS size FROM gaz),
near AS (SELECT name, alias, entity_id, docs, CASE WHEN bit_count(xor(n.letters, k.letters)) <= 4 THEN """ + _code_points("name") + """ ELSE 9 END AS distance
  FROM names n JOIN known k ON length(name) = size)""", body=f"""
SELECT name, alias, entity_id, distance::INT AS distance, docs FROM near WHERE distance <= 2 AND distance * {LETTERS_PER_EDIT} <= length(alias)
QUALIFY row_number() OVER (PARTITION BY name ORDER BY distance, alias, entity_id) = 1"""),
    "entity_provenance": with_(TOKENS, GAZETTEER, body="SELECT entity_id, source, count(*) AS docs FROM mentions JOIN documents ON doc_num = doc_id GROUP BY 1, 2"),
    "index_graph_sync": """SELECT doc_id AS id, 'index' AS missing_in FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)
UNION ALL SELECT vec_id, 'graph' FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents)""",
}
