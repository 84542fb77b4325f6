"""Queries: entities, relations, coreference, assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings import vocab
from tidings.functions import text, vectors
from tidings.operators import nlp, spans
from tidings.operators.ingest import union_all
from tidings.plans import common
from tidings.plans.sql import ARTICLES, EDGES, GAZETTEER, GIVEN, TOKENS, with_
from tidings.sources import tables


def ner_gazetteer(spark, sf):
    _, _, found = common.found(spark, sf)
    scored = found.withColumn("confidence", F.col("tf") / (F.col("tf") + F.lit(0.5)))
    kept = F.col("confidence") > vocab.ENTITY_CONFIDENCE_MIN
    return scored.groupBy("type").agg(
        F.count("*").alias("mentions"), F.sum("tf").alias("occurrences"),
        F.count_if(kept).alias("confident"), F.count_distinct("entity_id").alias("entities"))


def entities_by_type(spark, sf):
    _, _, found = common.found(spark, sf)
    rows = nlp.entities_by_type(found).select("doc_num", F.size("entities").cast("bigint").alias("entities"), *nlp.typed_arrays(F.col("entities_by_type")))
    return rows.select("doc_num", "entities", *[F.array_join(c, ",").alias(c) for c in ("companies", "technologies", "agencies")])


def _occurrences(spark, sf):
    _, occ, found = common.found(spark, sf)
    return occ, found


def graph_extract(spark, sf):
    """Nodes and typed relations per document, as the graph structure holds them."""
    occ, found = _occurrences(spark, sf)
    g = nlp.graph_struct(found, nlp.adjacent_relations(occ))
    rels = F.transform("graph.relationships", lambda r: F.concat_ws("|", r["source"], r["type"], r["target"], r["properties"]["value"]))
    nodes = F.transform("graph.nodes", lambda n: F.concat_ws("|", n["id"], n["type"], n["properties"]["description"]))
    return g.select("doc_num", F.size("graph.nodes").cast("bigint").alias("nodes"), F.size("graph.relationships").cast("bigint").alias("relationships"),
                    F.md5(text.joined(nodes)).alias("nodes_md5"), F.md5(text.joined(rels)).alias("relations_md5"))


def nlp_summary(spark, sf):
    occ, found = _occurrences(spark, sf)
    g = nlp.graph_struct(found, nlp.adjacent_relations(occ)).join(nlp.entities_by_type(found), "doc_num")
    return nlp.enrichment_summary(tables.table(spark, sf, "documents"), g)


def nlp_counters(spark, sf):
    """Found and kept by service: confidence grows with how often a text names an entity or ties two."""
    occ, found = _occurrences(spark, sf)
    def sure(df, n, half):
        return df.withColumn("confidence", F.col(n) / (F.col(n) + F.lit(half)))
    docs = tables.spread(tables.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return nlp.service_counters(sure(found, "tf", 0.5), docs.select(nlp.pronoun_clusters("text").alias("clusters")),
                                sure(nlp.adjacent_relations(occ), "n", 1.0))


def vocab_filter(spark, sf):
    occ, _ = _occurrences(spark, sf)
    rel = nlp.adjacent_relations(occ).select("type").unionByName(tables.edges(spark, sf).select("type"))
    strict = nlp.allowed_relations(rel).groupBy("type").agg(F.count("*").alias("strict"))
    return (nlp.allowed_relations(rel, strict=False).groupBy("type").agg(F.count("*").alias("all")).join(strict, "type", "left")
            .select("type", "all", F.coalesce("strict", F.lit(0)).alias("strict")))


def briefs(spark, sf):
    """One sentence per order line, worded from its parties, beside every document."""
    def name(c):
        return F.replace(c, F.lit("#"), F.lit(" "))
    li = tables.spread(tables.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "l_orderkey")
    o = tables.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    c = tables.table(spark, sf, "customer").select("c_custkey", name("c_name").alias("c"))
    s = tables.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), name("s_name").alias("s"))
    p = tables.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("p"))
    rows = li.join(o, "l_orderkey").join(c, "c_custkey").join(s, "l_suppkey").join(p, "l_partkey")
    n = F.col("l_linenumber")
    sentence = (F.when(n == 1, F.concat("c", F.lit(" partners with "), "s"))
                .when(n == 2, F.concat(F.lit("DARPA funds "), "s"))
                .when(n == 3, F.concat("c", F.lit(" acquires "), "s"))
                .when(n == 4, F.concat("s", F.lit(" develops "), "p", F.lit(" system")))
                .when(n == 5, F.concat("s", F.lit(" awarded a contract")))
                .when(n == 6, F.concat(F.lit("$5,000 million from DARPA to "), "s"))
                .otherwise(F.concat("s", F.lit(" met "), "c")))
    lines = rows.select(F.concat_ws(":", F.lit("line"), "l_orderkey", "l_linenumber").alias("id"),
                        F.concat(sentence, F.lit(". The "), "p", F.lit(" shipped.")).alias("text"))
    docs = tables.spread(tables.table(spark, sf, "documents").select("doc_id", "text"), "doc_id").select(
        F.concat_ws(":", F.lit("doc"), "doc_id").alias("id"), "text")
    return lines.unionByName(docs)


def relation_rules(spark, sf):
    return nlp.relations(briefs(spark, sf), "id")


def resolved_texts(docs):
    """Texts with clusters and the coreference-resolved form, row by row."""
    return docs.withColumn("clusters", nlp.pronoun_clusters("text")).withColumn("resolved", nlp.resolve_coreferences(F.col("text"), F.col("clusters")))


def relations_resolved(spark, sf):
    """Relations found after coreferences were resolved: each order line's
    brief goes on about its subject as ``it``."""
    said = briefs(spark, sf).select(F.col("id"), F.when(F.col("id").startswith("line"), F.concat("text", F.lit(" It acquires a part.")))
                                    .otherwise(F.col("text")).alias("text"))
    return nlp.relations(resolved_texts(said).select("id", F.col("resolved").alias("text")), "id")


def ner_aliases(spark, sf):
    """Mentions of all given names in all texts."""
    return nlp.alias_mentions(common.tokenised(spark, sf), common.given_names(spark, sf))


def ner_spans(spark, sf):
    """Where the given names stand in all texts: leftmost, longest, none over another."""
    found = spans.name_spans(common.text_articles(spark, sf), common.given_names(spark, sf))
    return found.select("doc_num", "entity_id", "name", "first", "n", "score")


def run_models(spark, sf):
    """A model over all texts that fails on the batches holding a marked one:
    failed batches are reported, the others counted."""
    docs = tables.table(spark, sf, "documents").select(F.col("doc_id").alias("doc_num"), F.col("text"))

    def upper(pdf):
        if (pdf["doc_num"] % 97 == 5).any():
            raise ValueError("marked text")
        return pdf.assign(capitals=[sum(c.isupper() for c in t) for t in pdf["text"]])[["doc_num", "capitals"]]

    # one row at a time, so the batch size of the session does not decide which rows fail
    done = nlp.run_extractor(docs.select("doc_num", "text"), upper, "doc_num long, capitals long", rows=1)
    return done.select("doc_num", "capitals", F.col("error").isNotNull().alias("failed"), "error")


def coref_rewrite(spark, sf):
    docs = tables.spread(tables.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    done = resolved_texts(docs)
    return done.select("doc_id", F.md5(F.coalesce("resolved", "text")).alias("resolved_md5"),
                       F.length(F.coalesce("resolved", "text")).cast("bigint").alias("chars"),
                       F.coalesce(F.size(F.try_element_at("clusters", F.lit(1))) - 1, F.lit(0)).cast("bigint").alias("pronouns"))


def consolidate_nlp(spark, sf):
    _, _, found = common.found(spark, sf)
    docs = tables.spread(tables.table(spark, sf, "documents").select(F.col("doc_id").alias("doc_num"), F.col("text")), "doc_num")
    ents = found.groupBy("doc_num").agg(F.array_sort(F.collect_list("alias")).alias("entities"))
    coref = docs.select("doc_num", nlp.pronoun_clusters("text").alias("coreferences"))
    rel = nlp.relations(docs, "doc_num").groupBy("doc_num").agg(F.collect_list(F.struct("source_entity", "target_entity", "relation_type")).alias("relations"))
    out = nlp.consolidate(docs.select("doc_num"), ents, coref, rel, tables._at(F.col("doc_num")) + F.expr("INTERVAL 7 HOURS"))
    return out.select("doc_num", F.size("entities").cast("bigint").alias("entities"), F.size("coreferences").cast("bigint").alias("clusters"),
                      F.size("relations").cast("bigint").alias("relations"),
                      F.date_format("processing_metadata.processing_timestamp", "yyyy-MM-dd HH:mm:ss").alias("processed_at"),
                      F.col("processing_metadata.nlp_pipeline_version").alias("version"),
                      F.col("processing_metadata.model_versions")["ner"].alias("ner_model"))


def _nodes(spark, sf):
    _, _, found = common.found(spark, sf)
    a = tables.articles(spark, sf).select("doc_num", "published_at", "source")
    return found.join(a, "doc_num").select(
        F.col("alias").alias("id"), "type", "published_at", "doc_num",
        F.when(F.col("tf") > 1, F.create_map(F.lit("description"), F.concat(F.lit("from "), "source")))
        .otherwise(F.create_map(F.lit("sector"), F.lit("press"))).alias("properties"))


def entity_texts(spark, sf):
    """First text of each entity in publication order."""
    return nlp.entity_texts(_nodes(spark, sf), F.col("published_at"), F.col("doc_num"))


def node_embeddings(spark, sf):
    out = nlp.node_embeddings(nlp.allowed_nodes(_nodes(spark, sf)), F.col("published_at"), F.col("doc_num"))
    return out.select("id", F.size("embedding").cast("bigint").alias("dim"), F.round(vectors.norm(F.col("embedding")), 6).alias("norm"),
                      F.round(F.array_max("embedding"), 6).alias("largest"))


QUERIES = {f.__name__: f for f in (
    ner_gazetteer, entities_by_type, graph_extract, nlp_summary, nlp_counters, vocab_filter, relation_rules, coref_rewrite,
    consolidate_nlp, entity_texts, node_embeddings, relations_resolved, ner_aliases, ner_spans, run_models)}

OCCURRENCES = """
nxt AS (SELECT doc_num, alias AS src, type AS st, lead(alias) OVER w AS dst, lead(type) OVER w AS dt FROM occ WINDOW w AS (PARTITION BY doc_num ORDER BY pos)),
adj AS (
  SELECT doc_num, src, dst, CASE st || '>' || dt
     WHEN 'Company>Company' THEN 'PARTNERS_WITH' WHEN 'Company>Technology' THEN 'DEVELOPS' WHEN 'Company>Agency' THEN 'FUNDED_BY'
     WHEN 'Agency>Company' THEN 'AWARDS' WHEN 'Organization>Technology' THEN 'USES' WHEN 'Technology>Technology' THEN 'INTEGRATES_WITH'
     WHEN 'Organization>Organization' THEN 'COMPETES_WITH' ELSE 'RELATED_TO' END AS type, count(*) AS n
  FROM nxt WHERE dst IS NOT NULL AND src <> dst GROUP BY ALL)
"""
_ALLOWED = ", ".join(f"'{t}'" for t in vocab.RELATION_TYPES)
_PRONOUNS = ", ".join(f"'{t}'" for t in vocab.PRONOUNS)
_BRIEFS = """
named AS (SELECT l_orderkey, l_linenumber AS n, replace(c_name, '#', ' ') AS c, replace(s_name, '#', ' ') AS s, p_name AS p
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey),
briefs AS (
  SELECT 'line:' || l_orderkey || ':' || n AS id, CASE n WHEN 1 THEN c || ' partners with ' || s WHEN 2 THEN 'DARPA funds ' || s
    WHEN 3 THEN c || ' acquires ' || s WHEN 4 THEN s || ' develops ' || p || ' system' WHEN 5 THEN s || ' awarded a contract'
    WHEN 6 THEN '$5,000 million from DARPA to ' || s ELSE s || ' met ' || c END || '. The ' || p || ' shipped.' AS text FROM named
  UNION ALL SELECT 'doc:' || doc_id, text FROM documents)
"""
_EMITTING = [(k, p) for k, p in vocab.RELATION_PATTERNS if p.count("(") - p.count("(?:") >= 2]


def _rules(source, key):
    parts = [f"""SELECT {key}, unnest(regexp_extract_all(text, '(?i){p}', 1)) AS s, unnest(regexp_extract_all(text, '(?i){p}', 2)) AS t,
  unnest(regexp_extract_all(text, '(?i){p}', 0)) AS e, '{k}' AS relation_type FROM {source}""" for k, p in _EMITTING]
    return "rules AS (" + "\nUNION ALL ".join(parts) + ")"


_PIECES = r"""
pl AS (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}]+') AS pieces FROM documents),
pieces AS (SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS pos FROM pl),
words AS (SELECT * FROM pieces WHERE regexp_matches(piece, '^[\p{L}\p{N}]')),
main AS (SELECT doc_id, piece AS main, pos AS main_pos FROM words QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(piece) DESC, pos) = 1)
"""

_TEXTS = """
texts AS (SELECT alias AS id, arg_min(alias || ' - ' || type || CASE WHEN tf > 1 THEN ' - from ' || source ELSE '' END, (published_at, doc_num)) AS entity_text
  FROM mentions JOIN articles USING (doc_num) GROUP BY 1)
"""

ORACLES = {
    "ner_gazetteer": with_(TOKENS, GAZETTEER, body="""
SELECT type, count(*) AS mentions, sum(tf)::BIGINT AS occurrences, count(*) FILTER (tf / (tf + 0.5::DOUBLE) > 0.7) AS confident,
       count(DISTINCT entity_id) AS entities FROM mentions GROUP BY 1"""),
    "entities_by_type": with_(TOKENS, GAZETTEER, body="""
SELECT doc_num, count(*) AS entities, coalesce(string_agg(alias, ',' ORDER BY alias) FILTER (type = 'Company'), '') AS companies,
       coalesce(string_agg(alias, ',' ORDER BY alias) FILTER (type = 'Technology'), '') AS technologies,
       coalesce(string_agg(alias, ',' ORDER BY type, alias) FILTER (type IN ('Agency', 'Organization')), '') AS agencies
FROM mentions GROUP BY 1"""),
    "graph_extract": with_(TOKENS, GAZETTEER, OCCURRENCES, """
ns AS (SELECT doc_num, count(*) AS nodes, md5(string_agg(x, ',' ORDER BY x)) AS nodes_md5 FROM (
  SELECT doc_num, alias || '|' || type || '|seen ' || tf AS x FROM mentions) GROUP BY 1),
rs AS (SELECT doc_num, count(*) AS relationships, md5(string_agg(x, ',' ORDER BY x)) AS relations_md5 FROM (
  SELECT doc_num, src || '|' || type || '|' || dst || '|' || n AS x FROM adj) GROUP BY 1)""", body="""
SELECT doc_num, nodes, coalesce(relationships, 0) AS relationships, nodes_md5, coalesce(relations_md5, md5('')) AS relations_md5
FROM ns LEFT JOIN rs USING (doc_num)"""),
    "nlp_summary": with_(TOKENS, GAZETTEER, OCCURRENCES, body="""
SELECT (SELECT count(*) FROM documents) AS documents, (SELECT count(DISTINCT doc_num) FROM mentions) AS enriched,
       (SELECT count(*) FROM mentions) AS entities, (SELECT count(*) FROM adj) AS relationships,
       round((SELECT count(*) FROM mentions) / (SELECT count(DISTINCT doc_num) FROM mentions), 6) AS avg_entities"""),
    "nlp_counters": with_(TOKENS, GAZETTEER, OCCURRENCES, _PIECES, f"""
said AS (SELECT count(*) AS n FROM words JOIN main USING (doc_id) WHERE lower(piece) IN ({_PRONOUNS}) AND pos <> main_pos)""", body="""
SELECT 'ner' AS service, 'total_entities' AS counter, count(*) AS value FROM mentions
UNION ALL SELECT 'ner', 'high_confidence_entities', count(*) FILTER (tf / (tf + 0.5::DOUBLE) > 0.7) FROM mentions
UNION ALL SELECT 'coreference', 'clusters_found', count(*) FROM main
UNION ALL SELECT 'coreference', 'total_mentions', (SELECT n FROM said) + count(*) FROM main
UNION ALL SELECT 'relations', 'total_relations_found', count(*) FROM adj
UNION ALL SELECT 'relations', 'high_quality_relations', count(*) FILTER (n / (n + 1.0::DOUBLE) > 0.5) FROM adj"""),
    "vocab_filter": with_(TOKENS, GAZETTEER, OCCURRENCES, EDGES, "u AS (SELECT type FROM adj UNION ALL SELECT type FROM edges)", body=f"""
SELECT type, count(*) AS "all", count(*) FILTER (type IN ({_ALLOWED})) AS strict FROM u GROUP BY 1"""),
    "relation_rules": with_(_BRIEFS, _rules("briefs", "id"), body="""
SELECT id, trim(s) AS source_entity, trim(t) AS target_entity, relation_type, 0.8::DOUBLE AS confidence, e AS evidence_text FROM rules"""),
    "relations_resolved": with_(_BRIEFS, "said AS MATERIALIZED (SELECT row_number() OVER () AS r, id, CASE WHEN starts_with(id, 'line') THEN text || ' It acquires a part.' ELSE text END AS text FROM briefs)",
                                _PIECES.replace("documents", "said").replace("doc_id", "r"), f"""
whole AS (SELECT r, string_agg(CASE WHEN lower(piece) IN ({_PRONOUNS}) AND pos <> main_pos THEN main ELSE piece END, '' ORDER BY pos) AS text
  FROM pieces LEFT JOIN main USING (r) GROUP BY 1),
resolved AS (SELECT id, whole.text FROM whole JOIN said USING (r))""", _rules("resolved", "id"), body="""
SELECT id, trim(s) AS source_entity, trim(t) AS target_entity, relation_type, 0.8::DOUBLE AS confidence, e AS evidence_text FROM rules"""),
    "ner_spans": with_(TOKENS, GIVEN, r"""
hits AS (SELECT s.doc_num, s.pos, k.n, array_to_string(t.tokens[s.pos:s.pos + k.n - 1], ' ') AS gram FROM seq s JOIN toks t USING (doc_num)
  JOIN (SELECT DISTINCT n, split_part(gram, ' ', 1) AS head FROM keyed) k ON k.head = s.term WHERE s.pos + k.n - 1 <= len(t.tokens)),
longest AS MATERIALIZED (SELECT doc_num, pos, max_by(gram, n) AS gram, max(n) AS n FROM hits WHERE gram IN (SELECT gram FROM keyed) GROUP BY ALL),
walk AS (SELECT * FROM longest QUALIFY row_number() OVER (PARTITION BY doc_num ORDER BY pos) = 1
  UNION ALL SELECT l.* FROM walk w JOIN longest l ON l.doc_num = w.doc_num AND l.pos >= w.pos + w.n
  QUALIFY row_number() OVER (PARTITION BY l.doc_num ORDER BY l.pos) = 1),
share AS (SELECT gram, round(1.0 / count(DISTINCT entity_id), 6)::DOUBLE AS score FROM keyed GROUP BY 1)""", body="""
SELECT doc_num, entity_id, name, (pos - 1)::INT AS first, walk.n::INT AS n, score FROM walk JOIN keyed USING (gram) JOIN share USING (gram)"""),
    "ner_aliases": with_(TOKENS, GIVEN, r"""
grams AS (SELECT s.doc_num, array_to_string(t.tokens[s.pos:s.pos + k.n - 1], ' ') AS gram FROM seq s JOIN toks t USING (doc_num)
  JOIN (SELECT DISTINCT n, split_part(gram, ' ', 1) AS head FROM keyed) k ON k.head = s.term
  WHERE s.pos + k.n - 1 <= len(t.tokens))""", body="""
SELECT doc_num, entity_id, name, count(*) AS tf FROM grams JOIN keyed USING (gram) GROUP BY ALL"""),
    "run_models": r"""
SELECT doc_id AS doc_num, CASE WHEN doc_id % 97 <> 5 THEN len(regexp_extract_all(text, '\p{Lu}')) END::BIGINT AS capitals, doc_id % 97 = 5 AS failed,
  CASE WHEN doc_id % 97 = 5 THEN 'ValueError: marked text' END AS error FROM documents""",
    "coref_rewrite": with_(_PIECES, body=f"""
SELECT doc_id, md5(string_agg(x, '' ORDER BY pos)) AS resolved_md5, sum(length(x))::BIGINT AS chars, coalesce(sum(p), 0)::BIGINT AS pronouns FROM (
  SELECT doc_id, pos, CASE WHEN lower(piece) IN ({_PRONOUNS}) AND pos <> main_pos THEN main ELSE piece END AS x,
         CASE WHEN lower(piece) IN ({_PRONOUNS}) AND pos <> main_pos THEN 1 ELSE 0 END AS p
  FROM pieces LEFT JOIN main USING (doc_id)) GROUP BY 1"""),
    "consolidate_nlp": with_(TOKENS, GAZETTEER, "w AS (SELECT doc_num, count(*) AS n FROM seq GROUP BY 1)", _rules("documents", "doc_id"), body="""
SELECT doc_id AS doc_num, coalesce(m.n, 0) AS entities, CASE WHEN w.n > 0 THEN 1 ELSE 0 END::BIGINT AS clusters, coalesce(r.n, 0) AS relations,
       strftime(TIMESTAMP '2024-01-01' + to_days((doc_id % 30)::INT) + to_hours((doc_id % 24)::INT + 7), '%Y-%m-%d %H:%M:%S') AS processed_at,
       '1.0' AS version, 'roberta-base-finetuned-v2.1' AS ner_model
FROM documents d LEFT JOIN (SELECT doc_num, count(*) AS n FROM mentions GROUP BY 1) m ON d.doc_id = m.doc_num
LEFT JOIN w ON d.doc_id = w.doc_num LEFT JOIN (SELECT doc_id, count(*) AS n FROM rules GROUP BY 1) r USING (doc_id)"""),
    "node_embeddings": with_(ARTICLES, TOKENS, GAZETTEER, _TEXTS, r"""
tt AS (SELECT id, unnest(regexp_extract_all(lower(entity_text), '[\p{L}\p{N}]+')) AS term FROM texts),
sl AS (SELECT id, ('0x' || substring(md5(term), 1, 7))::BIGINT % 64 AS slot,
  sum(CASE WHEN ('0x' || substring(md5(term), 8, 1))::BIGINT % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END) AS val FROM tt GROUP BY 1, 2)""", body="""
SELECT id, 64::BIGINT AS dim, CASE WHEN sum(val * val) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS norm,
  round(CASE WHEN sum(val * val) > 0 THEN greatest(max(val), 0) / sqrt(sum(val * val)) ELSE 0 END, 6) AS largest FROM sl GROUP BY 1"""),
    "entity_texts": with_(ARTICLES, TOKENS, GAZETTEER, _TEXTS, body="SELECT id, entity_text FROM texts"),
}
