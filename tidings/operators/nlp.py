"""Entity, relation and coreference jobs over article tables.

Models are pluggable; the defaults are table joins and pattern rules that run
on the executors without any model file.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings import schemas, vocab
from tidings.functions import text, vectors
from tidings.operators.ingest import union_all
from tidings.session import materialize, small

BROADCAST_ALIASES = 500_000   # name rows broadcast at most: some 50 MB
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_LONGEST_PRONOUN = max(map(len, vocab.PRONOUNS))

TYPE_BY_LENGTH = ("Company", "Technology", "Agency", "Organization")


def mentions(occurrences: DataFrame) -> DataFrame:
    """(doc_num, entity_id, alias, type, tf): one row per document and entity."""
    return occurrences.groupBy("doc_num", "entity_id", "alias", "type").agg(F.count("*").alias("tf"))


def alias_mentions(docs: DataFrame, aliases: DataFrame) -> DataFrame:
    """(doc_num, entity_id, name, tf) of given names in tokenised texts.

    ``aliases`` has entity_id and name, of any number of words, any letters
    and any frequency.  Names are cut into the same tokens as texts.  A token
    that begins no name is dropped first; at the others one n-gram is formed
    per name length that begins with it, so only likely matches are joined.
    Beyond the broadcast bound both joins shuffle.
    """
    key = text.tokens(F.col("name"))
    names = materialize(aliases.select("entity_id", "name", F.array_join(key, " ").alias("gram"), key[0].alias("head"), F.size(key).alias("n"))
                        .where(F.col("n") > 0).distinct(), "aliases")
    heads = materialize(names.groupBy("head").agg(F.collect_set("n").alias("lengths")), "heads")
    at = docs.select("doc_num", "tokens", F.posexplode_outer("tokens").alias("pos", "head")).where(F.col("head").isNotNull())
    begun = at.join(small(heads, BROADCAST_ALIASES), "head")
    grams = begun.select("doc_num", F.explode(F.transform(F.filter("lengths", lambda n: F.col("pos") + n <= F.size("tokens")), lambda n: F.array_join(F.slice("tokens", F.col("pos") + 1, n), " "))).alias("gram"))
    return grams.join(small(names.select("gram", "entity_id", "name"), BROADCAST_ALIASES), "gram").groupBy(
        "doc_num", "entity_id", "name").agg(F.count("*").alias("tf"))


def run_extractor(docs: DataFrame, extract: Callable, schema: str, rows: int | None = None) -> DataFrame:
    """Run a model over Arrow batches, or over ``rows`` rows of one at a time:
    ``extract`` maps a pandas frame to one.

    A failing batch is reported as a row per document with its error; the
    others go on.
    """
    from pyspark.sql.types import StringType, StructType, _parse_datatype_string
    out = StructType(list(_parse_datatype_string(schema).fields)).add("error", StringType())

    def run(batches):
        for whole in batches:
            for i in range(0, len(whole), rows or max(1, len(whole))):
                pdf = whole.iloc[i:i + (rows or len(whole))]
                try:
                    res = extract(pdf).assign(error=None)
                except Exception as e:  # the batch is skipped, not the job
                    res = pd.DataFrame({"doc_num": pdf["doc_num"]}).assign(error=f"{type(e).__name__}: {e}")
                res = res.reindex(columns=out.names).astype(object)
                yield res.where(res.notna(), None)

    return docs.mapInPandas(run, out)


# --- relations ---------------------------------------------------------------

# Necessary part of every pattern of a type: a cheap test before the full one.
_STEMS = {
    "AWARDED_CONTRACT": "contract", "FUNDING_RELATIONSHIP": "DARPA|SBIR|DoD|Navy|Air Force|Army",
    "PARTNERSHIP": "partner|collaborate|team", "ACQUISITION": "acquire|purchase|buy|bought",
    "TECHNOLOGY_DEVELOPMENT": "develop|creat|build|specialize|focus",
}


# A run of words as the patterns spell it, and the same strings without a nested
# repeat: matched in one sweep, with no recursion however long the run.
_RUN, _SWEEP = r"\w+(?:\s+\w+)*", r"\w(?:[\w\s]*\w)?"


def _hits(body: Column, kind: str, pattern: str) -> Column:
    """Whole matches of a pattern in a text, as relation structs.

    A pattern that begins with a run of words matches inside one stretch of
    words and blanks, at most once, from its first word: a match from a later
    word would also match from the first.  So the text is cut into stretches,
    those without the pattern's stem are dropped, and the rest are matched
    from their start (after ``&``, where a pattern allows it).
    """
    swept = pattern.replace(_RUN, _SWEEP)
    if pattern.startswith(f"({_RUN})"):
        joins = "&" in pattern
        stretches = F.filter(F.regexp_extract_all(body, F.lit(r"[\w\s&]+" if joins else r"[\w\s]+"), F.lit(0)), lambda r: r.rlike("(?i)" + _STEMS[kind]))
        rx = r"(?i)(?:^|(?<=&))\s*" + swept if joins else r"(?i)^\s*" + swept
        found = F.flatten(F.transform(stretches, lambda r: F.regexp_extract_all(r, F.lit(rx), F.lit(0))))
    else:
        rx = "(?i)" + swept
        found = F.regexp_extract_all(body, F.lit(rx), F.lit(0))
    again = "(?i)" + swept
    return F.transform(F.transform(found, lambda m: F.regexp_replace(m, r"^\s+", "")), lambda m: F.struct(
        F.trim(F.regexp_extract(m, again, 1)).alias("source_entity"), F.trim(F.regexp_extract(m, again, 2)).alias("target_entity"),
        F.lit(kind).alias("relation_type"), F.lit(vocab.RULE_CONFIDENCE).alias("confidence"), m.alias("evidence_text")))


def relations(docs: DataFrame, id_col: str, content: str = "text") -> DataFrame:
    """Rule-based relations: one row per match of a pattern with two groups.

    The text is searched once per pattern for whole matches; the groups are
    read from each match, which re-matches to the same groups because the
    patterns look at nothing outside it.
    """
    body = F.col(content)
    found = []
    for kind, pattern in vocab.RELATION_PATTERNS:
        if pattern.count("(") - pattern.count("(?:") < 2:
            continue
        found.append(F.when(body.rlike("(?i)" + _STEMS[kind]), _hits(body, kind, pattern)))
    # outer form: a plain explode would run every pattern again to test for emptiness
    rows = docs.select(id_col, F.explode_outer(F.flatten(F.filter(F.array(*found), lambda x: x.isNotNull()))).alias("r"))
    return rows.where(F.col("r").isNotNull()).select(id_col, "r.*").where(F.col("confidence") > vocab.RELATION_CONFIDENCE_MIN)


def allowed(df: DataFrame, types: tuple[str, ...], column: str = "type", strict: bool = True) -> DataFrame:
    """Rows of the allowed node or relation types; all rows when not strict."""
    return df.where(F.col(column).isin(*types)) if strict else df


def allowed_relations(rel: DataFrame, column: str = "type", strict: bool = True) -> DataFrame:
    return allowed(rel, vocab.RELATION_TYPES, column, strict)


def allowed_nodes(nodes: DataFrame, column: str = "type", strict: bool = True) -> DataFrame:
    return allowed(nodes, vocab.NODE_TYPES, column, strict)


# --- coreference -------------------------------------------------------------

def resolve_coreferences(body: Column, clusters: Column) -> Column:
    """Replace each pronoun mention of a cluster by the cluster's longest mention.

    Spans are character offsets, end exclusive; only the mentioned span is
    replaced.  Overlapping spans keep the first.
    """
    def span_text(s):
        return F.substring(body, s["start"] + 1, s["end"] - s["start"])

    def edits(cluster):
        main = F.aggregate(cluster, F.element_at(cluster, 1), lambda best, s: F.when(
            (s["end"] - s["start"]) > (best["end"] - best["start"]), s).otherwise(best))
        pronouns = F.filter(cluster, lambda s: F.lower(span_text(s)).isin(*vocab.PRONOUNS)
                            & ~((s["start"] == main["start"]) & (s["end"] == main["end"])))
        return F.transform(pronouns, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), span_text(main).alias("by")))

    plan = F.array_sort(F.flatten(F.transform(F.filter(clusters, lambda c: F.size(c) > 1), edits)))
    done = F.aggregate(
        plan, F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out")),
        lambda acc, e: F.when(e["start"] >= acc["pos"], F.struct(
            e["end"].alias("pos"),
            F.concat(acc["out"], F.array(F.substring(body, acc["pos"] + 1, e["start"] - acc["pos"]), e["by"])).alias("out"))).otherwise(acc),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(body, acc["pos"] + 1, F.length(body))))
    return F.coalesce(done, body)


def pronoun_clusters(content: str = "text") -> Column:
    """Default clusters of each text: its longest word (the first of equals)
    and its pronouns, as character offsets.  A text without words has none.

    One pass over the text in the task that reads it; nothing is shuffled.
    """
    @F.pandas_udf(schemas.CLUSTERS)
    def find(body: pd.Series) -> pd.Series:
        out = []
        for value in body:
            main, pronouns = None, []
            for m in _WORD.finditer(value or ""):
                span = {"start": m.start(), "end": m.end()}
                if main is None or m.end() - m.start() > main["end"] - main["start"]:
                    main = span
                if m.end() - m.start() <= _LONGEST_PRONOUN and m[0].lower() in vocab.PRONOUNS:
                    pronouns.append(span)
            out.append([] if main is None else [[main] + [p for p in pronouns if p != main]])
        return pd.Series(out, dtype=object)

    return find(content)


# --- assembly ----------------------------------------------------------------

def entities_by_type(found: DataFrame) -> DataFrame:
    """Per document: entity list and map type -> list (bounded by the document)."""
    per_type = found.groupBy("doc_num", "type").agg(F.array_sort(F.collect_list("alias")).alias("ids"))
    return per_type.groupBy("doc_num").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "ids")))).alias("entities_by_type")
    ).withColumn("entities", F.array_sort(F.flatten(F.map_values("entities_by_type"))))


def typed_arrays(by_type: Column) -> list[Column]:
    """companies, technologies and agencies (= Agency ++ Organization)."""
    def of(t):
        return F.coalesce(by_type[t], F.array().cast("array<string>"))
    return [of("Company").alias("companies"), of("Technology").alias("technologies"),
            F.concat(of("Agency"), of("Organization")).alias("agencies")]


RELATION_BY_PAIR = (
    ("Company", "Company", "PARTNERS_WITH"), ("Company", "Technology", "DEVELOPS"),
    ("Company", "Agency", "FUNDED_BY"), ("Agency", "Company", "AWARDS"),
    ("Organization", "Technology", "USES"), ("Technology", "Technology", "INTEGRATES_WITH"),
    ("Organization", "Organization", "COMPETES_WITH"),
)


def adjacent_relations(occurrences: DataFrame) -> DataFrame:
    """Default graph extraction: each entity and the next different entity of
    the same text, typed by their kinds.  Linear in the text; pairs of a
    document are never enumerated."""
    w = Window.partitionBy("doc_num").orderBy("pos")
    nxt = occurrences.select("doc_num", "pos", F.col("alias").alias("src"), F.col("type").alias("src_type"),
                             F.lead("alias").over(w).alias("dst"), F.lead("type").over(w).alias("dst_type"))
    rule = F.create_map(*[x for a, b, t in RELATION_BY_PAIR for x in (F.lit(f"{a}>{b}"), F.lit(t))])
    typed = nxt.withColumn("type", F.coalesce(rule[F.concat_ws(">", "src_type", "dst_type")], F.lit("RELATED_TO")))
    return (typed.where(F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
            .groupBy("doc_num", "src", "dst", "type").agg(F.count("*").alias("n")))


def graph_struct(found: DataFrame, rel: DataFrame) -> DataFrame:
    """M7 graph per document: nodes and relationships with property maps."""
    node = F.struct(F.col("alias").alias("id"), F.col("type"), F.create_map(
        F.lit("description"), F.concat(F.lit("seen "), F.col("tf").cast("string"))).alias("properties"))
    edge = F.struct(F.col("src").alias("source"), F.col("dst").alias("target"), F.col("type"), F.create_map(
        F.lit("value"), F.col("n").cast("string")).alias("properties"))
    nodes = found.groupBy("doc_num").agg(F.collect_list(node).alias("nodes"))
    rels = rel.groupBy("doc_num").agg(F.collect_list(edge).alias("relationships"))
    return nodes.join(rels, "doc_num", "left").select("doc_num", F.struct(
        "nodes", F.coalesce("relationships", F.array().cast("array<struct<source:string,target:string,type:string,properties:map<string,string>>>")).alias("relationships")).alias("graph"))


def enrich(articles: DataFrame, found: DataFrame, rel: DataFrame, embed: Callable = vectors.embed_tokens) -> DataFrame:
    """Enriched documents: entities, entities by type, graph, embedding."""
    body = text.embedding_text(F.col("title"), F.col("content"), F.col("description"))
    meta = F.struct(F.col("doc_id").alias("id"), "title", "description", "link",
                    F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss").alias("published_at"),
                    "source", "source_type", F.coalesce("categories", F.array().cast("array<string>")).alias("categories"))
    base = articles.select("doc_num", "doc_id", body.alias("content"), meta.alias("metadata"),
                           embed(text.tokens(body)).alias("embedding"))
    return (base.join(entities_by_type(found), "doc_num", "left").join(graph_struct(found, rel), "doc_num", "left")
            .select("doc_id", "content", "metadata", "embedding",
                    F.coalesce("entities", F.array().cast("array<string>")).alias("entities"),
                    F.coalesce("entities_by_type", F.expr("cast(map() as map<string,array<string>>)")).alias("entities_by_type"),
                    F.coalesce("graph", F.struct(
                        F.array().cast(schemas.GRAPH["nodes"].dataType).alias("nodes"),
                        F.array().cast(schemas.GRAPH["relationships"].dataType).alias("relationships"))).alias("graph")))


def enrichment_summary(documents: DataFrame, enriched: DataFrame) -> DataFrame:
    read = documents.agg(F.count("*").alias("documents"))
    done = enriched.agg(
        F.count("*").alias("enriched"), F.coalesce(F.sum(F.size("entities")), F.lit(0)).alias("entities"),
        F.coalesce(F.sum(F.size("graph.relationships")), F.lit(0)).alias("relationships"))
    both = union_all(read, done).agg(*[F.max(c).alias(c) for c in ("documents", "enriched", "entities", "relationships")])
    return both.withColumn("avg_entities", F.round(F.coalesce(F.try_divide("entities", "enriched"), F.lit(0.0)), 6))


def service_counters(entities: DataFrame, texts: DataFrame, rel: DataFrame) -> DataFrame:
    """(service, counter, value): what each service found and what it kept.

    ``entities`` and ``rel`` have a confidence, kept when above their
    threshold; ``texts`` has clusters.  Each table is read once; empty
    tables count 0.
    """
    def sums(service, df, **counters):
        row = df.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in counters.items()])
        return row.select(F.lit(service).alias("service"), F.explode(F.create_map(
            *[x for n in counters for x in (F.lit(n), F.col(n))])).alias("counter", "value"))
    spans_of = F.aggregate("clusters", F.lit(0), lambda n, c: n + F.size(c))
    return union_all(
        sums("ner", entities, total_entities=F.count("*"), high_confidence_entities=F.count_if(F.col("confidence") > vocab.ENTITY_CONFIDENCE_MIN)),
        sums("coreference", texts.where(F.col("clusters").isNotNull()), clusters_found=F.sum(F.size("clusters")), total_mentions=F.sum(spans_of)),
        sums("relations", rel, total_relations_found=F.count("*"), high_quality_relations=F.count_if(F.col("confidence") > vocab.RELATION_CONFIDENCE_MIN)))


def entity_texts(nodes: DataFrame, *order: Column) -> DataFrame:
    """First text per entity: ``id - type [- description]``."""
    line = F.concat_ws(" - ", "id", "type", F.col("properties")["description"])
    first = nodes.groupBy("id").agg(F.min_by(line, F.struct(*order)).alias("entity_text"))
    return first


def node_embeddings(nodes: DataFrame, *order: Column, embed: Callable = vectors.embed_tokens) -> DataFrame:
    """One vector per distinct entity, from its first text."""
    texts = entity_texts(nodes, *order)
    return texts.select("id", "entity_text", embed(text.tokens(F.col("entity_text"))).alias("embedding"))


def consolidate(documents: DataFrame, entities: DataFrame, coreferences: DataFrame, rel: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """One record per document from the three services; missing parts are empty.

    ``processed_at`` stamps the records (a column of ``documents`` or a
    literal, so that reruns agree); without it they get the time of the query.
    """
    def empty(col, like):
        return F.coalesce(F.col(col), F.array().cast(like.schema[col].dataType)).alias(col)
    stamps = F.create_map(*[F.lit(x) for kv in vocab.MODEL_VERSIONS.items() for x in kv])
    return (documents.join(entities, "doc_num", "left").join(coreferences, "doc_num", "left").join(rel, "doc_num", "left")
            .select("doc_num", empty("entities", entities), empty("coreferences", coreferences), empty("relations", rel),
                    F.struct((F.current_timestamp() if processed_at is None else processed_at).cast("timestamp").alias("processing_timestamp"),
                             F.lit(vocab.NLP_PIPELINE_VERSION).alias("nlp_pipeline_version"),
                             stamps.alias("model_versions")).alias("processing_metadata")))
