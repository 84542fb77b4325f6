import random
import re

import pandas as pd
from pyspark.sql import functions as F

from conftest import rows
from tidings import schemas, vocab
from tidings.functions import text
from tidings.operators import nlp

SENTENCES = [
    (1, "Raytheon partners with Boeing"), (2, "DARPA funds Acme"), (3, "Acme acquires Beta"), (4, "Acme develops radar system"),
    (5, "Acme awarded a contract"), (6, "Nothing to see"), (7, "$5 million from DARPA to Acme"), (8, "A buys B. C purchased D"),
]


def test_relation_rules(spark):
    got = nlp.relations(spark.createDataFrame(SENTENCES, "id long, text string"), "id")
    assert rows(got.select("id", "source_entity", "target_entity", "relation_type", "evidence_text")) == sorted([
        (1, "Raytheon", "Boeing", "PARTNERSHIP", "Raytheon partners with Boeing"),
        (2, "DARPA", "Acme", "FUNDING_RELATIONSHIP", "DARPA funds Acme"),
        (3, "Acme", "Beta", "ACQUISITION", "Acme acquires Beta"),
        (4, "Acme", "radar system", "TECHNOLOGY_DEVELOPMENT", "Acme develops radar system"),
        (7, "$5 million", "DARPA", "FUNDING_RELATIONSHIP", "$5 million from DARPA to Acme"),
        (8, "A", "B", "ACQUISITION", "A buys B"), (8, "C", "D", "ACQUISITION", "C purchased D")], key=str)


def test_relation_rules_match_the_patterns_themselves(spark):
    """Against the patterns as published, in another regex engine, on odd texts."""
    rng = random.Random(5)
    bits = ["A", "B2", "and", "&", "partners with", "partner", "team up", "acquires", "bought by", "develops", "a system", "x platform", ".", ",", "\n", "  ",
            "DARPA", "funds", "$5,000", "$3 million", "from", "to", "specializes in", "contract"]
    texts = [(i, " ".join(rng.choice(bits) for _ in range(rng.randint(1, 25)))) for i in range(400)]
    want = set()
    for i, t in texts:
        for kind, p in vocab.RELATION_PATTERNS:
            if p.count("(") - p.count("(?:") >= 2:
                want |= {(i, m[1].strip(" "), m[2].strip(" "), kind, m[0]) for m in re.finditer(p, t, re.IGNORECASE | re.ASCII)}
    got = nlp.relations(spark.createDataFrame(texts, "id long, text string"), "id")
    assert {tuple(r) for r in got.select("id", "source_entity", "target_entity", "relation_type", "evidence_text").collect()} == want and len(want) > 100


def test_relation_rules_on_a_long_run_of_words(spark):
    run = "word " * 20_000
    got = nlp.relations(spark.createDataFrame([(1, run + "acquires " + run), (2, run + "develops " + run), (3, run + "partners with")], "id long, text string"), "id")
    assert [(r.id, len(r.source_entity), len(r.target_entity)) for r in got.collect()] == [(1, len(run) - 1, len(run) - 1)]


def test_alias_mentions_of_any_form(spark):
    docs = spark.createDataFrame([(1, "the new york times of new york"), (2, "times"), (3, None)], "doc_num long, t string").select("doc_num", text.tokens(F.col("t")).alias("tokens"))
    names = spark.createDataFrame([("a", "New-York"), ("b", "New York Times"), ("c", "of"), ("d", "!"), ("e", "Été")], "entity_id string, name string")
    assert rows(nlp.alias_mentions(docs, names)) == [(1, "a", "New-York", 2), (1, "b", "New York Times", 1), (1, "c", "of", 1)]


def resolve(spark, text, clusters):
    df = spark.createDataFrame([(text, clusters)], f"text string, clusters {schemas.CLUSTERS.simpleString()}")
    return df.select(nlp.resolve_coreferences(F.col("text"), F.col("clusters"))).first()[0]


def test_coreference_replaces_only_the_mentions(spark):
    text = "Acme Corp said it sells bits. It grew."
    assert resolve(spark, text, [[(0, 9), (15, 17), (30, 32)]]) == "Acme Corp said Acme Corp sells bits. Acme Corp grew."
    assert resolve(spark, text, [[(0, 9)]]) == text
    assert resolve(spark, text, [[(0, 9), (18, 23)]]) == text          # not a pronoun
    assert resolve(spark, "Élan: its été", [[(0, 4), (6, 9)]]) == "Élan: Élan été"
    assert resolve(spark, text, None) == text


def test_default_clusters(spark):
    df = spark.createDataFrame([(1, "It is a machine; they like its parts")], "id long, text string")
    c = df.select(nlp.pronoun_clusters("text").alias("c")).first().c
    assert [[tuple(s) for s in g] for g in c] == [[(8, 15), (0, 2), (17, 21), (27, 30)]]
    none = spark.createDataFrame([(None,), ("",), (" - ",)], "text string").select(F.size(nlp.pronoun_clusters("text")).alias("n"))
    assert [r.n for r in none.collect()] == [0, 0, 0]


def test_failed_batch_is_reported_and_others_go_on(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "bad")], "doc_num long, text string").repartition(2, "doc_num")

    def extract(pdf: pd.DataFrame) -> pd.DataFrame:
        if (pdf["text"] == "bad").any():
            raise ValueError("boom")
        return pd.DataFrame({"doc_num": pdf["doc_num"], "entity": pdf["text"]})

    got = {r.doc_num: (r.entity, r.error) for r in nlp.run_extractor(df, extract, "doc_num long, entity string").collect()}
    assert got[1] == ("ok", None) or got[1][1] is not None
    assert got[2][1] == "ValueError: boom"


def test_entities_by_type_and_agencies(spark):
    found = spark.createDataFrame([(1, "x", "Agency"), (1, "y", "Organization"), (1, "z", "Company")], "doc_num long, alias string, type string")
    row = nlp.entities_by_type(found).select("entities", *nlp.typed_arrays(F.col("entities_by_type"))).first()
    assert (row.entities, row.companies, row.technologies, row.agencies) == (["x", "y", "z"], ["z"], [], ["x", "y"])


def test_entity_text_first_description_wins(spark):
    nodes = spark.createDataFrame([("a", "Company", {"description": "late"}, 2), ("a", "Agency", {}, 1)], "id string, type string, properties map<string,string>, at int")
    assert rows(nlp.entity_texts(nodes, F.col("at"))) == [("a", "a - Agency")]


def test_consolidate_fills_missing_parts(spark):
    docs = spark.createDataFrame([(1,), (2,)], "doc_num long")
    ents = spark.createDataFrame([(1, ["a"])], "doc_num long, entities array<string>")
    cor = spark.createDataFrame([], "doc_num long, coreferences array<string>")
    rel = spark.createDataFrame([(2, ["r"])], "doc_num long, relations array<string>")
    out = {r.doc_num: r for r in nlp.consolidate(docs, ents, cor, rel).collect()}
    assert out[1].entities == ["a"] and out[1].relations == [] and out[2].coreferences == []
    assert out[1].processing_metadata.nlp_pipeline_version == "1.0"


def test_service_counters(spark):
    scored = spark.createDataFrame([(0.7,), (0.71,), (0.2,), (None,)], "confidence double")
    texts = spark.createDataFrame([("The radar failed. It was old, its mast bent.",), ("",), (None,), ("alone",)], "text string")
    texts = texts.select(nlp.pronoun_clusters("text").alias("clusters"))
    got = {(r.service, r.counter): r.value for r in nlp.service_counters(scored, texts, scored).collect()}
    assert got == {("ner", "total_entities"): 4, ("ner", "high_confidence_entities"): 1, ("coreference", "clusters_found"): 2,
                   ("coreference", "total_mentions"): 4, ("relations", "total_relations_found"): 4, ("relations", "high_quality_relations"): 2}
    none = nlp.service_counters(scored.limit(0), texts.limit(0), scored.limit(0)).collect()
    assert len(none) == 6 and all(r.value == 0 for r in none)
