"""Spans of names against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidings.operators import nlp, spans


def brute(docs, names):
    keys = {}
    for e, name in names:
        k = tuple(re.findall(r"[^\W_]+", (name or "").lower()))
        if k:
            keys.setdefault(k, set()).add((e, name))
    out = []
    for i, t in docs:
        low = (t or "").lower()
        words = list(re.finditer(r"[^\W_]+", low))
        at = 0
        while at < len(words):
            n = max((n for n in range(1, min(8, len(words) - at + 1)) if tuple(w[0] for w in words[at:at + n]) in keys), default=0)
            if n:
                own = keys[tuple(w[0] for w in words[at:at + n])]
                share = round(1 / len({e for e, _ in own}), 6)
                out += [(i, e, name, at, n, words[at].start(), words[at + n - 1].end(), share) for e, name in own]
            at += n or 1
    return sorted(out, key=str)


@pytest.mark.parametrize("bound", [10**6, 0])
def test_spans(spark, bound):
    rng = random.Random(4)
    words = ["a", "b", "c", "New", "York", "city", "é", "Ünal", "x9", "東京", "_"]
    docs = [(i, rng.choice([" ", "-", ", "]).join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    docs += [(900, None), (901, ""), (902, "new york " * 5000), (903, "NEW\nYORK, City new york"), (904, "..."), (905, "x a b c new york city")]
    names = [("n1", "New York"), ("n2", "New York City"), ("n3", "york city"), ("n4", "York"), ("n5", "new-york"), ("n5", "new york"), ("u", "ünal é"), ("t", "東京 a b c"),
             ("t2", "b c"), ("t3", "a b"), ("t4", "a b c new york city"), ("z", None), ("z", "..."), ("x", "X9"), ("x", "X9"), ("y", "c a b a")]
    got = spans.name_spans(spark.createDataFrame(docs, "doc_num long, content string"), spark.createDataFrame(names, "entity_id string, name string"), bound)
    want = brute(docs, names)
    assert rows(got) == want and len({r[4] for r in want}) > 3


@pytest.mark.parametrize("bound,lengths", [(10**6, 0), (10**6, 16), (20, 16), (3, 16), (0, 16)])
def test_many_names_few_of_them_present(spark, monkeypatch, bound, lengths):
    """Names held by tasks, names among the texts held by tasks, and joins; words beyond 16 bits and of late Unicode."""
    monkeypatch.setattr(spans, "LENGTHS", lengths)
    rng = random.Random(5)
    words = ["a", "B", "c", "\U00010400x", "\u1c8a", "\u0558", "東", "_", "é", "½"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(60)] + [(7, "a b c b c a"), (None, "c a b"), (61, None)]
    names = [("p", "a b"), ("q", "b c a"), ("r", "\U00010428x"), ("s", "東 é"), ("u", "½ a"), ("v", "a"), ("w", "½ a c"), *[(f"x{i}", f"never {i}") for i in range(30)]]
    frame = spark.createDataFrame(docs, "doc_num long, content string"), spark.createDataFrame(names, "entity_id string, name string")
    keys = {tuple(n.lower().split()) for _, n in names}
    want = []
    for d, t in docs:
        found, at = spans.regex.findall(r"[\p{L}\p{N}]+", (t or "").lower()), 0
        while at < len(found):
            n = max((n for n in (1, 2, 3) if tuple(found[at:at + n]) in keys and at + n <= len(found)), default=0)
            want += [(d, " ".join(found[at:at + n]), at)] if n else []
            at += n or 1
    got = spans.name_spans(*frame, bound)
    assert rows(got.select("doc_num", F.lower("name"), "first")) == sorted(want, key=str) and len({w[1] for w in want}) > 3
    gaz = frame[1].select(F.lower("name").alias("alias"), "entity_id", F.lit("Company").alias("type"))
    assert rows(spans.occurrences(frame[0], gaz, bound).select("doc_num", "alias", "pos")) == sorted(want, key=str)


def test_names_among_the_texts_are_looked_up_without_a_shuffle(spark):
    docs = spark.createDataFrame([(1, "new york x york"), (2, "york city")], "doc_num long, content string")
    gaz = spark.createDataFrame([("york", "e", "Agency"), *[(f"never {i}", "e", "Agency") for i in range(20)]], "alias string, entity_id string, type string")
    occ = spans.occurrences(docs, gaz, 5)
    assert "Exchange hashpartitioning" not in occ._jdf.queryExecution().executedPlan().toString() and occ.count() == 3


def test_no_names_or_texts(spark):
    docs = spark.createDataFrame([(1, "new york")], "doc_num long, content string")
    names = spark.createDataFrame([("n", "york")], "entity_id string, name string")
    assert spans.name_spans(docs, names.limit(0)).count() == 0
    assert spans.name_spans(docs.limit(0), names).count() == 0


def test_failure_links_find_names_inside_longer_ones():
    a = spans.Automaton(["a b c d", "b c", "c", "c x"])
    assert a.matches("a b c x a b c d".split()) == [(1, 2), (2, 2), (4, 4), (5, 2), (6, 1)]
    assert spans.leftmost(a.matches("a b c x a b c d".split())) == [(1, 2), (4, 4)]


@pytest.mark.parametrize("bound", [10**6, 0])
def test_occurrences_of_typed_aliases(spark, bound):
    docs = spark.createDataFrame([("d1", "New York, in York and new york city"), ("d2", None), ("d3", "in in")], "doc_num string, content string")
    gaz = spark.createDataFrame([("new york", "e1", "Agency"), ("york", "e2", "Company"), ("in", "e3", "Technology"), ("york city", "e4", "Company")], "alias string, entity_id string, type string")
    occ = spans.occurrences(docs, gaz, bound)
    assert rows(occ) == [("d1", 0, "new york", "e1", "Agency"), ("d1", 2, "in", "e3", "Technology"), ("d1", 3, "york", "e2", "Company"), ("d1", 5, "new york", "e1", "Agency"),
                         ("d3", 0, "in", "e3", "Technology"), ("d3", 1, "in", "e3", "Technology")]
    assert rows(nlp.mentions(occ)) == [("d1", "e1", "new york", "Agency", 2), ("d1", "e2", "york", "Company", 1), ("d1", "e3", "in", "Technology", 1), ("d3", "e3", "in", "Technology", 2)]


def test_texts_with_one_id_or_none_stay_apart_with_many_names(spark):
    docs = spark.createDataFrame([(1, "new york x york"), (1, "new york city"), (1, "new york x york"), (None, "x new"), (None, "york"), (1 << 60, "york " * 3)], "doc_num long, content string")
    gaz = spark.createDataFrame([("new york", "e1", "Agency"), ("york", "e2", "Company"), ("york city", "e4", "Company")], "alias string, entity_id string, type string")
    want = [(1, 0, "new york"), (1, 0, "new york"), (1, 0, "new york"), (1, 3, "york"), (1, 3, "york"), (None, 0, "york"), *[(1 << 60, i, "york") for i in range(3)]]
    assert rows(spans.occurrences(docs, gaz, 0).select("doc_num", "pos", "alias")) == sorted(want, key=str)
