"""I-Match fingerprints and language-model scores against brute force."""

import hashlib
import math
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import corpus, frame
from tidings.llm import imatch, lm

HELD = next(i for i in range(9000, 9100) if zlib.crc32(str(i).encode()) % 7 == 2)
WORD = r"[^\x20\x09-\x0D]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- I-Match ----------------------------------------------------------------------

def code(text, lex):
    found = sorted((t for t in set(re.findall(WORD, lower(text))) if t in lex), key=lambda t: t.encode())
    if not found:
        return "x:" + hashlib.sha256((text or "").encode()).hexdigest()[:16]
    scale = int(math.log2(len(found)))
    rows = []
    for s in (scale, scale + 1):
        lanes = []
        for k in range(imatch.LANES):
            picked = [t for t in found if (lex[t] >> (4 * k)) & ((1 << s) - 1) == 0]
            lanes.append(f"{xxhash.xxh64_intdigest(' '.join(picked).encode(), 42):X}".rjust(1)[:8] if picked else "-")
        rows.append(",".join(lanes))
    return f"{scale}:{rows[0]}:{rows[1]}"


def test_fingerprints_and_edits(spark):
    rows = [r for r in corpus() if r[0] != 5006] + [(None, "a null id")]
    df = frame(spark, rows)
    lex = {r.term: r.h & (1 << 64) - 1 for r in imatch.lexicon(df).collect()}
    n, seen = len(rows), {}
    for _, t in rows:
        for w in set(re.findall(WORD, lower(t))):
            seen[w] = seen.get(w, 0) + 1
    assert lex.keys() == {w for w, c in seen.items() if max(2, n / imatch.RARE) <= c <= max(2, n / imatch.COMMON)}
    assert all(v == xxhash.xxh64_intdigest(k.encode(), 42) for k, v in lex.items())
    got = {r.doc_id: r for r in imatch.compare_edits(df).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        t, after, r = t or "", after or "", got[i]
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (code(t, lex), code(edited, lex))
        assert 0 <= r.near_edited <= 1 and (r.near_edited == 1 or r.fingerprint != r.edited_fingerprint)
        assert (r.near_next == 1) >= (r.fingerprint == code(after, lex))
    plain = {r.doc_id: r.fingerprint for r in imatch.fingerprints(df).collect()}
    assert plain == {i: r.fingerprint for i, r in got.items()}


def test_neighbours_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(imatch, "BLOCK_DOCS", 3)
    rows = [(i * i * i - 50, f"text {i}") for i in range(40)]
    got = sorted(imatch.with_next(frame(spark, rows)).select("doc_id", "next_text").collect())
    assert [r.next_text for r in got] == [f"text {(i + 1) % 40}" for i in range(40)]
    one = imatch.with_next(frame(spark, [(1, "alone")])).collect()
    assert [(r.text, r.next_text) for r in one] == [("alone", "alone")]


def test_likeness(spark):
    rows = [("2:A,B,-:A,-,-", "2:A,C,-:A,-,-", 0.5), ("2:A,B,-:C,-,-", "3:C,D,-:x,-,-", 0.5), ("x:1", "x:1", 1.0), ("x:1", "x:2", 0.0), ("2:A:B", "5:A:B", 0.0)]
    df = spark.createDataFrame(rows, "a string, b string, want double")
    assert df.where(imatch.likeness(F.col("a"), F.col("b")) != F.col("want")).count() == 0


def test_imatch_empty(spark):
    assert imatch.compare_edits(frame(spark, [])).count() == 0


# --- language model ---------------------------------------------------------------

def brute(rows):
    def held(i):
        return i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    docs = [(i, re.findall(WORD, lower(t)) + [None]) for i, t in rows]
    uni, bi = {}, {}
    for i, w in docs:
        if not held(i):
            for k, x in enumerate(w):
                uni[x] = uni.get(x, 0) + 1
                if k:
                    bi[w[k - 1], x] = bi.get((w[k - 1], x), 0) + 1
    n, v = sum(uni.values()), len(uni)
    out = {}
    for i, w in docs:
        base = score = 0.0
        for k, x in enumerate(w):
            p = (uni.get(x, 0) + 1) / (n + v + 1)
            base += math.log10(p)
            if k and w[k - 1] in uni:
                p = lm.TRUST * bi.get((w[k - 1], x), 0) / uni[w[k - 1]] + (1 - lm.TRUST) * p
            score += math.log10(p)
        out[i] = (held(i), len(w), sum(x in uni for x in w), n, base, score)
    return out


@pytest.mark.parametrize("flush", [50, 300_000])
def test_scores(spark, monkeypatch, flush):
    monkeypatch.setattr(lm, "FLUSH", flush)
    rows = [r for r in corpus() if r[0] != 5006] + [(None, "a null id"), (HELD, "held out Words unseen")]
    want = brute(rows)
    got = lm.score(frame(spark, rows)).collect()
    assert len(got) == len(rows) and any(r.held_out for r in got) and any(r.n_known < r.n_tokens for r in got)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert math.isclose(r.base_score, w[4], rel_tol=1e-9) and math.isclose(r.score, w[5], rel_tol=1e-9)


def test_arcs_of_a_state_sum_to_one():
    import pandas as pd
    import numpy as np
    assert not lm.held_out(3)
    c = lm.Chunk(pd.DataFrame({"doc_id": [3], "text": ["a b a c a b d"]}))
    words, pairs = (x.astype(float) for x in c.counts())
    total, known = int(words.sum()), len(words)
    m = lm.Automaton(c, words, pairs, total, known)
    rest = 1 / (total + known + 1)
    p = 10 ** np.array(m.root)
    assert math.isclose(p.sum() + rest, 1)
    for h in range(known):
        if h != int(c.ids[-1]):
            arcs = sum(10 ** m.arcs[h * known + w] if h * known + w in m.arcs else 10 ** m.fail * p[w] for w in range(known))
            assert math.isclose(arcs + 10 ** m.fail * rest, 1)


def test_lm_empty(spark):
    assert lm.score(frame(spark, [])).count() == 0
