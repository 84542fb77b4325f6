"""Line de-duplication, spelling variants and phrases against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.llm.helpers import corpus, frame, vocabulary
from tidings.llm import lines, phrases, spelling


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def clashing(df, *names):
    for n in names:
        df = df.withColumn(n, F.lit("?"))
    return df


# --- lines ------------------------------------------------------------------------

def line_key(line):
    return low(line.strip(" \t\n\x0b\x0c\r"))


def lines_left(table):
    held = defaultdict(set)
    for i, t in table:
        for x in (t or "").split("\n"):
            if len(line_key(x)) >= 20:
                held[line_key(x)].add(-1 if i is None else i)
    gone = {k: max(v) for k, v in held.items() if len(v) >= 3}
    out = []
    for i, t in table:
        cut = (t or "").split("\n")
        kept = [x for x in cut if line_key(x) not in gone or gone[line_key(x)] == (-1 if i is None else i)]
        out.append((i, "\n".join(kept), len(cut), len(cut) - len(kept)))
    return sorted(out, key=str)


LINE = "All rights are reserved, É"
LINES = [
    (1, f"{LINE}\nfirst\n\t {LINE.lower()} \x0b\nend\n"), (2, f"x\n{LINE}\r\n"), (9, f"{LINE}\n{LINE}\nlast"), (9, f"again\n{LINE}"), (None, LINE), (None, f"a\n{LINE}\nb"),
    (3, "only in two documents, so it stays"), (4, "only in two documents, so it stays"), (4, "only in two documents, so it stays"),
    (5, "nineteen code point"), (6, "nineteen code point"), (7, "nineteen code point"), (20, "é" * 20), (21, "É" * 20), (22, "é" * 20), (23, "é" * 20),
    (10, None), (11, ""), (12, "\n\n\n"), (13, "nothing else but this line here"), (14, "nothing else but this line here"), (15, "nothing else but this line here"),
    (30, "\n".join(f"line number {k % 3000} of a long text" for k in range(20_000))), (31, "line number 5 of a long text"), (32, " line number 5 of a long text\nline number 5 of a long text"),
    (-5, "negative ids are ids like any other"), (-6, "negative ids are ids like any other"), (-7, "negative ids are ids like any other"),
]


@pytest.mark.parametrize("bound", [lines.BROADCAST_LINES, 0])
def test_lines(spark, monkeypatch, bound):
    monkeypatch.setattr(lines, "BROADCAST_LINES", bound)
    table = LINES + corpus(40)
    got = lines.dedup(clashing(frame(spark, table), "_row", "pos", "line", "h1", "last", "drop"))
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert rows(got) == lines_left(table)


def test_lines_empty(spark):
    assert lines.dedup(frame(spark, [])).count() == 0


def test_lines_of_one_document_are_one(spark):
    assert rows(lines.dedup(frame(spark, [(1, "\n".join([LINE] * 5)), (2, LINE)]))) == [(1, "\n".join([LINE] * 5), 5, 0), (2, LINE, 1, 0)]


# --- spelling ---------------------------------------------------------------------

def edits(w, letters):
    cut = {w[:i] + w[i + 1:] for i in range(len(w))}
    put = {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
    new = {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
    return (cut | put | new) - {w}


def spelled(table):
    n = Counter()
    for i, t in table:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = low(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    letters, out = set("".join(n)), {}
    for w in n:
        near = edits(w, letters) & set(n) if len(w) < 100 else {v for v in n if abs(len(v) - len(w)) <= 1 and v in edits(w, letters)}
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form = best if best and n[best] >= 10 * n[w] else None
        out[w] = (form, len(near), n[form] if form else None)
    table = []
    for w, (form, k, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        table.append((w, form, root, n[w], k, form_n))
    return sorted(table, key=str)


def misspelled():
    out = [(7, None), (8, ""), (9, "short wor7ds only"), (None, "nameless nameless"), (None, "nameless")]
    words = [w * 2 for w in vocabulary(30, 5) if len(w) >= 4]
    for k, w in enumerate(words):
        out += [(100 * k + j, f"{w} {w}, {w}-{w}") for j in range(60)]
        out += [(100 * k + 70, f"{w[:3]}é{w[3:]} {w[1:]} {w}x;{w}x {w[:4]}É{w[5:]}" * 2)]
    # a chain of forms, and ties for the most frequent neighbour
    out += [(9000 + j, "chained " * 40) for j in range(60)] + [(9100, "chaineds " * 100 + "chainedsx " * 5 + "chaiwed " * 2)]
    out += [(9200, "tieding " * 50 + "tiedinx " * 50 + "tiediny " * 3), (9201, "aaaaaaa " * 30 + "aaaaaaaa " * 3 + "aaaaaaaaa " * 2)]
    return [*out, (9300, ("q" * 3000 + " ") * 20 + ("q" * 2999 + "z ") * 2), (9300, "chained"), (9300, "chained")]


def test_spelling(spark):
    table = misspelled() + corpus(30)
    docs = clashing(frame(spark, table), "word", "n", "code", "_run", "_h")
    got = spelling.variants(spelling.vocabulary(docs))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = spelled(table)
    assert rows(got) == want
    assert any(r[1] and r[2] != r[1] for r in want)


def test_spelling_empty(spark):
    assert spelling.variants(spelling.vocabulary(frame(spark, []))).count() == 0
    assert spelling.variants(spelling.vocabulary(frame(spark, [(1, None), (2, "")]))).count() == 0


def test_neighbourhood_is_whole():
    """Every reduced word one symbol apart has its hash in the neighbourhood, and nothing else has."""
    own = np.array([[1, 3, 3, 8]], np.uint64)
    base = [1, 3, 3, 8]
    symbols = range(1, spelling.SYMBOLS + 1)
    want = {tuple(base)} | {tuple(base[:i] + base[i + 1:]) for i in range(4)}
    want |= {tuple(base[:i] + [c] + base[i + 1:]) for i in range(4) for c in symbols}
    want |= {tuple(base[:i] + [c] + base[i:]) for i in range(5) for c in symbols}
    hashes = {int(spelling.own_hash(np.array([w], np.uint64))[0]) for w in want}
    assert hashes == set(map(int, spelling.neighbourhood(own)[0]))


# --- phrases ----------------------------------------------------------------------

def mined(table, least, top):
    n, f = Counter(), defaultdict(Counter)
    for lang, t in table:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low(t or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang in n:
        found, scored = f[lang], []
        cand = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        covered = {p[i:j] for p, a in cand.items() for i in range(len(p)) for j in range(i + 1, len(p) + 1) if j - i < len(p) and a >= found[p[i:j]]}
        for p, a in cand.items():
            score, _, left, right = min((1000 * a * n[lang] // (found[p[:k]] * found[p[k:]]), k, found[p[:k]], found[p[k:]]) for k in range(1, len(p)))
            if p not in covered:
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -score) for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def spoken():
    table = corpus(60)
    table += [(6000 + i, "New York City; new york\tcity, new york.\rthe the the the the the") for i in range(40)]
    table += [(6100 + i, "im Übrigen gilt dies\nim übrigen gilt das : im Übrigen\x0bgilt \x01 \x1f\x00   im gilt") for i in range(30)]
    return [*table, (6200, "a b " * 30_000), (6201, " \t,,;"), (6000, "new york city"), (6000, "new york city")]


@pytest.mark.parametrize(("bound", "sample", "ease"), [(10**6, 8, 0.5), (0, 8, 0.5), (10**6, 1, 1.0), (10**6, 8, 50.0)])
def test_phrases(spark, bound, sample, ease):
    """Alike with a trie, with joins, with a sample that is all documents, and with one that proposes next to nothing."""
    table = spoken()
    docs = clashing(frame(spark, table), "phrase", "n", "since", "a", "l", "r", "rank", "w")
    langs = [(r.lang or "und", r.text) for r in docs.collect()]
    got = phrases.mine(docs, 12, 40, sample=sample, ease=ease, bound=bound)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert rows(got) == mined(langs, 12, 40)


def test_tasks_send_counts_on(spark, monkeypatch):
    """Tiny limits of what a task holds change nothing."""
    counts = phrases._Counts(phrases.Trie().add(1, [(["en", "en", "fr"], ["a", "b", "a"], [0, 0, 0])]).add(2, [(["en"], ["a b"], [0])]), 0)
    total = Counter()

    def gather():
        for batch in counts.take():
            for row in batch.to_pylist():
                lang, phrase = (x[0] for x in counts.trie.phrases(np.array([row["code"]]))) if row["code"] is not None else (row["lang"], row["phrase"])
                total[lang, phrase] += row["n"]

    for i in range(50):
        counts.add("en", b"a b a b c. A b" if i % 2 else b"a b, a")
        if i % 7 == 0:
            counts.look_up()
        if i % 10 == 0:
            gather()
    gather()
    assert total == {("en", "a"): 125, ("en", "b"): 100, ("en", "c"): 25, ("en", ""): 250, ("en", "a b"): 100, ("en", "b a"): 25}


def test_products_beyond_64_bits(spark):
    big = 9 * 10**15
    found = spark.createDataFrame([("en", "", 10**17), ("en", "a", big), ("en", "b", big + 1), ("en", "a b", big - 1)], "lang string, phrase string, n long")
    assert rows(phrases.collocations(found)) == [("en", 1, "a b", big - 1, big, big + 1, 10**17, 1000 * (big - 1) * 10**17 // (big * (big + 1)))]


def test_phrases_empty(spark):
    assert phrases.mine(frame(spark, [])).count() == 0
    assert phrases.mine(frame(spark, [(1, None)])).count() == 0
