"""SimHash, substrings and decontamination against brute force."""

import hashlib
import re

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import corpus, frame
from tidings.llm import components, decontaminate, simhash, substrings


# --- substrings -------------------------------------------------------------------

def removed(rows, window):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in docs:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            least[key] = min(least.get(key, 1 << 62), 1 << 61 if i is None else i)
    out = []
    for i, w in docs:
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k:k + window])] < (1 << 61 if i is None else i):
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("window", "gram"), [(50, 16), (8, 3)])
def test_substrings(spark, window, gram):
    rows = corpus() + [(7777, "null id " * 40), (None, "null id " * 40), (3, dict(corpus())[3])]
    got = substrings.dedup(frame(spark, rows), window, gram, texts=True).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got], key=str) == removed(rows, window)
    for r in got:
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed
        assert hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256


def test_substrings_empty(spark):
    assert substrings.dedup(frame(spark, [])).count() == 0


# --- SimHash ------------------------------------------------------------------------

def fingerprint(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split()
    s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, radius=2):
    """Smallest doc_id reachable, by repeated relaxation over all pairs."""
    label = dict(fps.keys().__iter__() and {i: i for i in fps})
    changed = True
    while changed:
        changed = False
        for i in fps:
            for j in fps:
                if (fps[i] ^ fps[j]).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_near_duplicates(spark):
    rows = corpus(40)
    fps = {i: fingerprint(t) for i, t in rows}
    want = classes(fps)
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fps[i]:016x}", want[i]) for i in fps}
    assert len(got) == len(rows)
    others = set(fps.values())
    for r in got:
        f = int(r.fingerprint, 16)
        assert r.links == sum(g != f and (f ^ g).bit_count() <= 2 for g in others)
    kept = simhash.keep_first(frame(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert kept.columns == frame(spark, []).columns


def test_near_duplicates_null_and_empty(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    got = simhash.near_duplicates(frame(spark, [(None, "a b c d"), (4, "a b c d"), (4, "a b c d")])).collect()
    assert [(r.component_id, r.copies) for r in got] == [(4, 3)] * 3


def clustered(n, seed=5):
    """Distinct fingerprints, many of them a few bits apart and crowded in one subtree."""
    rng = np.random.default_rng(seed)
    keys = set(rng.integers(0, 1 << 63, n // 2, dtype=np.uint64).tolist())
    for base in list(keys)[:8] + [0, (1 << 64) - 1]:
        x = base
        for _ in range(n // 20):
            x ^= 1 << int(rng.integers(0, 64))
            keys.add(x)
            keys.add(x ^ (1 << int(rng.integers(0, 8))))
    return np.array(sorted(keys), np.uint64)


def test_walk_finds_all_pairs():
    a = clustered(600)
    want = {(i, j) for i in range(len(a)) for j in range(i + 1, len(a)) if int(a[i] ^ a[j]).bit_count() <= 2}
    got = [p for i, j in simhash.walk(a, a, True, 63) for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert set(got) == want and len(got) == len(want)
    b, c = a[::2], a[1::2]
    got = {p for i, j in simhash.walk(b, c, False, 63) for p in zip(i.tolist(), j.tolist(), strict=True)}
    assert got == {(i, j) for i in range(len(b)) for j in range(len(c)) if int(b[i] ^ c[j]).bit_count() <= 2}


def test_trie_rounds_lose_no_link(spark, monkeypatch):
    """Subtrees far below the production size: several distributed rounds."""
    monkeypatch.setattr(simhash, "SUBTREE", 40)
    a = clustered(600)
    n = len(a)
    want = {}
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(n):
        for j in range(i + 1, n):
            if int(a[i] ^ a[j]).bit_count() <= 2:
                want[i], want[j] = want.get(i, 0) + 1, want.get(j, 0) + 1
                up[max(root(i), root(j))] = min(root(i), root(j))
    signed = a.view(np.int64).tolist()
    found = simhash.trie_links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    links = {r[0]: r[1] for r in found.groupBy("u").sum("links").collect()}
    assert links == {signed[i]: k for i, k in want.items()}
    label = {r.node: r.label for r in components.components(found.select("u", "v")).collect()}
    groups = {}
    for i in range(n):
        groups.setdefault(root(i), set()).add(signed[i])
    for g in groups.values():
        assert len({label.get(x, x) for x in g}) == 1
    assert len({label.get(x, x) for x in signed}) == len(groups)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)} | {201: 200}


# --- decontamination ------------------------------------------------------------------

def similarity(a, b):
    from collections import Counter
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / sum((a | b).values())


def bag(words, n=5):
    n = min(n, len(words))
    return [tuple(words[i:i + n]) for i in range(len(words) - n + 1)] if n else []


def brute(docs, items):
    out = {}
    for d, text in docs:
        w = re.findall(r"\w+", (text or "").lower())
        for k, item in items:
            v = re.findall(r"\w+", (item or "").lower())
            b = bag(v)
            if not b or len(w) < len(v) or (len(v) < 5 and len(w) != len(v)):
                continue
            best = max(similarity(bag(w[s:s + len(v)]), b) for s in range(len(w) - len(v) + 1))
            if best >= 0.8:
                out[d, k] = best
    return out


def test_contaminated(spark):
    rows = [r for r in corpus(30) if r[0] != 5006]
    texts = dict(rows)
    words = texts[4].split() + texts[6].split()
    items = [(1, " ".join(words[:30])), (2, " ".join(words[40:75]).upper()), (3, ""), (4, None), (5, "never seen words in any of these texts here"),
             (6, "one"), (7, " ".join(words[:30]))]
    near = words[:30]
    near[28:28] = ["inserted"]
    wrong = words[40:75]
    wrong[1] = "wrong"
    far = [w if i % 6 else "gap" for i, w in enumerate(words[40:75])]
    rows += [(8000, "start " + " ".join(near) + " end"), (8001, ", ".join(wrong)), (8002, " ".join(far)), (8003, " ".join(words[:30] * 3)), (None, " ".join(words[:30]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(frame(spark, rows), bench).collect()}
    want = brute(rows, items)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert {(8000, 1), (8001, 2), (8003, 1), (8003, 7), (5003, 6)} <= got.keys() and 8002 not in {d for d, _ in got}
    kept = decontaminate.keep_clean(frame(spark, rows), bench)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in rows if d is None or d not in {x for x, _ in want})
    assert decontaminate.contaminated(frame(spark, []), bench).count() == 0
    assert decontaminate.contaminated(frame(spark, rows), bench.limit(0)).count() == 0


def test_items_in_several_passes(spark, monkeypatch):
    rows = [r for r in corpus(20) if r[0] != 5006]
    bench = spark.createDataFrame([(i, " ".join((t or "").split()[:40])) for i, t in rows], "item_id long, text string")
    one = decontaminate.contaminated(frame(spark, rows), bench).collect()
    monkeypatch.setattr(decontaminate, "ITEMS", 7)
    assert sorted(decontaminate.contaminated(frame(spark, rows), bench).collect(), key=str) == sorted(one, key=str) and one


def test_blocks_find_all_within_radius():
    index = decontaminate.Index([(1, " ".join(f"w{i}" for i in range(30)))])
    rng = np.random.default_rng(2)
    for _ in range(300):
        fp = int(index.fps[0])
        for b in rng.choice(64, decontaminate.RADIUS, replace=False):
            fp ^= 1 << int(b)
        assert index.candidates(26, fp) == [0]


def test_texts_shorter_than_the_item(spark):
    words = [f"w{i}" for i in range(30)]
    rows = [(n, " ".join(words[:n])) for n in range(20, 31)] + [(100 + n, " ".join(words[30 - n:])) for n in range(20, 30)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, "never seen words in any of these texts here")], "item_id long, text string")
    got = {r.doc_id: r.similarity for r in decontaminate.contaminated(frame(spark, rows), bench).collect()}
    want = {i: similarity(bag(t.split()), bag(words)) for i, t in rows}
    assert got == pytest.approx({i: s for i, s in want.items() if s >= 0.8})
    assert 28 in got and 129 in got and 24 not in got


def test_repeated_and_null_keys(spark):
    item, other, clean = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    bench = spark.createDataFrame([(1, item), (None, other)], "item_id long, text string")
    rows = [(None, item), (None, clean), (4, item), (4, clean), (5, other), (6, clean), (6, clean)]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame(spark, rows), bench).collect()}
    assert got == {(None, 1), (4, 1), (5, None)}
    kept = decontaminate.clean_rows(frame(spark, rows), bench)
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted((str(d), clean) for d in (None, 4, 6, 6))
    assert kept.columns == frame(spark, []).columns
