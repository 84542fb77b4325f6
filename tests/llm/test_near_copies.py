"""Near copies of the pipeline against exact similarity of five-word shingles."""

from itertools import combinations

import numpy as np
import pandas as pd

from tests.llm.helpers import corpus, frame, vocabulary
from tidings.llm import nearcopies, simhash


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def kept(rows):
    """Smallest doc_id of every group linked by a similarity of 0.8 or more."""
    label, own = {i: i for i, _ in rows}, {i: shingles(t) for i, t in rows}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for a, b in combinations(sorted(own), 2):
        if own[a] == own[b] or (own[a] and 5 * len(own[a] & own[b]) >= 4 * len(own[a] | own[b])):
            x, y = sorted((root(a), root(b)))
            label[y] = x
    return sorted({root(i) for i in own})


def edited(words, *places):
    return " ".join(f"new{i}" if i in places else w for i, w in enumerate(words))


def test_pairs_of_known_similarity(spark):
    w = vocabulary(104)
    cases = {(50,): 95 / 105, (20, 80): 90 / 110, tuple(range(93, 104)): 89 / 111, tuple(range(92, 104)): 88 / 112, (20, 50, 80): 85 / 115}
    for places, similarity in cases.items():
        rows = [(1, " ".join(w)), (2, edited(w, *places))]
        a, b = (shingles(t) for _, t in rows)
        assert abs(len(a & b) / len(a | b) - similarity) < 1e-9
        assert nearcopies.keep_one(frame(spark, rows)).count() == (1 if similarity >= 0.8 else 2), places


def test_groups_match_brute_force(spark):
    words = vocabulary(500)
    chain = [(9000 + i, " ".join(words[5 * i:5 * i + 104])) for i in range(70)]     # only neighbours are similar
    crowd = [(9500 + i, edited(words[200:304], i, 104 - i)) for i in range(5, 45)]  # all edited, at other places
    rows = [(i, t) for i, t in corpus(40) if i != 5006] + chain + crowd
    got = nearcopies.keep_one(frame(spark, rows))
    assert sorted(r.doc_id for r in got.collect()) == kept(rows)
    assert got.columns == frame(spark, []).columns


def test_repeated_and_null_ids(spark):
    w = vocabulary(208)
    a, b = w[:104], w[104:]
    rows = [(1, " ".join(a)), (1, " ".join(a)), (None, edited(a, 3)), (1, edited(a, 4)), (7, edited(a, 5)),
            (None, " ".join(b)), (None, edited(b, 3)), (8, None), (None, ""), (8, " ")]
    got = nearcopies.keep_one(frame(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "8", "None"]
    same = [(1, " ".join(a)), (1, " ".join(a)), (None, " ".join(a)), (None, " ".join(b)), (None, " ".join(b))]
    assert sorted(str(r.doc_id) for r in simhash.keep_first(frame(spark, same)).collect()) == ["1", "None"]
    assert nearcopies.keep_one(frame(spark, [])).count() == 0


def test_trie_links_share_a_bucket(spark):
    fps = {1: 0, 2: 3, 3: 15, 4: 255 << 30, 5: 255 << 30, 6: -1, 7: 0}      # 1, 2 and 3 differ by two bits in turn; 7 has no words
    got = {r.node: r.bucket for r in nearcopies.trie_buckets(spark.createDataFrame([(i, 0 if i == 7 else 9, fp) for i, fp in fps.items()], "node long, n long, fp long")).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6] and len(set(got.values())) == 3
    assert got[1] == got[2] == got[3] and got[4] == got[5]


def test_fingerprints_of_edited_texts_meet_in_the_trie(spark):
    w = vocabulary(1200)
    rows = [(1, " ".join(w[:1100])), (2, " ".join(w[:1100] + ["x"])), (3, " ".join(w[900:]))]
    coded = next(nearcopies._signed([frame(spark, rows).selectExpr("doc_id AS _row", "doc_id", "text").toPandas()]))
    texts = spark.createDataFrame([(int(r.doc_id), int(r.n), int(r.fp)) for r in coded.itertuples()], "node long, n long, fp long")
    buckets = {r.node: r.bucket for r in nearcopies.trie_buckets(texts).collect()}
    assert buckets[1] == buckets[2] != buckets[3]


def test_every_pair_of_a_bucket_is_counted():
    rng = np.random.default_rng(5)
    base = rng.choice(10_000, 200, replace=False)
    own = [np.unique(np.concatenate([base[:200 - k], 20_000 + 300 * k + np.arange(k)])) for k in range(0, 60, 3)] + [np.arange(50_000 + 9 * i, 50_180 + 9 * i) for i in range(30)]
    n = [len(x) for x in own]
    # no two nodes show equal minima: the exact count alone decides
    pdf = pd.DataFrame({"bucket": 1, "node": range(len(own)), "n": n, "side": 0, "label": range(len(own)), "own": own, "sig": [rng.bytes(80) for _ in own]})
    got = nearcopies._linked(pdf)
    near = [(i, j) for i, j in combinations(range(len(own)), 2) if 5 * (c := len(np.intersect1d(own[i], own[j]))) >= 4 * (n[i] + n[j] - c)]

    def parts(pairs):
        label = list(range(len(own)))
        for i, j in pairs:
            label = [label[i] if x == label[j] else x for x in label]
        return [[i for i, x in enumerate(label) if x == y] for y in sorted(set(label))]
    assert near and sorted(parts(near)) == sorted(parts(zip(got["u"], got["v"], strict=True)))


def test_parts_of_a_large_bucket_all_meet(spark, monkeypatch):
    monkeypatch.setattr(nearcopies, "CROWD", 8)
    asked = spark.createDataFrame([(b, 100 * b + i, 9) for b, size in ((1, 30), (2, 5)) for i in range(size)], "bucket long, node long, n long")
    dealt = nearcopies._parted(asked).toPandas()
    met = [tuple(sorted(p)) for _, g in dealt.groupby("bucket") for p in combinations(zip(g["node"], g["side"], strict=True), 2)
           if g["side"].nunique() == 1 or p[0][1] != p[1][1]]
    met = sorted((a[0], b[0]) for a, b in met)
    assert met == sorted(p for b, size in ((1, 30), (2, 5)) for p in combinations(range(100 * b, 100 * b + size), 2))
    assert dealt.groupby("bucket").size().max() < 30
