"""URL rules and WARC archives."""

import base64
import gzip
import hashlib
import random
import re
from itertools import combinations

import pytest

from tidings.llm import urls, warc

URLS = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x=1", "example.org/es/1", None, "", "http://x.org", "http://x.org/", "http://borg/",
        "ftp://b.com/fr/", "http://com/de/x#y", "http://b.com/DE/", "http://b.com?u=http://c.com/de/", "http://b.com/de", "a://b://c/d", "http://É.com/fr/ü",
        "http://notexample.org/es/"]
WANT = [("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("x.org", "", None, "allow"), ("x.org", "/", "org/", "allow"), ("borg", "/", None, "allow"), ("b.com", "/fr/", "com/fr/", "allow"),
        ("com", "/de/x", "com/de/", "block"), ("b.com", "/DE/", None, "allow"), ("b.com", "", None, "allow"), ("b.com", "/de", None, "allow"),
        ("b:", "//c/d", None, "allow"), ("É.com", "/fr/ü", "com/fr/", "allow"), ("notexample.org", "/es/", "org/", "allow")]


def tables(spark, pages, labels):
    return (spark.createDataFrame(pages, "page_id long, url string, html string, host string, label string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_stated_rules(spark):
    pages, labels = tables(spark, [(i, u, None, "?", "?") for i, u in enumerate(URLS)], [])
    got = urls.judge(pages, labels).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == WANT
    assert urls.judge(pages.limit(0), labels).count() == 0


def test_no_stated_rules(spark):
    pages, labels = tables(spark, [(1, "http://example.org/es/1", None, "?", "?")], [])
    got = urls.judge(pages, labels, rules=()).first()
    assert (got.rule, got.verdict) == (None, "allow")


def test_index_holds_a_rule_once_under_its_rarest_token(spark):
    rules = spark.createDataFrame([(1, ["a", "z"], 0.9), (2, ["b", "z"], 0.8), (3, ["z"], 0.6), (4, ["b", "c"], 0.7), (5, ["b", "c"], 0.7)],
                                  "rule_id long, tokens array<string>, confidence double")
    got = {r.rule_id: r.token for r in urls.index(rules).collect()}
    assert got == {1: "a", 2: "b", 3: "z", 4: "c", 5: "c"}


def mined(transactions, support, confidence):
    """Rules by trying all token sets, pruned by shorter ones of no less confidence."""
    n = len(transactions)
    sets = {frozenset(c) for t, _ in transactions for k in range(1, len(t) + 1) for c in combinations(t, k)}
    rules = {}
    for s in sets:
        have = [bad for t, bad in transactions if s <= set(t)]
        if sum(have) >= support * n - 1e-9 and sum(have) / len(have) >= confidence:
            rules[s] = sum(have) / len(have)
    return {s: c for s, c in rules.items() if not any(o < s and rules[o] >= c for o in rules)}


def test_mined_rules_block(spark):
    rng = random.Random(4)
    pages, labels = [], []
    for i in range(300):
        host, part, key = rng.choice(["a", "b", "c"]), rng.choice(["shop", "news", "blog"]), rng.choice(["", "?ref=1", "?utm=2"])
        pages.append((i, f"http://{host}.net/{part}/{i}{key}", None, None, None))
        bad = (host == "a" and part == "shop") or rng.random() < 0.05
        if i % 3 or i < 60:
            labels.append((i, int(not bad) if i % 2 else 1, int(bad) if i % 2 == 0 else None))
    labels += [(0, None, None), (7000, 0, 1)]
    p, q = tables(spark, pages, labels)
    labelled = urls.label_pages(p, q)
    rows = labelled.where("bad is not null").select(urls.tokens(labelled.url).alias("t"), "bad").collect()
    want = mined([(tuple(r.t), r.bad) for r in rows], urls.LEAST / len(rows), 0.5)
    rules = {frozenset(r.tokens): r.confidence for r in urls.mine(labelled).collect()}
    assert rules.keys() == want.keys() and all(abs(rules[k] - want[k]) < 1e-9 for k in want)
    assert frozenset({"host=a", "path=shop"}) in rules
    tokens = {r.page_id: set(r.t) for r in p.select("page_id", urls.tokens(p.url).alias("t")).collect()}
    for r in urls.judge(p, q).collect():
        fits = [c for s, c in want.items() if s <= tokens[r.page_id]]
        assert r.verdict == ("block" if fits else "allow") and r.rule is None
        assert r.mined_confidence == pytest.approx(max(fits)) if fits else r.mined_confidence is None


# --- WARC ----------------------------------------------------------------------------

def test_round_trip(spark):
    long, other = "é" * 600, "y" * 1000
    rows = [(1, "http://a/", long), (2, None, long), (9, "http://b\r\nX: 1/", long), (3, "u", "x" * 999), (4, "u", "x" * 999), (5, "u", None), (6, "u", ""),
            (7, "u", other), (8, "u", "WARC/1.1\r\n\r\n" * 200), (None, "u", long), (11, "", other), (11, "", other), (12, "z", "x" * 17_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows)
    kept = {long: 9, other: 11}
    want = set()
    for i, _, t in rows:
        t = t or ""
        revisit = t in kept and i != kept[t]
        want.add((i, len(t.encode()), hashlib.sha1(t.encode()).hexdigest(), "revisit" if revisit else "response", kept[t] if revisit else None))
    assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want
    assert warc.round_trip(pages.limit(0)).count() == 0


def records(n=6):
    return [warc.encode(f"urn:page:{i}", f"http://x/{i}", p := f"body {i} ".encode() * 50, hashlib.sha1(p).hexdigest(), None) for i in range(n)]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    parts = [warc.member(r) if packed else r for r in records()]
    starts = [sum(map(len, parts[:i])) for i in range(len(parts) + 1)]
    whole = b"".join(parts)
    assert [e[:3] for e in warc.salvage(whole)] == [("record", a, b) for a, b in zip(starts, starts[1:], strict=False)]
    for broken in (whole[:starts[2] + 30] + b"?????" + whole[starts[2] + 35:],          # a damaged record
                   whole[:starts[2]] + b"garbage WARC/1.1\r\n junk" + whole[starts[3]:]):  # a replaced one
        found = list(warc.salvage(broken))
        assert [e[3]["record_id"] for e in found if e[0] == "record"] == [f"urn:page:{i}" for i in (0, 1, 3, 4, 5)]
        gaps = [e for e in found if e[0] == "gap"]
        assert len(gaps) == 1 and gaps[0][1] == starts[2] and gaps[0][2] == starts[3] + len(broken) - len(whole) and gaps[0][3]
    cut = list(warc.salvage(whole[:starts[5] + 40]))
    assert [e[0] for e in cut] == ["record"] * 5 + ["gap"] and cut[-1][1:3] == (starts[5], starts[5] + 40)
    assert list(warc.salvage(b"")) == []
    assert [e[:3] for e in warc.salvage(b"nothing")] == [("gap", 0, 7)]


def test_wrong_length_and_digest_are_quarantined():
    good = records(3)
    longer = re.sub(rb"Content-Length: ([0-9]+)", lambda m: b"Content-Length: %d" % (int(m[1]) + 3), good[1], count=1)
    payload = good[1].replace(b"body 1 body", b"body 2 body", 1)
    for bad in (longer, payload):
        found = list(warc.salvage(good[0] + bad + good[2]))
        assert [e[0] for e in found] == ["record", "gap", "record"]


def test_digests_of_other_archives():
    payload = b"body 1 " * 50
    plain = warc.encode("urn:page:1", "http://x/1", payload, hashlib.sha1(payload).hexdigest(), None)
    hexed = hashlib.sha1(payload).hexdigest().encode()
    base32 = base64.b32encode(hashlib.sha1(payload).digest())
    forms = [b"sha1:" + base32, b"SHA1:" + base32.lower(), b"sha-1:" + hexed.upper(), b"sha256:" + hashlib.sha256(payload).hexdigest().encode(),
             b"md5:" + base64.b32encode(hashlib.md5(payload).digest()), b"blake9:xyz", b"sha1:not a digest"]
    for form in forms + [None]:
        line = b"" if form is None else b"WARC-Payload-Digest: " + form + b"\r\n"
        record = re.sub(rb"WARC-Payload-Digest: [^\r]*\r\n", lambda _, new=line: new, plain)
        (event,) = warc.salvage(warc.member(record))
        assert event[0] == "record" and event[3]["payload"] == payload and event[3]["payload_digest"] == hexed.decode()
    for form in forms[:5]:   # a digest that can be checked must agree
        record = re.sub(rb"WARC-Payload-Digest: [^\r]*", b"WARC-Payload-Digest: " + form, plain).replace(b"body 1 body", b"body 2 body", 1)
        assert [e[0] for e in warc.salvage(record)] == ["gap"]


def test_several_records_in_a_member():
    good = records(5)
    start = warc.member(good[0])
    both = warc.member(good[1] + b"lost bytes" + good[2].replace(b"body 2 body", b"body 9 body", 1) + good[3])
    found = list(warc.salvage(start + both + warc.member(good[4])))
    assert [e[3]["record_id"][-1] for e in found if e[0] == "record"] == ["0", "1", "3", "4"]
    (gap,) = [e for e in found if e[0] == "gap"]
    span = (len(start), len(start) + len(both))
    assert gap[1:3] == span and f"bytes {len(good[1])} to {len(good[1]) + 10 + len(good[2])} of" in gap[3]
    assert [e[1:3] for e in found if e[0] == "record"][1:3] == [span, span]
    hidden = gzip.compress(good[0])   # a payload that is an archive itself is not opened
    outer = warc.encode("urn:page:o", None, hidden, hashlib.sha1(hidden).hexdigest(), None)
    assert [e[3]["record_id"] for e in warc.salvage(warc.member(outer))] == ["urn:page:o"]
    assert [e[0] for e in warc.salvage(warc.member(b"no record at all") + start)] == ["gap", "record"]


def test_a_member_is_inflated_in_slices(monkeypatch):
    whole = b"".join(warc.member(r) for r in records(40))
    want = [e[:3] for e in warc.salvage(whole)]
    for size in (1, 7, 300):
        monkeypatch.setattr(warc, "INFLATE_BYTES", size)
        assert [e[:3] for e in warc.salvage(whole)] == want


def test_gaps_are_logged(spark, tmp_path):
    parts = [warc.member(r) for r in records()]
    (tmp_path / "a.warc.gz").write_bytes(parts[0] + parts[1][:-9] + parts[2])
    (tmp_path / "b.warc").write_bytes(records()[0] + b"?" + records()[1])
    (tmp_path / "empty.warc").write_bytes(b"")
    entries = warc.read(spark, str(tmp_path)).cache()
    assert entries.where("kind = 'record'").count() == 4
    warc.quarantine(entries, str(tmp_path / "log"))
    log = spark.read.json(str(tmp_path / "log")).collect()
    assert len(log) == 2 and all(r.stop > r.start and r.reason for r in log)
