"""As-of join with a table of dates against brute force."""

import random
from datetime import datetime, timedelta

import pytest

from conftest import rows
from tidings.operators import temporal

FACTS = "subject string, object string, start timestamp, end timestamp"
DAY = datetime(2020, 1, 15)


def cases():
    rng = random.Random(8)
    facts = []
    for i in range(200):
        start = DAY + timedelta(days=rng.randint(0, 900), hours=rng.randint(0, 23))
        facts.append((rng.choice(["hot", "hot", "hot", "a", "b"]), f"o{i}", start, rng.choice([None, start, start + timedelta(days=rng.randint(0, 400))])))
    asked = [(rng.choice(["hot", "hot", "a", "c", None]), DAY + timedelta(days=rng.randint(-50, 1000))) for _ in range(300)]
    return facts, [*asked, ("hot", None), ("hot", facts[0][2]), ("hot", facts[0][3] or DAY), (None, None)]


@pytest.mark.parametrize("period", ["month", "year", "day"])
def test_as_of_join(spark, period):
    facts, asked = cases()
    got = temporal.as_of_join(spark.createDataFrame(facts, FACTS), spark.createDataFrame(asked, "subject string, at timestamp"), ["subject"], period=period)
    want = [(s, at, o, a, b) for s, at in asked for k, o, a, b in facts if k == s and at is not None and a <= at and (b is None or at < b)]
    assert rows(got.select("subject", "at", "object", "start", "end")) == sorted(want, key=str) and want


def test_dates_alone_and_none_at_all(spark):
    facts, asked = cases()
    dates = spark.createDataFrame([(a,) for _, a in asked[:20]], "at timestamp")
    df = spark.createDataFrame(facts, FACTS)
    want = [(at, o) for _, at in asked[:20] for _, o, a, b in facts if a <= at and (b is None or at < b)]
    assert rows(temporal.as_of_join(df, dates, []).select("at", "object")) == sorted(want, key=str)
    assert temporal.as_of_join(df, spark.createDataFrame([], "subject string, at timestamp"), ["subject"]).count() == 0


@pytest.mark.parametrize("most", [10_000, 10])
def test_crowded_subjects_give_the_same_rows(spark, monkeypatch, most):
    monkeypatch.setattr(temporal, "KEY_ROWS", most)
    facts, asked = cases()
    rng = random.Random(4)
    seen = [(rng.choice([s, s, s, None]), o, rng.choice([a, a, a, None])) for s, o, a, _ in facts]
    df = spark.createDataFrame([*seen, *seen[:30]], "subject string, object string, start timestamp")
    assert temporal.crowded(df, ["subject"]) == (most == 10)
    life = temporal.lifecycle(df, ["subject"])
    want = []
    for k in {s for s, _, _ in seen}:
        own = sorted({(a or datetime.min, o) for s, o, a in seen if s == k})
        for (a, o), b in zip(own, [*(a for a, _ in own[1:]), None], strict=True):
            near = a != datetime.min and b and (k is not None or (a.year, a.month) == (b.year, b.month))
            want.append((k, o, None if a == datetime.min else a, b if near else None))
    assert rows(life.select("subject", "object", "start", "end")) == sorted(want, key=str)
    dates = spark.createDataFrame(asked, "subject string, at timestamp")
    met = temporal.as_of_join(life, dates, ["subject"])
    assert ("_period" in met._jdf.queryExecution().toString()) == (most == 10)   # only crowded subjects are dealt over periods
    held = [(s, at, o, a, b) for s, at in asked for k, o, a, b in want if s is not None and k == s and at and a and a <= at and (b is None or at < b)]
    assert rows(met.select("subject", "at", "object", "start", "end")) == sorted(held, key=str) and held
