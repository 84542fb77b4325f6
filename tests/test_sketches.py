"""Merged day sketches against exact counts."""

import random

from tidings.operators import sketches


def test_any_range_within_its_error(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"2024-01-{rng.randint(1, 9):02d}", rng.choice("ab"), rng.choice([None, f"u{rng.randint(0, 9000)}"]), rng.choice([None, int(rng.paretovariate(0.8))])) for _ in range(30_000)]
    rows += [("2024-01-03", "none", None, None)] * 2
    df = spark.createDataFrame(rows, "date string, kind string, url string, size long")
    def made(part):
        return sketches.day_sketches(part, "date", ["kind"], ["url"], ["size"])
    root = str(tmp_path / "s")
    sketches.store(made(df.where("date < '2024-01-06'")), root, "a")
    sketches.store(made(df.limit(10)), root, "b")                     # replaced by the next run
    sketches.store(made(df.where("date >= '2024-01-06'")), root, "b")
    for first, last in (("2024-01-01", "2024-01-09"), ("2024-01-02", "2024-01-07"), ("2024-01-03", "2024-01-03")):
        kept = sketches.stored(spark, root).where(f"day BETWEEN '{first}' AND '{last}'")
        got = {r.kind: r for r in sketches.merged(kept, ["kind"], ["url"], ["size"]).collect()}
        for kind in ("a", "b"):
            inside = [r for r in rows if first <= r[0] <= last and r[1] == kind]
            exact = len({r[2] for r in inside if r[2]})
            assert got[kind].n == len(inside) and abs(got[kind].url_distinct - exact) <= sketches.DISTINCT_ERROR * exact
            sizes = [r[3] for r in inside if r[3] is not None]
            assert sum(s < got[kind].size_at for s in sizes) / len(sizes) <= 0.5 + sketches.RANK_ERROR
            assert sum(s <= got[kind].size_at for s in sizes) / len(sizes) >= 0.5 - sketches.RANK_ERROR
        assert tuple(got["none"])[1:] == (2, 0, None)


def test_no_rows(spark):
    none = spark.createDataFrame([], "date string, kind string, url string, size long")
    day = sketches.day_sketches(none, "date", ["kind"], ["url"], ["size"])
    assert sketches.merged(day, ["kind"], ["url"], ["size"]).count() == 0
