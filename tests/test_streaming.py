import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tidings import schemas
from tidings.session import materialize, scratch
from tidings.sinks import files
from tidings.streaming import flows

BASE = dt.datetime(2024, 1, 1, 12, 0, 0)


def events(spark, *r):
    return spark.createDataFrame([(i, BASE + dt.timedelta(seconds=s), u, t, 1.0, "{}") for i, s, u, t in r],
                                 "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1)


def drain(spark, src, make, root, chk, keys, mode="update"):
    stream = flows.run_events(flows.file_stream(spark, schemas.EVENTS, src, per_batch=1))
    flows.keep_latest(make(stream), root, chk, mode)
    return files.read_latest(spark, root, *keys)


def counted(spark, src, count, root, chk, *keys):
    flows.keep_counts(flows.run_events(flows.file_stream(spark, schemas.EVENTS, src, per_batch=1)), count, root, chk)
    return flows.summed(spark, root, *keys)


def test_threshold_counts_across_batches_and_redelivery(spark):
    src, root, chk = (scratch(spark, n) for n in ("src", "out", "chk"))
    run = lambda: counted(spark, src, flows.threshold_windows, root, chk, "start", "resource")
    events(spark, (1, 1, 3, "purchase"), (2, 20, 3, "purchase"), (3, 70, 3, "purchase")).write.parquet(src)
    run()
    events(spark, (4, 30, 3, "purchase"), (5, 5, 3, "error")).write.mode("append").parquet(src)
    out = run()
    assert rows(out.select("start", "events")) == [(BASE, 3), (BASE + dt.timedelta(seconds=60), 1)]
    assert rows(run()) == rows(out)


def test_late_rows_are_counted(spark):
    src, root, chk = (scratch(spark, n) for n in ("src", "out", "chk"))
    for batch in ([(1, 0, 3, "purchase")], [(2, 7200, 3, "purchase")], [(3, 7260, 3, "purchase")], [(4, 10, 3, "purchase")]):
        events(spark, *batch).write.mode("append").parquet(src)
        out = counted(spark, src, flows.threshold_windows, root, chk, "start", "resource")
    assert rows(out.select("start", "events")) == [(BASE, 2), (BASE + dt.timedelta(hours=2), 1), (BASE + dt.timedelta(seconds=7260), 1)]
    daily = counted(spark, src, flows.daily_summary, scratch(spark, "out"), scratch(spark, "chk"), "start")
    assert rows(daily.select("runs", "completed", "failed")) == [(4, 4, 0)]


def test_dedup_from_the_last_fetch_kept(spark):
    """10:59 and 11:01 are one fetch; an hour after the first one kept, the next counts."""
    src, root, chk = (scratch(spark, n) for n in ("src", "out", "chk"))
    make = lambda s: flows.dedupe_fetches(s, "user_id", "state")
    events(spark, (1, 3540, 3, "purchase"), (2, 60, 4, "purchase"), (3, 3660, 3, "purchase"), (4, 3540 + 3600, 3, "purchase")).write.parquet(src)
    drain(spark, src, make, root, chk, ["event_id"], "append")
    events(spark, (5, 3540 + 3700, 3, "purchase"), (6, 3540 + 7200, 3, "purchase")).write.mode("append").parquet(src)
    out = drain(spark, src, make, root, chk, ["event_id"], "append")
    assert rows(out.select("event_id")) == [(1,), (2,), (4,), (6,)]


def test_dedup_state_expires(spark):
    src, root, chk = (scratch(spark, n) for n in ("src", "out", "chk"))
    make = lambda s: flows.dedupe_fetches(s, "user_id", "state", late="1 hour")
    for batch in ([(i, i, i, "purchase") for i in range(20)], [(30, 90_000, 99, "purchase")], [(31, 90_001, 99, "purchase")], [(32, 98_000, 3, "purchase")]):
        events(spark, *batch).write.mode("append").parquet(src)
        out = drain(spark, src, make, root, chk, ["event_id"], "append")
    assert rows(out.select("event_id")) == sorted([(i,) for i in range(20)] + [(30,), (32,)], key=str)
    assert spark.read.format("statestore").load(chk).count() <= 2


def test_burst_over_a_minute_border_fires_once(spark):
    src, root, chk = (scratch(spark, n) for n in ("src", "out", "chk"))
    make = lambda s: flows.bursts(s, 3, "60 seconds", "10 minutes")
    events(spark, (1, 40, 3, "purchase"), (2, 55, 13, "purchase"), (3, 50, 4, "purchase"), (4, 58, 3, "error")).write.parquet(src)
    drain(spark, src, make, root, chk, ["resource", "fired"], "append")
    events(spark, (5, 65, 3, "purchase"), (6, 66, 3, "purchase"), (7, 67, 3, "purchase"), (8, 120, 4, "purchase"), (9, 181, 4, "purchase")).write.mode("append").parquet(src)
    out = drain(spark, src, make, root, chk, ["resource", "fired"], "append")
    assert rows(out) == [("flow-3", BASE + dt.timedelta(seconds=65))]
    # a day later nothing is remembered, and three events at one moment are a burst
    events(spark, (10, 90_000, 4, "purchase")).write.mode("append").parquet(src)
    drain(spark, src, make, root, chk, ["resource", "fired"], "append")
    events(spark, *[(20 + i, 90_100, 3, "purchase") for i in range(3)]).write.mode("append").parquet(src)
    out = drain(spark, src, make, root, chk, ["resource", "fired"], "append")
    assert rows(out) == [("flow-3", BASE + dt.timedelta(seconds=65)), ("flow-3", BASE + dt.timedelta(seconds=90_100))]
    state = spark.read.format("statestore").load(chk)
    assert {r.key.resource for r in state.select("key").collect()} <= {"flow-3", "flow-4"}


def test_alert_message(spark):
    ev = flows.run_events(events(spark, (7, 5, 12, "error"), (8, 5, 12, "click")))
    assert rows(flows.failure_alerts(ev)) == [(7, "Ingestion Failed", "Flow: flow-2\nRun: 7\nTime: 2024-01-01 12:00:05")]


def test_index_restart_adds_no_duplicates(spark):
    src, root, chk = (scratch(spark, n) for n in ("src", "ix", "chk"))
    a = spark.createDataFrame([("d1", "T", "body"), ("d2", "U", None)], "doc_id string, title string, content string")
    for f in schemas.ARTICLE_15.fields:
        if f.name not in a.columns:
            a = a.withColumn(f.name, F.lit(None).cast(f.dataType))
    a.select(schemas.ARTICLE_15.names).write.parquet(src)
    for _ in range(2):
        flows.embed_and_index(flows.file_stream(spark, schemas.ARTICLE_15, src), root, chk)
    assert spark.read.parquet(root).count() == 2
    assert rows(files.read_latest(spark, root, "doc_id").select("doc_id", "content", "url", F.size("content_vector"))) == [("d1", "body", "", 64), ("d2", "", "", 64)]


def test_materialize_keeps_schema_and_rows(spark):
    df = spark.range(10).select("id", F.array("id").alias("a"))
    got = materialize(df, "t")
    assert got.columns == ["id", "a"] and got.count() == 10
