"""Validity intervals, trends and evidence merging."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.session import materialize, within

KEY_ROWS = 10_000     # rows of one key that a task takes as they are; beyond it a key is spread over calendar periods
KEY_CODES = 1 << 18   # codes under which the rows of keys are counted

# Evidence bands: lowest and highest confidence by kind of source
CONFIDENCE_BANDS = (("filing", 0.9, 1.0), ("market", 0.7, 0.9), ("news", 0.3, 0.8), ("inferred", 0.2, 0.6))


def next_in_group(df: DataFrame, keys: list[str], order: Sequence[str], values: Sequence[str], bucket: Column) -> DataFrame:
    """``lead`` of ``values`` per key, safe for a key holding most rows.

    ``bucket`` must not decrease along ``order`` (for example its month).  The
    window runs per (key, bucket), so a hot key is spread over its buckets;
    the last row of a bucket takes the first row of the key's next non-empty
    bucket from a table with one row per (key, bucket).
    """
    first = F.struct(*order, *[v for v in values if v not in order])
    parts = df.withColumn("_b", bucket)
    w = Window.partitionBy(*keys, "_b").orderBy(*order)
    inner = parts.withColumn("_next", F.lead(first).over(w))
    heads = parts.groupBy(*keys, "_b").agg(F.min(first).alias("_head"))
    heads = heads.withColumn("_after", F.lead("_head").over(Window.partitionBy(*keys).orderBy("_b"))).drop("_head")
    out = inner.join(heads, [*keys, "_b"], "left").withColumn("_n", F.coalesce("_next", "_after"))
    return out.select(*df.columns, *[F.col(f"_n.{v}").alias(f"next_{v}") for v in values])


def crowded(df: DataFrame, keys: list[str]) -> bool:
    """Whether a key may have more than ``KEY_ROWS`` rows.  Keys that share a
    code are counted together, so no such key is missed and what is shuffled is bounded."""
    code = F.pmod(F.xxhash64(*keys), F.lit(KEY_CODES)).cast("int")
    return not within(df.groupBy(code.alias("code")).agg(F.count("*").alias("n")).where(F.col("n") > KEY_ROWS), 0)


def lifecycle(facts: DataFrame, keys: list[str]) -> DataFrame:
    """A new fact ends the one before it; the last one is open (null end).

    ``facts`` holds the keys, ``object`` and ``start``; repeats of the same
    fact at the same time count once.  Without a crowded key one shuffle by
    the keys serves both steps.  A fact without a start is not ended, one without
    a whole key only within its month.
    """
    if not crowded(facts, keys):
        once = facts.select(*keys, "object", "start").repartition(*keys).distinct()
        after = F.lead("start").over(Window.partitionBy(*keys).orderBy("start", "object"))
        whole = reduce(and_, [F.col(k).isNotNull() for k in keys])
        reach = F.col("start").isNotNull() & (whole | (F.date_trunc("month", after) == F.date_trunc("month", "start")))
        return once.withColumn("end", F.when(reach, after))
    once = facts.select(*keys, "object", "start").distinct()
    return next_in_group(once, keys, ["start", "object"], ["start"], F.date_trunc("month", "start")).withColumnRenamed("next_start", "end")


def known_lifecycle(facts: DataFrame, keys: list[str], known_at: Column) -> DataFrame:
    """The lifecycle as it was known at a time: only facts recorded by then.

    ``facts`` also holds ``recorded``; with ``as_of`` this answers both
    questions of a bi-temporal table: what held when, as known when.
    """
    return lifecycle(facts.where(F.col("recorded") <= known_at), keys)


def as_of(intervals: DataFrame, dates: list[str]) -> DataFrame:
    """Facts holding at each date: start <= date and (open or date < end)."""
    days = F.array(*[F.lit(d).cast("timestamp") for d in dates])
    held = F.filter(days, lambda d: (F.col("start") <= d) & (F.col("end").isNull() | (d < F.col("end"))))
    return intervals.select("*", F.explode(held).alias("as_of"))


def as_of_join(intervals: DataFrame, asked: DataFrame, keys: list[str], at: str = "at", period: str = "month") -> DataFrame:
    """Rows of ``asked`` with every fact of the same keys that holds at their date.

    ``asked`` is a table of any size with the keys and a date.  Both sides meet
    on the keys.  With a crowded subject they meet on the keys and the calendar
    period of the date: an interval is one row for each period it covers between
    the first and the last date asked, so a pair meets once, and a subject with
    very many facts is dealt over its periods.  Null dates and dates before a
    first fact have no row.
    """
    intervals = materialize(intervals, "intervals")
    holds = (F.col("start") <= F.col(at)) & (F.col("end").isNull() | (F.col(at) < F.col("end")))
    if keys and not crowded(intervals, keys):
        return asked.join(intervals, keys).where(holds)
    asked = materialize(asked, "asked")
    low, high = asked.agg(F.min(at), F.max(at)).first()
    if low is None:
        return asked.join(intervals, keys).where(F.lit(False)) if keys else asked.join(intervals, F.lit(True)).where(F.lit(False))
    from_, to = F.lit(low).cast("timestamp"), F.lit(high).cast("timestamp")
    open_ = F.coalesce("end", to)
    covered = F.sequence(F.date_trunc(period, F.greatest("start", from_)), F.date_trunc(period, F.least(open_, to)), F.expr(f"INTERVAL 1 {period}"))
    dealt = intervals.where((F.col("start") <= to) & (open_ >= from_)).withColumn("_period", F.explode(covered))
    met = asked.withColumn("_period", F.date_trunc(period, at)).join(dealt, [*keys, "_period"]).drop("_period")
    return met.where(holds)


def trend(edges: DataFrame, period: str = "month") -> DataFrame:
    """Relations per type and period, and the change from the period before.

    Periods without relations between a type's first and last count 0, so
    "before" is always the calendar's.
    """
    counts = edges.where("ts is not null").groupBy("type", F.date_trunc(period, "ts").alias("period")).agg(F.count("*").alias("n"))
    spans = counts.groupBy("type").agg(F.min("period").alias("a"), F.max("period").alias("b"))
    calendar = spans.select("type", F.explode(F.sequence("a", "b", F.expr(f"INTERVAL 1 {period}"))).alias("period"))
    whole = calendar.join(counts, ["type", "period"], "left").select("type", "period", F.coalesce("n", F.lit(0)).alias("n"))
    w = Window.partitionBy("type").orderBy("period")   # one row per period: bounded
    return whole.withColumn("change", F.col("n") - F.lag("n").over(w))


def resolve_conflicts(evidence: DataFrame, keys: list[str]) -> DataFrame:
    """Highest confidence wins, then the most recent, then the object id."""
    rest = F.struct("confidence", "last_updated", "object")
    return evidence.groupBy(*keys).agg(F.max(rest).alias("b"), F.count("*").alias("facts")).select(*keys, "b.*", "facts")


def merge_confidence(evidence: DataFrame, keys: list[str], as_of: Column, half_life_days: float = 365.0) -> DataFrame:
    """Authority weighted by recency, boosted by agreement of sources.

    ``evidence`` holds the keys, ``kind`` (a confidence band), ``source``,
    ``quality`` in [0, 1] and ``ts``.  Each row lies within its band by its
    quality; recency halves its weight per half-life; every further distinct
    source adds five percent.
    """
    low = F.create_map(*[x for k, a, _ in CONFIDENCE_BANDS for x in (F.lit(k), F.lit(a))])
    high = F.create_map(*[x for k, _, b in CONFIDENCE_BANDS for x in (F.lit(k), F.lit(b))])
    authority = low[F.col("kind")] + (high[F.col("kind")] - low[F.col("kind")]) * F.col("quality")
    age = F.datediff(as_of, F.col("ts")).cast("double")
    weight = F.pow(F.lit(0.5), age / half_life_days)
    return evidence.groupBy(*keys).agg(
        F.count("*").alias("evidence"), F.count_distinct("source").alias("sources"),
        (F.sum(authority * weight) / F.sum(weight)).alias("base")
    ).withColumn("confidence", F.round(F.least(F.lit(1.0), F.col("base") * (1 + 0.05 * (F.col("sources") - 1))), 6)).drop("base")


def overlaps(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Intervals that start before an earlier one of their key has ended, and
    inverted intervals.

    Intervals are ordered by start and object; each is compared with the
    latest end of all before it (null: never ends), given as ``reached`` with
    the ``earlier`` object that has it.  Inverted intervals cover nothing.  The running maximum goes per (key,
    month of the start), then over one row per key and month, so a key
    holding most rows is spread over its months.
    """
    month = F.date_trunc("month", "start")
    never = F.lit("9999-12-31").cast("timestamp")
    cover = F.when((F.col("end") >= F.col("start")) | F.col("end").isNull(), F.coalesce(F.col("end").cast("timestamp"), never))
    rows = intervals.withColumn("_m", month).withColumn("_cover", F.when(cover.isNotNull(), F.struct(cover.alias("to"), F.col("object").alias("by"))))
    before = Window.unboundedPreceding, -1
    inner = rows.withColumn("_in", F.max("_cover").over(Window.partitionBy(*keys, "_m").orderBy("start", "object").rowsBetween(*before)))
    months = rows.groupBy(*keys, "_m").agg(F.max("_cover").alias("_top"))
    months = months.withColumn("_past", F.max("_top").over(Window.partitionBy(*keys).orderBy("_m").rowsBetween(*before))).drop("_top")
    seen = inner.join(months, [*keys, "_m"], "left").withColumn("_at", F.greatest("_in", "_past"))
    kind = F.when(F.col("end") < F.col("start"), "inverted").when(F.col("_at.to") > F.col("start"), "overlap")
    return seen.withColumn("violation", kind).where(F.col("violation").isNotNull()).select(
        *intervals.columns, F.col("_at.by").alias("earlier"), F.col("_at.to").alias("reached"), "violation")
