"""Queries: validity, trends, evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.operators import temporal
from tidings.plans.sql import EDGES, with_
from tidings.sources import tables

DATES = ["1996-01-01", "1997-01-01", "1998-01-01", "1999-01-01", "2000-01-01"]


def _facts(spark, sf):
    """Which supplier serves a part, from each shipment on."""
    return tables.supplies(spark, sf).select(F.col("dst").alias("subject"), "type", F.col("src").alias("object"), F.col("ts").alias("start"))


def relation_trend(spark, sf):
    return temporal.trend(tables.edges(spark, sf)).select("type", F.date_format("period", "yyyy-MM").alias("period"), "n", "change")


def relation_lifecycle(spark, sf):
    iv = temporal.lifecycle(_facts(spark, sf), ["subject", "type"])
    return iv.select("subject", "object", F.date_format("start", "yyyy-MM-dd").alias("start"), F.date_format("end", "yyyy-MM-dd").alias("end"))


def relation_bitemporal(spark, sf):
    """What held at each date, as known on 1 July 1998 from orders placed by then."""
    o = tables.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("timestamp").alias("recorded"))
    li = tables.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("timestamp").alias("start"))
    facts = li.join(o, "l_orderkey").select(tables._key("p:", "l_partkey").alias("subject"), tables._key("s:", "l_suppkey").alias("object"), "start", "recorded")
    held = temporal.as_of(temporal.known_lifecycle(facts, ["subject"], F.lit("1998-07-01").cast("timestamp")), DATES)
    return held.select(F.date_format("as_of", "yyyy-MM-dd").alias("as_of"), "subject", "object", F.date_format("start", "yyyy-MM-dd").alias("start"))


def relation_asof(spark, sf):
    held = temporal.as_of(temporal.lifecycle(_facts(spark, sf), ["subject", "type"]), DATES)
    return held.select(F.date_format("as_of", "yyyy-MM-dd").alias("as_of"), "subject", "object", F.date_format("start", "yyyy-MM-dd").alias("start"))


def relation_asof_dates(spark, sf):
    """Who supplied each ordered part on the day of its order."""
    o, li = (tables.table(spark, sf, t) for t in ("orders", "lineitem"))
    asked = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
             .select(tables._key("p:", "l_partkey").alias("subject"), F.col("o_orderdate").cast("timestamp").alias("at")).distinct())
    held = temporal.as_of_join(temporal.lifecycle(_facts(spark, sf), ["subject", "type"]), asked, ["subject"])
    return held.select(F.date_format("at", "yyyy-MM-dd").alias("on_day"), "subject", "object", F.date_format("start", "yyyy-MM-dd").alias("start"))


def _evidence(spark, sf):
    li = tables.table(spark, sf, "lineitem")
    return li.select(
        tables._key("p:", "l_partkey").alias("subject"), F.lit("SUPPLIES").alias("type"), tables._key("s:", "l_suppkey").alias("object"),
        (1 - F.col("l_discount") - F.col("l_tax")).alias("raw"), F.col("l_shipdate").cast("timestamp").alias("last_updated"),
        F.when(F.col("l_returnflag") == "A", "filing").when(F.col("l_returnflag") == "R", "market")
        .when(F.col("l_linestatus") == "F", "news").otherwise("inferred").alias("kind"),
        F.concat(F.lit("order/"), F.col("l_orderkey").cast("string")).alias("source"), (F.col("l_quantity") / 50.0).alias("quality"))


def conflict_resolve(spark, sf):
    ev = _evidence(spark, sf).withColumn("confidence", F.round("raw", 6))
    out = temporal.resolve_conflicts(ev.select("subject", "type", "object", "confidence", "last_updated"), ["subject", "type"])
    return out.select("subject", "type", "object", "confidence", F.date_format("last_updated", "yyyy-MM-dd").alias("last_updated"), "facts")


def confidence_merge(spark, sf):
    ev = _evidence(spark, sf).withColumnRenamed("last_updated", "ts")
    return temporal.merge_confidence(ev, ["subject", "type"], F.lit("2002-01-01").cast("timestamp"))


def _terms(spark, sf):
    """Supply terms: first and last shipment per part and supplier."""
    return (tables.supplies(spark, sf).groupBy(F.col("dst").alias("subject"), F.col("src").alias("object"))
            .agg(F.min("ts").alias("start"), F.max("ts").alias("end")))


def interval_overlaps(spark, sf):
    out = temporal.overlaps(_terms(spark, sf), ["subject"])
    return out.select("subject", "object", F.date_format("start", "yyyy-MM-dd").alias("start"), F.date_format("end", "yyyy-MM-dd").alias("end"),
                      "earlier", F.date_format("reached", "yyyy-MM-dd").alias("reached"), "violation")


QUERIES = {f.__name__: f for f in (relation_trend, relation_lifecycle, relation_asof, relation_asof_dates, relation_bitemporal, conflict_resolve, confidence_merge, interval_overlaps)}

_LIFE = """
life AS (SELECT subject, object, ts AS start, lead(ts) OVER (PARTITION BY subject ORDER BY ts, object) AS end_
  FROM (SELECT DISTINCT dst AS subject, src AS object, ts FROM supplies))
"""

ORACLES = {
    "relation_trend": with_(EDGES, """
k AS (SELECT type, date_trunc('month', ts) AS p, count(*) AS n FROM edges WHERE ts IS NOT NULL GROUP BY 1, 2),
cal AS (SELECT type, unnest(generate_series(min(p)::TIMESTAMP, max(p)::TIMESTAMP, INTERVAL 1 MONTH)) AS p FROM k GROUP BY 1),
c AS (SELECT cal.type, cal.p, coalesce(n, 0) AS n FROM cal LEFT JOIN k ON k.type = cal.type AND k.p = cal.p)""", body="""
SELECT type, strftime(p, '%Y-%m') AS period, n, n - lag(n) OVER (PARTITION BY type ORDER BY p) AS change FROM c"""),
    "relation_lifecycle": with_(EDGES, _LIFE, body="""
SELECT subject, object, strftime(start, '%Y-%m-%d') AS start, strftime(end_, '%Y-%m-%d') AS "end" FROM life"""),
    "relation_asof": with_(EDGES, _LIFE, "ds AS (SELECT unnest([" + ", ".join(f"TIMESTAMP '{d}'" for d in DATES) + "]) AS d)", body="""
SELECT strftime(d, '%Y-%m-%d') AS as_of, subject, object, strftime(start, '%Y-%m-%d') AS start FROM life JOIN ds ON start <= d AND (end_ IS NULL OR d < end_)"""),
    "relation_asof_dates": with_(EDGES, _LIFE, """questions AS (SELECT DISTINCT 'p:' || l_partkey AS subject, o_orderdate AS asked
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""", body="""
SELECT strftime(asked, '%Y-%m-%d') AS on_day, subject, object, strftime(start, '%Y-%m-%d') AS start FROM questions JOIN life USING (subject)
WHERE start <= asked AND (end_ IS NULL OR asked < end_)"""),
    "relation_bitemporal": with_("""
life AS (SELECT subject, object, ts AS start, lead(ts) OVER (PARTITION BY subject ORDER BY ts, object) AS end_ FROM (
  SELECT DISTINCT 'p:' || l_partkey AS subject, 's:' || l_suppkey AS object, l_shipdate AS ts FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_orderdate <= TIMESTAMP '1998-07-01'))""", "ds AS (SELECT unnest([" + ", ".join(f"TIMESTAMP '{d}'" for d in DATES) + "]) AS d)", body="""
SELECT strftime(d, '%Y-%m-%d') AS as_of, subject, object, strftime(start, '%Y-%m-%d') AS start FROM life JOIN ds ON start <= d AND (end_ IS NULL OR d < end_)"""),
    "conflict_resolve": """SELECT subject, 'SUPPLIES' AS type, object, confidence, strftime(ts, '%Y-%m-%d') AS last_updated, facts FROM (
  SELECT 'p:' || l_partkey AS subject, 's:' || l_suppkey AS object, round(1 - l_discount - l_tax, 6) AS confidence, l_shipdate AS ts,
         count(*) OVER (PARTITION BY l_partkey) AS facts,
         row_number() OVER (PARTITION BY l_partkey ORDER BY round(1 - l_discount - l_tax, 6) DESC, l_shipdate DESC, 's:' || l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1""",
    "confidence_merge": """SELECT subject, 'SUPPLIES' AS type, count(*) AS evidence, count(DISTINCT source) AS sources,
  round(least(1.0::DOUBLE, sum((lo + (hi - lo) * q) * w) / sum(w) * (1 + 0.05::DOUBLE * (count(DISTINCT source) - 1))), 6) AS confidence FROM (
  SELECT 'p:' || l_partkey AS subject, l_orderkey AS source, l_quantity / 50.0::DOUBLE AS q,
    pow(0.5::DOUBLE, date_diff('day', l_shipdate, TIMESTAMP '2002-01-01')::DOUBLE / 365.0::DOUBLE) AS w,
    CASE WHEN l_returnflag = 'A' THEN 0.9 WHEN l_returnflag = 'R' THEN 0.7 WHEN l_linestatus = 'F' THEN 0.3 ELSE 0.2 END::DOUBLE AS lo,
    CASE WHEN l_returnflag = 'A' THEN 1.0 WHEN l_returnflag = 'R' THEN 0.9 WHEN l_linestatus = 'F' THEN 0.8 ELSE 0.6 END::DOUBLE AS hi FROM lineitem)
GROUP BY 1""",
    "interval_overlaps": with_(EDGES, """
terms AS (SELECT dst AS subject, src AS object, min(ts) AS s, max(ts) AS e FROM supplies GROUP BY 1, 2),
nx AS (SELECT *, max(CASE WHEN e >= s THEN {'t': e, 'o': object} END) OVER (PARTITION BY subject ORDER BY s, object ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM terms)""", body="""
SELECT subject, object, strftime(s, '%Y-%m-%d') AS start, strftime(e, '%Y-%m-%d') AS "end", r.o AS earlier, strftime(r.t, '%Y-%m-%d') AS reached,
  CASE WHEN e < s THEN 'inverted' ELSE 'overlap' END AS violation FROM nx WHERE e < s OR r.t > s"""),
}
