"""Declared tests, gates and dimension scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings import vocab
from tidings.operators.ingest import union_all


class QualityError(RuntimeError):
    """A load was stopped by failing rules."""


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violations per rule in one pass; a rule is a condition that must hold."""
    one = df.agg(F.count("*").alias("_rows"), *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(n) for n, ok in rules.items()])
    out = F.array(*[F.struct(F.lit(n).alias("rule"), F.col("_rows").alias("rows"), F.col(n).alias("violations")) for n in rules])
    return one.select(F.explode(out).alias("x")).select("x.*")


def unique_count(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """Rows beyond the first of each key, as a rule row."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(F.lit(name).alias("rule"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                       F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))


def failing_rows(df: DataFrame, rules: dict[str, Column], *keys: str) -> DataFrame:
    """(keys, rule) for every violated rule: the stored failures."""
    bad = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items()])
    return df.select(*keys, F.explode(F.filter(bad, lambda r: r.isNotNull())).alias("rule"))


def repeated_rows(df: DataFrame, name: str, key: str, *row: str) -> DataFrame:
    """(row, rule) of all rows whose key is not unique: the stored failures of
    ``unique_count``.  Repeated keys are found by a combining aggregate first,
    so only those meet the rows.  A null key repeats like any other."""
    again = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n")).where(F.col("_n") > 1).select("_key")
    return df.join(again, F.col(key).eqNullSafe(F.col("_key")), "left_semi").select(*row, F.lit(name).alias("rule"))


def reference_count(df: DataFrame, name: str, key: str, refs: DataFrame, ref: str) -> DataFrame:
    """Rows whose key is not among the references, as a rule row."""
    missing = df.join(refs.select(F.col(ref).alias("_ref")).distinct(), F.col(key) == F.col("_ref"), "left").select(
        F.col("_ref").isNull().cast("int").alias("bad"))
    return missing.agg(F.lit(name).alias("rule"), F.count("*").alias("rows"), F.coalesce(F.sum("bad"), F.lit(0)).alias("violations"))


def gate(*counts: DataFrame) -> DataFrame:
    """One row: rules, failed rules, violations and whether the load may run."""
    return union_all(*counts).agg(
        F.count("*").alias("rules"), F.count_if(F.col("violations") > 0).alias("failed_rules"),
        F.sum("violations").alias("violations"), (F.count_if(F.col("violations") > 0) == 0).alias("passed"))


def enforce(*counts: DataFrame) -> None:
    """Raise when any rule is violated; reads one row."""
    row = gate(*counts).first()
    if not row["passed"]:
        raise QualityError(f"{row['failed_rules']} of {row['rules']} rules failed, {row['violations']} violations")


def dimensions(scores: DataFrame, floor: float = vocab.QUALITY_FLOOR) -> DataFrame:
    """Rows (dimension, good, total) to ratios against the floor."""
    ratio = F.round(F.coalesce(F.try_divide("good", "total"), F.lit(0.0)), 6)
    return scores.select("dimension", "good", "total", ratio.alias("ratio"), (ratio >= floor).alias("passed"))
