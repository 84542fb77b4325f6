"""Article-set analysis.  Input rows carry a ``raw_article`` struct."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings import vocab
from tidings.functions import text

A = "raw_article"


def source_name() -> Column:
    return F.coalesce(F.col(f"{A}.source.title"), F.lit(vocab.UNKNOWN_SOURCE))


def country_name() -> Column:
    return F.coalesce(F.col(f"{A}.source.location.country.label.eng"), F.lit("Unknown"))


def present(name: str) -> Column:
    """Present and, for text, not empty."""
    return F.col(f"{A}.{name}").isNotNull() & (F.col(f"{A}.{name}") != "")


def top_counts(df: DataFrame, key: Column, name: str, n: int) -> DataFrame:
    """The ``n`` most frequent values, ties by value."""
    return (df.groupBy(key.alias(name)).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), F.asc(name)).limit(n))


def newest_counts(df: DataFrame, key: Column, name: str, n: int | None = None) -> DataFrame:
    out = df.where(key.isNotNull() & (key != "")).groupBy(key.alias(name)).agg(F.count("*").alias("n")).orderBy(F.desc(name))
    return out if n is None else out.limit(n)


def category_labels(items: DataFrame) -> DataFrame:
    return (items.select(F.explode(f"{A}.categories.label").alias("category"))
            .where(F.col("category").isNotNull() & (F.col("category") != "")))


def score_stats(items: DataFrame, *names: str) -> DataFrame:
    """min / max / avg over present values, one pass, one row per score."""
    one = items.agg(*[F.struct(
        F.count(f"{A}.{n}").alias("n"), F.min(f"{A}.{n}").alias("min"),
        F.max(f"{A}.{n}").alias("max"), F.round(F.avg(f"{A}.{n}"), 6).alias("avg")).alias(n) for n in names])
    return _rows(one, "score", names)


def length_stats(items: DataFrame, *names: str) -> DataFrame:
    """Length range and floored average over non-empty text."""
    def stats(n):
        size = F.when(present(n), F.length(f"{A}.{n}"))
        return F.struct(F.count(size).alias("n"), F.min(size).cast("bigint").alias("min"),
                        F.max(size).cast("bigint").alias("max"),
                        F.floor(F.try_divide(F.sum(size), F.count(size))).alias("avg")).alias(n)
    return _rows(items.agg(*[stats(n) for n in names]), "field", names)


def _rows(one_row: DataFrame, label: str, names) -> DataFrame:
    both = F.array(*[F.struct(F.lit(n).alias(label), F.col(n).alias("s")) for n in names])
    return one_row.select(F.explode(both).alias("x")).select(f"x.{label}", "x.s.*")


def completeness(items: DataFrame, *keys: str) -> DataFrame:
    return items.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if(present("title")).alias("has_title"),
        F.count_if(present("body")).alias("has_body"), F.count_if(present("image")).alias("has_image"))


def sources_across_topics(items: DataFrame, n: int = 10) -> DataFrame:
    """Sources seen in more than one topic; topics are a bounded dimension."""
    pairs = items.select(source_name().alias("source"), "topic_name").distinct()
    return (pairs.groupBy("source").agg(
                F.count("*").alias("topics"), text.joined(F.collect_set("topic_name")).alias("topic_list"))
            .where("topics > 1").orderBy(F.desc("topics"), "source").limit(n))


def topic_sources(items: DataFrame) -> DataFrame:
    return items.groupBy("topic_name").agg(F.count_distinct(source_name()).alias("sources"))


def date_coverage(items: DataFrame) -> DataFrame:
    day = F.when(present("date"), F.col(f"{A}.date"))
    return (items.groupBy("topic_name").agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count_distinct(day).alias("days")))


def duplicate_urls(items: DataFrame) -> DataFrame:
    """URLs seen more than once; a repeat inside one topic counts too."""
    return (items.where(present("url")).groupBy(F.col(f"{A}.url").alias("url"))
            .agg(F.count("*").alias("occurrences"), F.count_distinct("topic_name").alias("topics"),
                 text.joined(F.collect_set("topic_name")).alias("topic_list"))
            .where("occurrences > 1"))


def field_profile(df: DataFrame, struct: str | None = None) -> DataFrame:
    """Per field: how many rows have it, and its type."""
    schema = df.schema if struct is None else df.schema[struct].dataType
    path = (lambda n: n) if struct is None else (lambda n: f"{struct}.{n}")
    names = [f.name for f in schema.fields]
    one = df.agg(F.count("*").alias("_rows"), *[F.count(path(n)).alias(n) for n in names])
    out = F.array(*[F.struct(F.lit(f.name).alias("field"), F.lit(f.dataType.typeName()).alias("type"),
                             F.col(f.name).alias("present"), F.col("_rows").alias("rows")) for f in schema.fields])
    return one.select(F.explode(out).alias("x")).select("x.*")


def facets(df: DataFrame, *sets: tuple[str, ...]) -> DataFrame:
    """Counts for several facet combinations in one pass (grouping sets)."""
    fields = list(dict.fromkeys(f for s in sets for f in s))
    grouped = df.groupingSets([[F.col(f) for f in s] for s in sets], *[F.col(f) for f in fields])
    return grouped.agg(F.count("*").alias("n"))


def array_facet(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.explode(column).alias("value")).groupBy("value").agg(F.count("*").alias("n"))
