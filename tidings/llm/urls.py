"""URL filters: stated host and path rules, then mined association rules.

FP-growth finds token combinations that go with a bad label.  Rules below the
support or confidence are pruned, as are rules that a shorter one covers at
no less confidence.  An inverted index matches them: each rule stands under
the token that the fewest rules hold, and fires on a url with that token when
the url has its others too.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import ascii_lower
from tidings.session import materialize, small

# Verdict, then host and path prefix.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
SUPPORT, CONFIDENCE = 0.005, 0.5   # of the labelled pages; of those with the tokens
LEAST = 20                         # labelled pages a rule rests on at least
BAD = "label=bad"
BROADCAST_RULES = 200_000          # index rows broadcast at most; beyond it the join shuffles


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for a null url or one without ://."""
    text = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(text, r"(?s)\A.*?://([^/?#]*)", 1)
    path = F.regexp_extract(text, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def stated(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest stated rule that fits, else nulls.

    A rule fits its host and every subdomain of it.  The list is a setting
    (some hundred entries at most, or none); equal lengths go by list order.
    """
    rule = verdict = F.lit(None).cast("string")
    found = []
    for kind, text in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found.append((fits, text, kind))
    for fits, text, kind in reversed(found):
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens of a url: scheme, host labels, path pieces, query keys.

    Numbers count as one token, so page numbers combine into a pattern.
    """
    text = F.coalesce(url, F.lit(""))
    host, path = parts(url)
    scheme = F.regexp_extract(text, r"(?s)\A(.*?)://", 1)
    pieces = F.transform(F.regexp_extract_all(ascii_lower(path), F.lit(r"[^/.]+"), 0),
                         lambda p: F.concat(F.lit("path="), F.when(p.rlike(r"\A[0-9]+\z"), F.lit("#")).otherwise(p)))
    hosts = F.transform(F.regexp_extract_all(host, F.lit(r"[^.]+"), 0), lambda p: F.concat(F.lit("host="), p))
    keys = F.transform(F.regexp_extract_all(ascii_lower(text), F.lit(r"[?&]([^=&#]+)"), 1), lambda p: F.concat(F.lit("key="), p))
    ending = F.when(text.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(F.concat(F.lit("scheme="), ascii_lower(scheme))), hosts, pieces, keys, ending))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """rule_id, tokens, confidence, support of rules tokens -> bad.

    ``labelled`` has url and bad (boolean; null rows are left out).  No rows
    or no bad rows give no rules.  FP-growth deals its conditional trees by
    item; its result is bounded by the support, not by the input.
    """
    items = labelled.where(F.col("bad").isNotNull()).select(
        F.when(F.col("bad"), F.concat(tokens(F.col("url")), F.array(F.lit(BAD)))).otherwise(tokens(F.col("url"))).alias("items"))
    items = materialize(items, "transactions")
    n = items.count()
    if n == 0:
        return labelled.sparkSession.createDataFrame([], "rule_id long, tokens array<string>, confidence double, support double")
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(support, LEAST / n)), minConfidence=confidence).fit(items)
    found = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD))).select(
        F.sort_array("antecedent").alias("tokens"), "confidence", "support")
    return prune(materialize(found, "rules"))


def prune(rules: DataFrame) -> DataFrame:
    """Without rules whose tokens hold those of another of no less confidence.

    A covering rule is found like a url's: under its rarest token, which the
    covered rule must hold, with the rest checked there.
    """
    rules = materialize(rules.withColumn("rule_id", F.xxhash64(F.concat_ws("\0", "tokens"))), "mined")
    other = index(rules).select("token", F.col("confidence").alias("by_c"), F.col("tokens").alias("by"))
    covered = (rules.select("rule_id", "confidence", "tokens", F.explode("tokens").alias("token")).join(other, "token")
               .where((F.size("by") < F.size("tokens")) & (F.col("by_c") >= F.col("confidence")) & holds("tokens", "by"))
               .select("rule_id").distinct())
    return materialize(rules.join(covered, "rule_id", "left_anti").select("rule_id", "tokens", "confidence", "support"), "pruned")


def holds(tokens: str, wanted: str) -> Column:
    """Whether an array of distinct tokens has all of another."""
    return F.size(F.array_intersect(tokens, wanted)) == F.size(wanted)


def index(rules: DataFrame) -> DataFrame:
    """One row per rule (token, rule_id, confidence, tokens): the token is the one that
    the fewest rules hold, then the first by text, so that common ones bring few rules."""
    held = rules.select("rule_id", F.explode("tokens").alias("token"))
    counts = held.groupBy("token").agg(F.count("*").alias("rules"))
    rarest = held.join(counts, "token").groupBy("rule_id").agg(F.min(F.struct("rules", "token")).alias("rare"))
    return rules.join(rarest, "rule_id").select(F.col("rare.token").alias("token"), "rule_id", "confidence", "tokens")


def fired(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, mined_rule, mined_confidence of the surest rule per distinct url
    that any rule fits; ties go to the smaller rule id."""
    postings = small(materialize(index(rules), "postings"), BROADCAST_RULES)
    asked = urls.select("url").where(F.col("url").isNotNull()).distinct().withColumn("have", tokens(F.col("url")))
    hits = (asked.withColumn("token", F.explode("have")).join(postings, "token").where(holds("have", "tokens"))
            .select("url", "rule_id", "confidence"))
    best = hits.groupBy("url").agg(F.max(F.struct("confidence", (-F.col("rule_id")).alias("id"))).alias("best"))
    return best.select("url", (-F.col("best.id")).alias("mined_rule"), F.col("best.confidence").alias("mined_confidence"))


def label_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """url and bad of the pages whose document is labelled: low quality or
    toxic.  Several labels of one document count as bad if any is."""
    bad = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)).alias("bad"))
    return pages.select("page_id", "url").join(bad, F.col("page_id") == F.col("doc_id")).select("url", "bad")


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, **options) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule, mined_confidence of every row.

    A stated rule decides; without one, a mined rule blocks; without that the
    url is allowed.  Null urls have empty host and path and are allowed.
    """
    mined = mine(label_pages(pages, labels), **options)
    hits = materialize(fired(pages, mined), "fired")
    host, path = parts(F.col("url"))
    cut = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = stated(F.col("host"), F.col("path"), rules)
    joined = cut.join(hits.withColumnRenamed("url", "_url"), F.col("url") == F.col("_url"), "left")
    method = F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "mined_rule", "mined_confidence")
