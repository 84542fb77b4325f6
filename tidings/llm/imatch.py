"""I-Match document fingerprints with randomised lexicons.

The lexicon holds the terms within a band of inverse document frequency.  A
document's distinct lexicon terms are sorted and hashed once per lexicon
subset.  A subset (lane, scale) holds the terms whose hash ends, from bit
4 x lane on, in ``scale`` zeros: one term in 2^scale.  A document uses the
scale that leaves it one or two terms per lane, and the next, so two texts
share a lane as long as none of its few terms changed.  DataFrame functions
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidings.llm.common import ascii_lower, words
from tidings.session import materialize, within

LANES = 14
COMMON, RARE = 20, 2000     # a lexicon term is in 1/RARE to 1/COMMON of the documents, in two at least
BROADCAST_TERMS = 1_000_000  # lexicon rows broadcast at most; beyond it the join shuffles
BLOCK_DOCS, BLOCKS, CUTS = 512, 65_536, 256


def terms(text: Column) -> Column:
    return F.array_distinct(words(ascii_lower(text)))


def lexicon(docs: DataFrame, common: int = COMMON, rare: int = RARE) -> DataFrame:
    """term, h: terms within the band, over all documents.

    A term is in at least n/rare documents, so the lexicon has at most rare x
    (distinct terms of an average document) rows, however large the corpus.
    """
    n = docs.count()
    df = docs.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    kept = df.where((F.col("df") >= max(2, n / rare)) & (F.col("df") <= max(2, n / common)))
    return materialize(kept.select("term", F.xxhash64("term").alias("h")), "lexicon")


def signature(found: Column, fallback: Column) -> Column:
    """Fingerprint of an array of (term, h): scale and two rows of lane hashes.

    Without lexicon terms it is scale x and the fallback digest alone.
    """
    n = F.size(found)
    scale = F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double"))).cast("int")

    def lane(of, mask, k):
        return F.filter(of, lambda t: F.call_function("shiftrightunsigned", t["h"], k * 4).bitwiseAND(mask) == 0)

    def code(picked):
        joined = F.concat_ws(" ", F.transform(picked, lambda t: t["term"]))
        return F.when(F.size(picked) == 0, F.lit("-")).otherwise(F.substring(F.hex(F.xxhash64(joined)), 1, 8))

    # each lane is filtered once; the next scale filters the few terms left
    mask, next_mask = (F.call_function("shiftleft", F.lit(1).cast("bigint"), scale + i) - 1 for i in (0, 1))
    lanes = F.transform(F.sequence(F.lit(0), F.lit(LANES - 1)), lambda k: F.struct(k.alias("k"), lane(found, mask, k).alias("p")))
    both = F.transform(lanes, lambda e: F.struct(code(e["p"]).alias("a"), code(lane(e["p"], next_mask, e["k"])).alias("b")))
    text = F.transform(F.array(both), lambda b: F.concat_ws(
        ":", scale.cast("string"), F.concat_ws(",", F.transform(b, lambda x: x["a"])), F.concat_ws(",", F.transform(b, lambda x: x["b"]))))
    return F.when(n == 0, F.concat(F.lit("x:"), F.substring(fallback, 1, 16))).otherwise(F.element_at(text, 1))


def likeness(a: Column, b: Column) -> Column:
    """Share of the lanes filled in either fingerprint that agree, at a scale
    both have; 1 for equal fingerprints, 0 when the scales are apart."""
    pa, pb = F.split(a, ":"), F.split(b, ":")
    sa, sb = pa[0].try_cast("int"), pb[0].try_cast("int")
    shared = F.when(sa == sb, F.struct(pa[1].alias("a"), pb[1].alias("b"))) \
        .when(sa == sb + 1, F.struct(pa[1].alias("a"), pb[2].alias("b"))).when(sb == sa + 1, F.struct(pa[2].alias("a"), pb[1].alias("b")))
    pairs = F.arrays_zip(F.split(shared["a"], ",").alias("a"), F.split(shared["b"], ",").alias("b"))
    filled = F.size(F.filter(pairs, lambda p: (p["a"] != "-") | (p["b"] != "-")))
    same = F.size(F.filter(pairs, lambda p: (p["a"] != "-") & (p["a"] == p["b"])))
    return F.when(a == b, 1.0).when(shared.isNull() | (filled == 0), 0.0).otherwise(same / filled).cast("double")


def with_terms(docs: DataFrame, texts: dict[str, Column], lex: DataFrame, keys: list[str], kept: dict[str, Column]) -> DataFrame:
    """``keys`` and ``kept`` with, per name in ``texts``, the sorted (term, h)
    of the lexicon in that text.

    Each text gives its distinct terms; those in the lexicon are gathered per
    row again.  ``keys`` must tell the rows apart, and ``docs`` should be
    partitioned by the first of them: then the corpus is not shuffled here.
    A mark that every lexicon holds keeps rows without terms.
    """
    names = list(texts)
    rows = docs.select(*keys, F.struct(*[c.alias(n) for n, c in kept.items()]).alias("_kept"), *[terms(c).alias(n) for n, c in texts.items()])
    mark = "array(named_struct('text', -1, 'term', ' ', 'kept', _kept))"
    lists = [f"transform(`{n}`, t -> named_struct('text', {i}, 'term', t, 'kept', if(true, null, _kept)))" for i, n in enumerate(names)]
    flat = rows.select(*keys, F.explode(F.expr(f"concat({', '.join([mark, *lists])})")).alias("_e")).select(*keys, "_e.*")
    marked = lex.unionByName(lex.sparkSession.createDataFrame([(" ", 0)], "term string, h long"))
    side = F.broadcast(marked) if within(lex, BROADCAST_TERMS) else marked
    hit = flat.join(side, "term")
    entry = F.struct("term", "h")
    found = hit.groupBy(*keys).agg(F.max("kept").alias("kept"), *[
        F.sort_array(F.collect_list(F.when(F.col("text") == i, entry))).alias(n) for i, n in enumerate(names)])
    return found.select(*keys, "kept.*", *names)


def fingerprints(docs: DataFrame, lex: DataFrame | None = None) -> DataFrame:
    """doc_id, fingerprint of every row; null texts count as empty ones."""
    lex = lexicon(docs) if lex is None else lex
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_row"))
    found = with_terms(rows, {"own": F.col("text")}, lex, ["_row"], {"doc_id": F.col("doc_id"), "own_sha": F.sha2("text", 256)})
    return found.select("doc_id", signature(F.col("own"), F.col("own_sha")).alias("fingerprint"))


# --- a text beside its edited form and its neighbour -----------------------------

def blocks(ids: DataFrame) -> Column:
    """Number of the block of neighbouring doc_ids a row is in; nulls first.

    Cut at quantiles, then evenly between them, so the driver holds CUTS
    numbers and blocks stay even where ids are not dense.
    """
    n, *_ = ids.agg(F.count("*")).first()
    want = max(1, min(BLOCKS, -(-n // BLOCK_DOCS)))
    parts = min(CUTS, want)
    per = -(-want // parts)
    cuts = ids.agg(F.percentile_approx("doc_id", [i / parts for i in range(parts + 1)], 10_000)).first()[0]
    cuts = sorted(set(cuts or [0]))
    if len(cuts) == 1:
        return F.lit(0)
    lows = F.array(*map(F.lit, cuts[:-1]))
    at = F.greatest(F.lit(1), F.size(F.filter(lows, lambda b: b <= F.col("doc_id"))))
    low, high = F.element_at(lows, at), F.element_at(F.array(*map(F.lit, cuts[1:])), at)
    inner = F.least(F.lit(per - 1), F.greatest(F.lit(0), F.floor((F.col("doc_id") - low) * F.lit(float(per)) / (high - low))))
    return F.coalesce(((at - 1) * per + inner).cast("int"), F.lit(-1))


def edited(text: Column, following: Column) -> Column:
    """The last quarter replaced by as much of the following text's start."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(following, F.lit(1), quarter))


def with_next(docs: DataFrame) -> DataFrame:
    """block, place, doc_id, text, next_text by ascending doc_id, the first
    after the last.  Nulls come first; equal ids are ordered by text.

    The corpus is dealt once, by block.  The first rows of the blocks (at most
    BLOCKS ids, a stated bound) are also sent to the block before.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    block = blocks(rows)
    cut = rows.withColumn("block", block)
    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    firsts = cut.groupBy("block").agg(F.min(F.struct("doc_id")).alias("head")).select("block", F.col("head.doc_id").alias("head"))   # a struct: null counts as first
    ring = Window.orderBy("block")
    back = materialize(firsts.select("block", "head", F.coalesce(F.lag("block").over(ring), F.max("block").over(
        ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("to")), "heads")
    heads = (cut.join(F.broadcast(back.withColumnRenamed("block", "_b")), (F.col("block") == F.col("_b")) & F.col("doc_id").eqNullSafe(F.col("head")))
             .select("doc_id", "text", F.col("to").alias("block"), F.lit(1).alias("extra")))
    both = cut.select("doc_id", "text", "block", F.lit(0).alias("extra")).unionByName(heads)
    w = Window.partitionBy("block").orderBy("extra", *order)
    return both.select("block", F.row_number().over(w).alias("place"), "doc_id", "text", "extra",
                       F.lead("text").over(w).alias("next_text")).where(F.col("extra") == 0).drop("extra")


def compare_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of every row (see ``edited`` and ``likeness``).

    A text alone in the table is its own follower.  Equal texts have equal
    fingerprints; empty ones share that of the empty text.
    """
    lex = lexicon(docs)
    pairs = with_next(docs)
    text, following = F.col("text"), F.col("next_text")
    changed = edited(text, following)
    found = with_terms(
        pairs, {"own": text, "other": changed}, lex, ["block", "place"],
        {"doc_id": F.col("doc_id"), "n_chars": F.length(text).cast("long"), "own_sha": F.sha2(text, 256), "edited_sha256": F.sha2(changed, 256)})
    coded = materialize(found.select("block", "place", "doc_id", "n_chars", "edited_sha256", signature(F.col("own"), F.col("own_sha")).alias("fingerprint"),
                                     signature(F.col("other"), F.col("edited_sha256")).alias("edited_fingerprint")), "imatch")
    return near(coded)


def near(coded: DataFrame) -> DataFrame:
    """Adds the likeness to the edited form and to the next row by place.

    Works on fingerprints alone; the last row of a block looks at the first
    of the next block, the last block at the first."""
    w = Window.partitionBy("block").orderBy("place")
    first = coded.where(F.col("place") == 1).select("block", F.col("fingerprint").alias("head"))
    ring = Window.orderBy("block")
    wrap = first.select("block", F.coalesce(F.lead("head").over(ring), F.first("head").over(
        ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("wrap"))
    led = coded.withColumn("after", F.lead("fingerprint").over(w)).join(F.broadcast(wrap), "block")
    fp = F.col("fingerprint")
    return led.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      likeness(fp, F.col("edited_fingerprint")).alias("near_edited"), likeness(fp, F.coalesce("after", "wrap")).alias("near_next"))
