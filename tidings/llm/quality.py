"""Quality classifier: random Fourier features and ridge regression.

Document statistics, standardised, pass through cosines of random projections
(their inner products approximate a Gaussian kernel).  Tasks sum the normal
equations of their rows; the sums are added per matrix row, and the driver
solves one small system.  Isotonic regression on rows kept apart turns the
ridge score into a probability.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import packed
from tidings.session import materialize, small

FEATURES = 256             # random projections
WIDTH = 4.0                # Gaussian kernel width, in standard deviations
RIDGE = 1e-3               # times the number of rows
BINS = 1024                # of the ridge score, for calibration
PARTS = 32                 # tasks that sum normal equations
THRESHOLD = 0.7
BROADCAST_IDS = 2_000_000   # labelled ids broadcast at most; beyond it the join shuffles
SEED = 11

STATS = ("chars", "words", "lines", "word_len", "word_dev", "distinct_words", "repeat_word", "upper", "lower", "digit", "space", "punct",
         "other_ascii", "high", "line_len", "distinct_lines", "line_end", "pair_repeat", "symbol_words", "upper_words", "long_words",
         "byte_entropy", "top_word", "caps_line")
_PUNCT = [ord(c) for c in ".,;:'\"()-?"]
_SYMBOL = re.compile(rb"[^\w\s.,;:'\"()\-?\x80-\xff]")


def describe(text: str | None) -> list[float]:
    """Statistics of one whole text; of a null or empty one all zeros."""
    data = (text or "").encode("utf-8", "replace")
    if not data:
        return [0.0] * len(STATS)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = len(data)
    share = counts[counts > 0] / n
    words, lines = data.split(), data.split(b"\n")
    m = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False)))
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    punct = counts[_PUNCT].sum()
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), sizes.mean(), sizes.std(), len(seen) / m,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / m, upper / n, lower / n, counts[48:58].sum() / n,
        (counts[32] + counts[9:14].sum()) / n, punct / n, (counts[33:127].sum() - upper - lower - counts[48:58].sum() - punct) / n, counts[128:].sum() / n,
        np.log1p(n / len(lines)), len(set(lines)) / len(lines), sum(x.rstrip()[-1:] in b".!?" and bool(x.strip()) for x in lines) / len(lines),
        1 - pairs / max(1, len(words) - 1), len(_SYMBOL.findall(data)) / m, sum(map(bytes.isupper, words)) / m, float((sizes > 15).mean()),
        float(-(share * np.log2(share)).sum()), max(seen.values(), default=0) / m, sum(map(bytes.isupper, lines)) / len(lines)]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and stats (array) of every whole text."""
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "stats": [np.asarray(describe(t)) for t in pdf["text"]]})
    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, stats array<double>")


@dataclass
class Model:
    mean: np.ndarray
    dev: np.ndarray
    weights: np.ndarray
    low: float
    high: float
    table: np.ndarray       # calibrated score at the middle of each bin

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return expand(stats, self.mean, self.dev) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        at = (self.raw(stats) - self.low) / (self.high - self.low) * BINS - 0.5
        return np.clip(np.interp(at, np.arange(BINS), self.table), 0.0, 1.0)


def expand(stats: np.ndarray, mean: np.ndarray, dev: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, with a constant."""
    rng = np.random.default_rng(SEED)
    project, phase = rng.normal(0, 1 / WIDTH, (len(STATS), FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES)
    z = np.clip((stats - mean) / dev, -8, 8)
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ project + phase), np.ones((len(z), 1))])


def _rows(pdf: pd.DataFrame) -> np.ndarray:
    return np.vstack(pdf["stats"].to_numpy()) if len(pdf) else np.zeros((0, len(STATS)))


def monotone(positive: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Isotonic fit of shares over bins (pool adjacent violators); empty bins
    are interpolated.  No rows at all give 0.5."""
    used = np.flatnonzero(total)
    if not len(used):
        return np.full(len(total), 0.5)
    blocks: list[list[float]] = []
    for i in used:
        blocks.append([positive[i], total[i], 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p, t, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + p, blocks[-1][1] + t, blocks[-1][2] + k]
    fit = np.concatenate([np.full(k, p / t) for p, t, k in blocks])
    return np.interp(np.arange(len(total)), used, fit)


def fit(rows: DataFrame) -> Model | None:
    """Fit on rows of stats, label (0 or 1) and calibrate (boolean): ridge on
    the others, calibration on those.  None without rows to fit on.

    What reaches the driver has a fixed size: moments, one matrix of FEATURES
    squared and BINS pairs of counts.
    """
    train = rows.where(~F.col("calibrate"))
    moments = train.select(F.posexplode("stats").alias("i", "x")).groupBy("i").agg(F.avg("x"), F.stddev_pop("x")).orderBy("i").collect()
    if not moments:
        return None
    mean, dev = np.array([r[1] for r in moments]), np.array([max(r[2], 1e-6) for r in moments])
    d = FEATURES + 1

    def normal(batches):
        total = np.zeros((d, d + 1))
        for pdf in batches:
            z = expand(_rows(pdf), mean, dev)
            total += z.T @ np.hstack([z, pdf["label"].to_numpy(float)[:, None]])
        yield pd.DataFrame({"i": range(d), "sums": list(total)})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": pdf["i"].iloc[:1], "sums": [np.vstack(pdf["sums"].to_numpy()).sum(axis=0)]})

    parts = train.select("stats", "label").repartition(PARTS).mapInPandas(normal, "i int, sums array<double>")
    sums = np.vstack([r["sums"] for r in parts.groupBy("i").applyInPandas(add, "i int, sums array<double>").orderBy("i").collect()])
    gram, target = sums[:, :d], sums[:, d]
    weights = np.linalg.solve(gram + RIDGE * max(1.0, gram[-1, -1]) * np.eye(d) / FEATURES, target)
    model = Model(mean, dev, weights, -0.5, 1.5, np.zeros(BINS))

    def binned(batches):
        for pdf in batches:
            at = np.clip((model.raw(_rows(pdf)) - model.low) / (model.high - model.low) * BINS, 0, BINS - 1).astype(int)
            yield pd.DataFrame({"bin": at, "label": pdf["label"]})

    counts = (rows.where(F.col("calibrate")).select("stats", "label").mapInPandas(binned, "bin int, label int")
              .groupBy("bin").agg(F.sum("label").alias("positive"), F.count("*").alias("n")).collect())
    positive, total = np.zeros(BINS), np.zeros(BINS)
    for r in counts:
        positive[r["bin"]], total[r["bin"]] = r["positive"], r["n"]
    # a weak prior of one row per bin in use keeps single rows from deciding
    base = positive.sum() / max(1.0, total.sum())
    model.table = monotone(positive + base * (total > 0), total + (total > 0))
    return model


def remainder(doc_id, by: int):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by


def learn(stats: DataFrame, labels: DataFrame, held=(2,), calibrate=(3,)) -> Model | None:
    """Model from all labelled rows outside the held remainders of crc32(doc_id) mod 4.

    A null quality is no label; several labels of a document count once, the
    larger.
    """
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("label"))
    r = remainder(F.col("doc_id"), 4)
    mine = stats.where(~r.isin(*held)).join(known.where(~r.isin(*held)), "doc_id")
    return fit(materialize(mine.select("stats", F.col("label").cast("int").alias("label"), r.isin(*calibrate).alias("calibrate")), "labelled"))


def scores(stats: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score in 0 to 1; 0.5 everywhere without a model."""
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": model.score(_rows(pdf)) if model is not None and len(pdf) else 0.5})
    return stats.mapInPandas(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, held=(2,)) -> DataFrame:
    """doc_id, score, predicted of every row.  Texts are read once; their
    statistics are written.  Repeated rows score alike."""
    stats = materialize(statistics(docs), "stats")
    scored = scores(stats, learn(stats, labels, held))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` predicted good, with all their columns; all rows
    when there is nothing to learn from.

    Only labelled rows are described for learning; scoring filters in place,
    so no text is shuffled unless the labels outgrow a broadcast.
    """
    ids = small(materialize(labels.where(F.col("quality").isNotNull()).select("doc_id").distinct(), "ids"), BROADCAST_IDS)
    model = learn(materialize(statistics(docs.join(ids, "doc_id", "left_semi")), "stats"), labels)
    if model is None:
        return docs

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.vstack([describe(t) for t in text])) if len(text) else np.zeros(0))

    return docs.select(packed(docs), score("text").alias("_score")).where(F.col("_score") >= THRESHOLD).select("_doc.*")
