"""Spelling variant grouping.

Letters are hashed to a few symbols.  Two words one edit apart are at most one
edit apart in symbols too, so the full one-edit neighbourhood of each reduced
word, joined to the reduced vocabulary, finds every pair; the words themselves
decide.  A neighbourhood is a list of rolling hashes, each made in constant
time, so a word of a million letters costs millions of numbers and no copies
of itself.  Hashes of no word at all are mostly left out before the join with
a bitmap of fixed size, which lets all others through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidings.llm.common import ascii_lower
from tidings.session import materialize

RUN = r"[A-Za-zÀ-ÿ]"   # fixed value: letters of a word
LENGTH = 7                       # code points of a word at least
COUNT = 2                        # occurrences of a word at least
TIMES = 10                       # a form is that much more frequent than its variant
SLIP = 31                        # one of so many occurrences loses a letter
SYMBOLS = 8
BITS = 27                        # of a hash, in the bitmap: 16 MB whatever the vocabulary
CELLS = 1 << 22                  # hashes held at once in a task

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def occurrences(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """word, one row per run of letters long enough, after the slips; a null
    text has none and a null doc_id is written as nothing in front of the colon."""
    runs = docs.select("doc_id", F.explode_outer(F.regexp_extract_all("text", F.lit(f"{RUN}{{{length},}}"), 0)).alias("_run")).where("_run is not null")
    low = runs.select("doc_id", ascii_lower(F.col("_run")).alias("_run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("_run")).cast("binary"))
    hit = low.select("_run", h.alias("_h"))
    at = (F.col("_h") % F.char_length("_run")).cast("int")
    cut = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.char_length("_run")))
    word = F.when(F.col("_h") % SLIP == 0, cut).otherwise(F.col("_run"))
    return hit.select(word.alias("word")).where(F.char_length("word") >= length)


def vocabulary(docs: DataFrame, length: int = LENGTH, count: int = COUNT) -> DataFrame:
    """word, n of the words found often enough."""
    return occurrences(docs, length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= count)


def reduced(words: list[str]) -> np.ndarray:
    """Symbols (from 1) of words of equal length, one row each."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return ((points * _BASE >> np.uint64(61)) + np.uint64(1)).reshape(len(words), -1)


def _powers(n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, _BASE))])


def own_hash(symbols: np.ndarray) -> np.ndarray:
    return (symbols * _powers(symbols.shape[1])[:-1]).sum(axis=1, dtype=np.uint64)


def neighbourhood(symbols: np.ndarray) -> np.ndarray:
    """Hashes of every row itself and of all it becomes by deleting, replacing
    or inserting one symbol, one row each; some are equal."""
    n, size = symbols.shape
    power = _powers(size + 1)
    term = symbols * power[:size]
    before = np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(term, axis=1, dtype=np.uint64)], axis=1)
    whole = before[:, -1:]
    deleted = before[:, :-1] + (whole - before[:, 1:]) * _BACK
    found = [whole, deleted]
    moved = before + (whole - before) * _BASE
    for c in range(1, SYMBOLS + 1):
        found += [whole - term + np.uint64(c) * power[:size], moved + np.uint64(c) * power[:size + 1]]
    return np.concatenate(found, axis=1)


def spread(codes: np.ndarray) -> np.ndarray:
    """Well-mixed 63-bit numbers of the rolling hashes."""
    x = (codes ^ (codes >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) >> np.uint64(1)


def _blocks(words: pd.Series):
    """Rows of equal length, as many at once as CELLS allows."""
    size = words.str.len().to_numpy()
    order = np.argsort(size, kind="stable")
    start = 0
    while start < len(order):
        n = int(size[order[start]])
        stop = min(np.searchsorted(size[order], n, side="right"), start + max(1, CELLS // ((2 * SYMBOLS + 2) * (n + 1))))
        yield order[start:stop]
        start = stop


def _own(batches):
    for pdf in batches:
        code = np.zeros(len(pdf), np.int64)
        for at in _blocks(pdf["word"]):
            code[at] = spread(own_hash(reduced(pdf["word"].iloc[at].tolist()))).view(np.int64)
        yield pdf.assign(code=code)[["word", "n", "code"]]


def coded(words: DataFrame) -> DataFrame:
    """word, n, code: the hash of the reduced word."""
    return words.select("word", "n").mapInPandas(_own, "word string, n long, code long")


def _slot(code: Column) -> Column:
    return F.shiftright(code, 63 - BITS)


def bitmap(codes: DataFrame) -> np.ndarray:
    """One bit for each leading BITS bits of a code; pieces of 4 KB are put
    together in tasks, and 2^BITS / 8 bytes reach the driver at most."""
    slot = _slot(F.col("code")) + 1   # the bitmap functions count from 1
    parts = codes.select(F.bitmap_bucket_number(slot).alias("part"), F.bitmap_bit_position(slot).alias("bit")).groupBy("part").agg(
        F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros((1 << BITS) // 8, np.uint8)
    for r in parts.toLocalIterator():
        at = (r["part"] - 1) * 4096
        out[at:at + 4096] |= np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def asked(words: DataFrame, bits: np.ndarray) -> DataFrame:
    """word, n, code: the neighbourhood of every word, without most hashes that no word has."""
    shared = words.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        known = shared.value
        for pdf in batches:
            for block in _blocks(pdf["word"]):
                code = spread(neighbourhood(reduced(pdf["word"].iloc[block].tolist())))
                slot = (code >> np.uint64(63 - BITS)).astype(np.int64)
                row, col = np.nonzero(known[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                hits = pd.DataFrame({"row": block[row], "code": code[row, col].view(np.int64)}).drop_duplicates()
                yield pd.DataFrame({"word": pdf["word"].to_numpy()[hits["row"]], "n": pdf["n"].to_numpy()[hits["row"]], "code": hits["code"]})

    return words.select("word", "n").mapInPandas(run, "word string, n long, code long")


def near_words(words: DataFrame) -> DataFrame:
    """word, n, other, other_n: all pairs of words exactly one edit apart, both ways."""
    own = materialize(coded(words), "reduced")
    left = asked(own, bitmap(own))
    right = own.select(F.col("word").alias("other"), F.col("n").alias("other_n"), "code")
    one = (F.col("word") != F.col("other")) & (F.levenshtein("word", "other", 1) == 1)
    return left.join(right, "code").where((F.abs(F.char_length("word") - F.char_length("other")) <= 1) & one).drop("code")


def roots(forms: DataFrame) -> DataFrame:
    """word, root of (word, form): forms followed to the last.

    Each step is TIMES more frequent, so chains are short; a round doubles the
    steps taken.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        now = materialize(now.join(further, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        if not now.where("_moved").limit(1).count():
            return now.drop("_moved")
        now = now.drop("_moved")


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n of a table of distinct word and n.

    The form is the most frequent near word (ties: the least in code-point
    order) if it is ``times`` as frequent as the word, else null.  No near word: n_near is 0.
    Other columns are not read; an empty table stays empty.
    """
    words = materialize(words.select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    found = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(found, "word", "left")
    fits = -F.col("best.less") >= F.col("n") * times
    formed = materialize(joined.select("word", F.when(fits, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                       F.when(fits, -F.col("best.less")).alias("form_n")), "formed")
    ends = roots(formed.where("form is not null"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
