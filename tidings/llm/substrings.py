"""Substring de-duplication by seed and extend.

Seeds are winnowed word n-grams: each window of WINDOW words has as its
anchor the smallest-coded n-gram in it, so equal windows have equal anchors
at equal places.  Consecutive windows with one anchor form a run; the words
it covers are the anchor extended both ways as far as it stays the anchor.

Documents meet on seeds.  Equal runs are settled as a class: of a passage
shared by thousands of documents one row per part of the corpus travels.
Only where a seed has several classes do their first documents compare the
extensions word by word, window for window.  Runs removed side by side join
into maximal repeats.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame

from tidings.llm import blocks
from tidings.llm.common import chunked

WINDOW, GRAM = 50, 16
NOBODY = np.iinfo(np.int64).max      # a null doc_id: smaller than none
_BASES = (0x9E3779B97F4A7C13, 0xC2B2AE3D27D4EB4B)   # odd, 3 mod 8


def _smallest(codes: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest code in each ``width`` codes, by doubling."""
    value, at, size = codes, np.arange(len(codes)), 1
    while size < width:
        step = min(size, width - size)
        n = len(value) - step
        left = value[:n] <= value[step:]
        value, at, size = np.where(left, value[:n], value[step:]), np.where(left, at[:n], at[step:]), size + step
    return at


class Texts:
    """The words of a chunk's documents one after another, and their runs."""

    def __init__(self, pdf: pd.DataFrame, window: int = WINDOW, gram: int = GRAM):
        pdf = pdf.sort_values("doc_id", kind="stable")
        self.doc_ids = pdf["doc_id"].astype("Int64")
        owner = self.doc_ids.fillna(NOBODY).to_numpy(np.int64)
        self.words: list[list[bytes]] = [(t or "").encode("utf-8", "replace").split() for t in pdf["text"]]
        self.lengths = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.window = window
        numbers: dict[bytes, int] = {}
        for words in self.words:
            for w in words:
                if w not in numbers:
                    numbers[w] = len(numbers)
        raw = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
        total = int(self.lengths.sum())
        ids = np.fromiter((numbers[w] for words in self.words for w in words), np.int64, total)
        self.sums, self.back = [], []
        with np.errstate(over="ignore"):
            for base, code in zip(_BASES, (raw, blocks.mix(raw, 1)), strict=True):
                power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(total, base, np.uint64))])
                self.back.append(np.concatenate([[np.uint64(1)], np.cumprod(np.full(total, pow(base, -1, 1 << 64), np.uint64))]))
                self.sums.append(np.concatenate([[np.uint64(0)], np.cumsum(code[ids] * power[:-1], dtype=np.uint64)]))
        valid = np.zeros(total, bool)
        for s, n in zip(self.starts.tolist(), self.lengths.tolist(), strict=True):
            valid[s:max(s, s + n - window + 1)] = True
        at = np.flatnonzero(valid)
        if not len(at):
            none = np.zeros(0, np.int64)
            self.first, self.last, self.owner, self.spans, self.seeds = none, none, none, np.zeros((0, 2), np.uint64), none.astype(np.uint64)
            return
        grams = blocks.mix(self.code(0, np.arange(total - gram + 1), gram))
        anchor = _smallest(grams, window - gram + 1)[at]
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
        begin = np.flatnonzero(new)
        self.first, self.last = at[begin], at[np.concatenate([begin[1:], [len(at)]]) - 1]   # window starts of each run
        self.owner = owner[np.searchsorted(self.starts, self.first, side="right") - 1]
        size = self.last - self.first + window
        shape = (size * (window + 1) + anchor[begin] - self.first).astype(np.uint64)
        self.spans = np.stack([blocks.mix(self.code(k, self.first, size), shape) for k in (0, 1)], axis=1)
        self.seeds = blocks.mix(grams[anchor[begin]])   # smallest codes are not evenly spread; mixed, they are

    def code(self, k: int, at: np.ndarray, size) -> np.ndarray:
        """k-th hash of ``size`` words from each place."""
        with np.errstate(over="ignore"):
            return (self.sums[k][at + size] - self.sums[k][at]) * self.back[k][at]

    def windows(self, at: np.ndarray) -> np.ndarray:
        return np.stack([blocks.mix(self.code(k, at, self.window)) for k in (0, 1)], axis=1)


def _least(known: np.ndarray, place: np.ndarray, data: list[bytes]) -> np.ndarray:
    """Smallest document per key."""
    out = np.full(len(known), NOBODY, np.int64)
    np.minimum.at(out, place, np.concatenate([blocks.unpack(d, np.int64) for d in data]))
    return out


def _several(known: np.ndarray, place: np.ndarray, data: list[bytes]) -> np.ndarray:
    """Whether a seed has more than one class: sent are its only class, or 0 for several."""
    sent = np.concatenate([blocks.unpack(d, np.uint64) for d in data])
    low, high = np.full(len(known), np.iinfo(np.uint64).max, np.uint64), np.zeros(len(known), np.uint64)
    np.minimum.at(low, place, sent)
    np.maximum.at(high, place, sent)
    return ((low != high) | (low == 0)).astype(np.uint8)


def _min_owner(place: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, NOBODY, np.int64)
    np.minimum.at(out, place, owner)
    return out


def _seed_classes(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(distinct seeds, their only class code or 0)."""
    seeds, place = blocks.distinct(t.seeds)
    codes = t.spans[:, 0] | np.uint64(1)
    low, high = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64), np.zeros(len(seeds), np.uint64)
    np.minimum.at(low, place, codes)
    np.maximum.at(high, place, codes)
    return seeds, np.where(low == high, low, np.uint64(0))


def _ask_runs(n: int, options: dict):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        t, number = Texts(pdf, **options), int(pdf["chunk"].iloc[0])
        spans, place = blocks.distinct(t.spans)
        return blocks.frame(list(blocks.questions("span", number, n, spans, _min_owner(place, t.owner, len(spans))))
                            + list(blocks.questions("seed", number, n, *_seed_classes(t))))
    return run


def _settled(t: Texts, replies: pd.DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs that start in a smaller document as they are; runs to be compared window by window."""
    spans, place = blocks.distinct(t.spans)
    seeds, of = blocks.distinct(t.seeds)
    least = blocks.answered(replies, "span", spans, n, np.int64)[place]
    several = blocks.answered(replies, "seed", seeds, n, np.uint8)[of].astype(bool)
    return least < t.owner, several & (least >= t.owner)


def _open_windows(t: Texts, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and owners of the windows of some runs."""
    count = (t.last - t.first + 1)[runs]
    at = np.repeat(t.first[runs] - np.cumsum(count) + count, count) + np.arange(count.sum())
    return at, np.repeat(t.owner[runs], count)


def _ask_windows(n: int, options: dict):
    def run(pdf: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return blocks.frame([])
        t = Texts(pdf, **options)
        _, open_runs = _settled(t, replies, n)
        at, owner = _open_windows(t, open_runs)
        keys, place = blocks.distinct(t.windows(at))
        return blocks.frame(list(blocks.questions("window", int(pdf["chunk"].iloc[0]), n, keys, _min_owner(place, owner, len(keys)))))
    return run


OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start: long, stop: long>>"


def _remove(n: int, options: dict, texts: bool):
    names = [c.split()[0] for c in OUT.split(", ")][:5]

    def run(pdf: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame(columns=names + ["text"] * texts)
        t = Texts(pdf, **options)
        whole, open_runs = _settled(t, replies, n)
        at, owner = _open_windows(t, open_runs)
        keys, place = blocks.distinct(t.windows(at))
        least = blocks.answered(replies, "window", keys, n, np.int64)[place]
        cover = np.zeros(int(t.lengths.sum()) + 1, np.int64)
        for first, stop in ((t.first[whole], t.last[whole] + t.window), (at[least < owner], at[least < owner] + t.window)):
            np.add.at(cover, first, 1)
            np.add.at(cover, stop, -1)
        gone = np.cumsum(cover)[:-1] > 0
        rows = []
        for doc_id, words, s in zip(t.doc_ids, t.words, t.starts.tolist(), strict=True):
            mask = gone[s:s + len(words)]
            kept = b" ".join([w for w, g in zip(words, mask.tolist(), strict=True) if not g]) if mask.any() else b" ".join(words)
            edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
            spans = [{"start": int(a), "stop": int(b)} for a, b in edge.reshape(-1, 2)]
            rows.append((doc_id, len(words), int(mask.sum()), hashlib.sha256(kept).hexdigest(), spans) + ((kept.decode(),) if texts else ()))
        return pd.DataFrame(rows, columns=names + ["text"] * texts, dtype=object).astype({"doc_id": "Int64"})
    return run


def dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans (and the kept text) of every row.

    Removed is each word covered by a window of ``window`` words that also
    starts in a document with a smaller doc_id; ``spans`` are the maximal
    ranges of removed words.  Windows are judged on the input.  A null or
    empty text has no words; rows of one doc_id are one document in this
    comparison; a null doc_id is smaller than none.

    Text is dealt into chunks once; the three steps read that exchange.
    """
    options = {"window": window, "gram": gram}
    parts, n = chunked(docs)
    by_chunk = parts.groupBy("chunk")
    runs = blocks.answer(by_chunk.applyInPandas(_ask_runs(n, options), blocks.BLOCK), {"span": _least, "seed": _several})
    asked = by_chunk.cogroup(runs.groupBy("chunk")).applyInPandas(_ask_windows(n, options), blocks.BLOCK)
    windows = blocks.answer(asked, {"window": _least})
    replies = runs.unionByName(windows)
    out = OUT + (", text string" if texts else "")
    return by_chunk.cogroup(replies.groupBy("chunk")).applyInPandas(_remove(n, options, texts), out)
