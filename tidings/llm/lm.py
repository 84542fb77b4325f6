"""Language-model scoring by a weighted backoff automaton.

Smoothed n-grams of the training documents become an automaton: a state per
known word, an arc per known word pair with the smoothed log-probability, and
per state a failure arc to the root with the backoff weight.  An arc mixes
pair and word estimate (Jelinek-Mercer); the root's arcs are add-one
estimates over the known words and one class of unknown ones, so the arcs of
a state, taken with its failure arc, sum to one.  Reading a text
is one left-to-right traversal that carries the state and adds up arcs.

The automaton of a corpus does not fit one machine.  The documents are dealt
into chunks; each chunk asks for the counts of its own words and pairs (see
``blocks``) and builds the part of the automaton its texts can reach.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.llm import blocks
from tidings.llm.common import chunked

TRUST = 0.15        # share of the pair estimate in an arc; the rest is the word's own
FLUSH = 300_000     # distinct words a task holds before it sends their counts
HELD = 2            # remainder of crc32(doc_id) mod 7 that is not learnt from
END = b" "          # stands for the end of a text; no word holds a space


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 7 == HELD if doc_id is not None else False


def tokens(text: str | None) -> list[bytes]:
    """A-Z lower-cased words and the end."""
    return (text or "").encode("utf-8", "replace").lower().split() + [END]


class Chunk:
    """Tokens of a chunk's documents as local numbers, one document after another."""

    def __init__(self, pdf: pd.DataFrame):
        pdf = pdf.sort_values("doc_id", kind="stable")
        self.doc_ids = pdf["doc_id"].astype("Int64")
        self.held = np.array([held_out(None if d is pd.NA else d) for d in self.doc_ids], bool)
        numbers: dict[bytes, int] = {}
        parts, lengths = [], []
        for text in pdf["text"]:
            words = tokens(text)
            for w in words:
                if w not in numbers:
                    numbers[w] = len(numbers)
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            lengths.append(len(words))
        self.lengths = np.array(lengths, np.int64)
        self.ids = np.concatenate(parts)
        self.ends = np.cumsum(self.lengths)
        self.learnt = np.repeat(~self.held, self.lengths)
        raw = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
        order = np.argsort(raw)
        self.words = raw[order]                 # sorted codes of the distinct words
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.ids = place[self.ids]              # a word's number is its place among the codes
        # the pair of each token with the one before; the first of a text has none
        inner = np.ones(len(self.ids), bool)
        inner[np.concatenate([[0], self.ends[:-1]])] = False
        self.inner = inner
        at = np.flatnonzero(inner)
        local, back = np.unique(self.ids[at - 1] * len(raw) + self.ids[at], return_inverse=True)
        codes = blocks.mix(self.words[local // len(raw)], self.words[local % len(raw)])
        order = np.argsort(codes)
        self.pairs, self.local = codes[order], local[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.pair_of = place[back]              # for the tokens of ``inner``

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of the distinct words and pairs."""
        words = np.bincount(self.ids[self.learnt], minlength=len(self.words))
        return words.astype(np.uint32), np.bincount(self.pair_of[self.learnt[self.inner]], minlength=len(self.pairs)).astype(np.uint32)


def _ask(n: int, with_pairs: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(pdf)
        words, pairs = c.counts()
        number = int(pdf["chunk"].iloc[0])
        rows = list(blocks.questions("word", number, n, c.words, words))
        return blocks.frame(rows + (list(blocks.questions("pair", number, n, c.pairs, pairs)) if with_pairs else []))
    return run


def _sums(distinct: np.ndarray, place: np.ndarray, data: list[bytes]) -> np.ndarray:
    counts = np.concatenate([blocks.unpack(d, np.uint32) for d in data])
    return np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.uint64)


def _vocabulary(n: int):
    """Word blocks of the training documents of a task, sent whenever many words are held."""
    def run(batches):
        counts: Counter = Counter()

        def blocks_of():
            raw = np.fromiter(map(xxhash.xxh64_intdigest, counts), np.uint64, len(counts))
            order = np.argsort(raw)
            sums = np.fromiter(counts.values(), np.uint32, len(counts))[order]
            counts.clear()
            return blocks.frame(list(blocks.questions("word", -1, n, raw[order], sums)))

        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"].astype("Int64"), pdf["text"], strict=True):
                if not held_out(None if doc_id is pd.NA else doc_id):
                    counts.update(tokens(text))
                if len(counts) > FLUSH:
                    yield blocks_of()
        yield blocks_of()
    return run


def _totals(pdf: pd.DataFrame) -> pd.DataFrame:
    keys = np.concatenate([blocks.unpack_keys(bytes(k)) for k in pdf["keys"]])
    counts = np.concatenate([blocks.unpack(bytes(d), np.uint32) for d in pdf["data"]])
    return pd.DataFrame({"tokens": [int(counts.sum(dtype=np.int64))], "known": [len(np.unique(keys))]})


class Automaton:
    """States are word numbers and the root (-1)."""

    def __init__(self, c: Chunk, words: np.ndarray, pairs: np.ndarray, total: int, distinct: int):
        p = (words + 1) / (total + distinct + 1)
        self.root = np.log10(p).tolist()
        self.fail = float(np.log10(1 - TRUST))
        have = np.flatnonzero(pairs)
        h, w = np.divmod(c.local[have], len(words))
        arcs = np.log10(TRUST * pairs[have] / words[h] + (1 - TRUST) * p[w])
        self.arcs = dict(zip(c.local[have].tolist(), arcs.tolist(), strict=True))
        self.known = (words > 0).tolist()
        self.n = len(words)

    def read(self, ids: list[int]) -> float:
        """log10 probability of one text."""
        arcs, n, known, root, fail = self.arcs, self.n, self.known, self.root, self.fail
        total, state = 0.0, -1
        for w in ids:
            if state >= 0:
                arc = arcs.get(state * n + w)
                total += fail + root[w] if arc is None else arc
            else:
                total += root[w]
            state = w if known[w] else -1
        return total


OUT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _score(n: int, total: int, distinct: int):
    def run(pdf: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame(columns=[x.split()[0] for x in OUT.split(", ")])
        c = Chunk(pdf)
        words = blocks.answered(replies, "word", c.words, n, np.uint64).astype(float)
        pairs = blocks.answered(replies, "pair", c.pairs, n, np.uint64).astype(float)
        base = np.log10((words + 1) / (total + distinct + 1))
        machine = Automaton(c, words, pairs, total, distinct)
        cuts = c.ends - c.lengths
        return pd.DataFrame({
            "doc_id": c.doc_ids.array, "held_out": c.held, "n_tokens": c.lengths,
            "n_known": np.add.reduceat((words > 0)[c.ids].astype(np.int64), cuts), "train_tokens": total,
            "base_score": np.add.reduceat(base[c.ids], cuts),
            "score": [machine.read(c.ids[a:b].tolist()) for a, b in zip(cuts, c.ends, strict=True)]})
    return run


def score(docs: DataFrame) -> DataFrame:
    """The columns of OUT for every row.

    Learns from the rows whose crc32(doc_id) mod 7 is not HELD, over whole
    texts.  A null text is an empty one: the end alone.  A null doc_id counts
    as learnt from.  Without training rows every word is unknown and only the
    class of unknown words has a probability.

    Text is dealt into chunks once; asking and scoring read that exchange.
    """
    parts, n = chunked(docs)
    seen = docs.select("doc_id", "text").mapInPandas(_vocabulary(n), blocks.BLOCK).groupBy("bucket").applyInPandas(_totals, "tokens long, known long")
    total, distinct = seen.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    asked = parts.groupBy("chunk").applyInPandas(_ask(n, True), blocks.BLOCK)
    replies = blocks.answer(asked, {"word": _sums, "pair": _sums})
    return parts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(_score(n, total, distinct), OUT)
