"""Spans of given names in texts, over tokens.

Runs of tokens as long as a name are hashed by prefix sums and tried in a
bitmap of all names; those let through are looked up.  Names of very many
lengths are paths of a trie of tokens with failure links instead.  Either way
a text is read once whatever the names.  Of the matches, the leftmost is taken, the longest of
those that begin there, and the next after its end.
"""

from __future__ import annotations

import functools
from collections import deque
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidings.functions import text
from tidings.session import materialize, small, within

BROADCAST_NAMES = 500_000   # distinct names the automaton holds at most: some 100 MB; beyond it names meet texts by joins
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_IS_WORD = np.zeros(0x110000, bool)   # by code point, as the pattern has it
for _low, _high in ((0, 0xD800), (0xE000, 0x110000)):
    for _w in _WORD.finditer("".join(map(chr, range(_low, _high)))):
        _IS_WORD[_low + _w.start():_low + _w.end()] = True
LENGTHS = 16                # different lengths of names looked up run by run; the automaton reads a text once for any number
FOUND = "gram string, first int, n int, start int, stop int"
_COLUMNS = [c.split()[0] for c in FOUND.split(", ")]
BITS_PER_NAME, MIN_BITS, MAX_BITS = 64, 20, 29   # of the bitmap of names: 64 MB at most
FLUSH = 100_000                                  # rows of likely names a task gathers before it hands them on
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


class Automaton:
    """Trie of token sequences; ``ends[k]`` is the length of the name that ends
    at node k, 0 for none, and ``further[k]`` the next node on the failure path that ends one."""

    def __init__(self, names: Iterable[str]):
        self.step: list[dict[str, int]] = [{}]
        self.ends, depth = [0], [0]
        for name in names:
            at = 0
            for token in name.split(" "):
                if token not in self.step[at]:
                    self.step[at][token] = len(self.step)
                    self.step.append({})
                    self.ends.append(0)
                    depth.append(depth[at] + 1)
                at = self.step[at][token]
            self.ends[at] = depth[at]
        self.fail, self.further = [0] * len(self.step), [0] * len(self.step)
        todo = deque(self.step[0].values())
        while todo:
            at = todo.popleft()
            back = self.fail[at]
            self.further[at] = back if self.ends[back] else self.further[back]
            for token, child in self.step[at].items():
                self.fail[child] = self._next(back, token)
                todo.append(child)

    def _next(self, at: int, token: str) -> int:
        while token not in self.step[at]:
            if at == 0:
                return 0
            at = self.fail[at]
        return self.step[at][token]

    def matches(self, tokens: list[str]) -> list[tuple[int, int]]:
        """(first token, number of tokens) of the longest name at each place."""
        longest: dict[int, int] = {}
        at = 0
        for i, token in enumerate(tokens):
            at = self._next(at, token)
            end = at if self.ends[at] else self.further[at]
            while end:
                n = self.ends[end]
                longest[i - n + 1] = max(longest.get(i - n + 1, 0), n)
                end = self.further[end]
        return sorted(longest.items())


def leftmost(matches: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Matches in order of their first token, without those that overlap an earlier one."""
    kept, free = [], 0
    for first, n in matches:
        if first >= free:
            kept.append((first, n))
            free = first + n
    return kept


def _in_tasks(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """The spans of at most some hundred thousand names of many lengths, by the automaton."""
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(grams.toArrow()["gram"].to_pylist()))

    def run(batches):
        for b in batches:
            at, rows = [], []
            for k, content in enumerate(b.column("content").to_pylist()):
                low = content.lower()
                places = leftmost(shared.value.matches(_WORD.findall(low)))
                rows += _located(list(_WORD.finditer(low)), places) if places else []
                at += [k] * len(places)
            yield _arrow(b, at, rows)

    return docs.mapInArrow(run, _schema(docs))


def _located(words: list, places: list[tuple[int, int]]) -> list[tuple]:
    return [(" ".join(w[0] for w in words[i:i + n]), i, n, words[i].start(), words[i + n - 1].end()) for i, n in places]


def _schema(docs: DataFrame) -> str:
    return f"doc_num {docs.schema['doc_num'].dataType.simpleString()}, {FOUND}"


@functools.lru_cache(maxsize=64)
def _weights(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base from 0 to n, and their inverses."""
    def powers(x):
        return np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, x, np.uint64))])
    return powers(_BASE), powers(_BACK)


def _spread(code: np.ndarray) -> np.ndarray:
    """Well-mixed 63-bit numbers of the codes."""
    x = (code ^ (code >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) >> np.uint64(1)


def _code_points(content: str) -> np.ndarray:
    return np.frombuffer(content.encode("utf-32-le"), np.uint32)


def _tokens(points: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every run of code points that are ``inside``."""
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    power, back = _weights(1 << len(points).bit_length())
    before = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * power[:len(points)], out=before[1:])
    return starts, ends, _spread((before[ends] - before[starts]) * back[starts])


def _name_codes(batches):
    """The code of every name: the sum of its tokens' hashes times the powers of the base."""
    for b in batches:
        names = b.column(0).to_pylist()
        points = _code_points("\n".join(names))
        starts, _, codes = _tokens(points, (points != ord(" ")) & (points != ord("\n")))
        first = np.unique(np.searchsorted(starts, np.cumsum([0, *(len(name) + 1 for name in names)])[:-1]))
        first = first[first < len(starts)]
        place = np.arange(len(starts)) - np.repeat(first, np.diff(first, append=len(starts)))
        power, _ = _weights(1 << int(place.max(initial=0)).bit_length())
        code = np.add.reduceat(codes * power[place], first) if len(first) else codes
        yield pa.RecordBatch.from_arrays([pa.array(_spread(code).view(np.int64))], names=["code"])


def _bitmap(grams: DataFrame, bits: int) -> np.ndarray:
    """One bit for each leading ``bits`` bits of a name's code; pieces of 4 KB
    are put together in tasks, and 2^bits / 8 bytes reach the driver at most."""
    slot = F.shiftright("code", 63 - bits) + 1   # the bitmap functions count from 1
    parts = grams.select("gram").mapInArrow(_name_codes, "code long").select(
        F.bitmap_bucket_number(slot).alias("part"), F.bitmap_bit_position(slot).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in parts.toLocalIterator():
        at = (r["part"] - 1) * 4096
        out[at:at + 4096] |= np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _likely(codes: np.ndarray, lengths: list[int], known: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """(first, n) of every run of tokens, of one of the lengths, whose code is in the bitmap; the longest of a place first."""
    size = len(codes)
    power, back = _weights(1 << size.bit_length())
    before = np.zeros(size + 1, np.uint64)
    np.cumsum(codes * power[:size], out=before[1:])
    out = []
    for n in lengths:
        if n > size:
            break
        code = _spread((before[n:] - before[:-n]) * back[:size - n + 1])
        slot = (code >> np.uint64(63 - bits)).astype(np.int64)
        hits = np.flatnonzero(known[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
        out += [(i, -n) for i in hits.tolist()]
    return [(i, -n) for i, n in sorted(out)]


def _runs(grams: DataFrame, lengths: list[int]):
    """A function from a batch of texts to (rows in the batch, their likely
    rows of FOUND in order), some at a time: runs of tokens as long as some name
    whose code is in a bitmap of all names' codes, which lets every name through."""
    bits = min(MAX_BITS, max(MIN_BITS, (BITS_PER_NAME * max(1, grams.count())).bit_length()))
    shared = grams.sparkSession.sparkContext.broadcast(_bitmap(grams, bits))

    def run(b):
        at, rows = [], []
        for k, content in enumerate(b.column("content").to_pylist()):
            low = content.lower()
            points = _code_points(low)
            starts, ends, codes = _tokens(points, _IS_WORD[points])
            places = _likely(codes, lengths, shared.value, bits)
            if not places:
                continue
            starts, ends = starts.tolist(), ends.tolist()
            at += [k] * len(places)
            rows += [(" ".join([low[starts[j]:ends[j]] for j in range(i, i + n)]), i, n, starts[i], ends[i + n - 1]) for i, n in places]
            if len(rows) >= FLUSH:
                yield at, rows
                at, rows = [], []
        yield at, rows

    return run


def _named(at: np.ndarray, rows: pa.RecordBatch, names: pa.Array) -> np.ndarray:
    """Places of those of the likely rows, in order by text (``at``), that are names and do not overlap an earlier one."""
    hits = np.flatnonzero(pc.is_in(rows.column("gram"), value_set=names))
    kept, text, free = [], None, 0
    for j, k, first, n in zip(hits.tolist(), at[hits].tolist(), *(rows.column(c).to_numpy()[hits].tolist() for c in ("first", "n")), strict=True):
        if k != text:
            text, free = k, 0
        if first >= free:
            kept.append(j)
            free = first + n
    return np.array(kept, np.int64)


def _fetched(grams: DataFrame):
    return grams.sparkSession.sparkContext.broadcast(grams.toArrow()["gram"].combine_chunks())


def _by_runs(docs: DataFrame, grams: DataFrame, runs) -> DataFrame:
    """The spans of names that fit into a task: likely runs are looked up where the text is read."""
    shared = _fetched(grams)

    def run(batches):
        for b in batches:
            for at, found in runs(b):
                rows = _arrow(b, at, found)
                yield rows.take(pa.array(_named(np.array(at, np.int64), rows, shared.value)))

    return docs.mapInArrow(run, _schema(docs))


def _by_text(docs: DataFrame, runs) -> DataFrame:
    """Likely runs, one row per text that has any: doc_num and a list for each column of FOUND, written."""
    def run(batches):
        for b in batches:
            for at, found in runs(b):
                flat = _arrow(b, at, found)
                first = np.flatnonzero(np.diff(np.array(at, np.int64), prepend=-1))
                ends = pa.array(np.r_[first, len(at)], pa.int32())
                yield pa.RecordBatch.from_arrays([flat.column("doc_num").take(pa.array(first)), *(pa.ListArray.from_arrays(ends, flat.column(c)) for c in _COLUMNS)],
                                                 names=["doc_num", *_COLUMNS])

    lists = ", ".join("{} array<{}>".format(*c.split()) for c in FOUND.split(", "))
    return materialize(docs.mapInArrow(run, f"doc_num {docs.schema['doc_num'].dataType.simpleString()}, {lists}"), "tried")


def _looked_up(tried: DataFrame, present: DataFrame) -> DataFrame:
    """Spans of written likely runs, by the names among them: nothing is shuffled."""
    shared = _fetched(present)

    def run(batches):
        for b in batches:
            at = np.repeat(np.arange(b.num_rows), pc.list_value_length(b.column("gram")).to_numpy())
            rows = pa.RecordBatch.from_arrays([b.column("doc_num").take(pa.array(at)), *(b.column(c).flatten() for c in _COLUMNS)], names=["doc_num", *_COLUMNS])
            yield rows.take(pa.array(_named(at, rows, shared.value)))

    return tried.mapInArrow(run, _schema(tried))


def _apart(batches):
    """Rows in order of text, first and falling n: those that do not overlap an earlier one of their text."""
    row, free = None, 0
    for b in batches:
        kept = []
        for k, (r, first, n) in enumerate(zip(*(b.column(c).to_pylist() for c in ("row", "first", "n")), strict=True)):
            if r != row:
                row, free = r, 0
            if first >= free:
                kept.append(k)
                free = first + n
        yield b.select(["doc_num", *_COLUMNS]).take(pa.array(kept, pa.int64()))


def _by_joins(tried: DataFrame, present: DataFrame) -> DataFrame:
    """The same spans for any number of names: likely runs become rows and meet the names by shuffle."""
    texts = tried.select("doc_num", *_COLUMNS, F.monotonically_increasing_id().alias("row"))   # before rows are made of it
    each = texts.select("doc_num", "row", F.explode(F.arrays_zip(*_COLUMNS)).alias("r")).select("doc_num", "row", "r.*")
    hits = each.join(present, "gram", "left_semi").repartition("row").sortWithinPartitions("row", "first", F.desc("n"))
    return hits.select("doc_num", *_COLUMNS, "row").mapInArrow(_apart, _schema(tried))


def _arrow(b: pa.RecordBatch, at: list[int], rows: list[tuple]) -> pa.RecordBatch:
    """Rows of FOUND beside the doc_num of their text."""
    cols = list(zip(*rows, strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays(
        [b.column("doc_num").take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, (pa.string(), *[pa.int32()] * 4), strict=True))],
        names=["doc_num", *_COLUMNS])


def _found(docs: DataFrame, grams: DataFrame, bound: int) -> tuple[DataFrame, DataFrame | None]:
    """Spans of the names, and a written table (gram) with the names among
    them when it is much smaller than all, else None.

    A text is read once.  While the names are within the bound they are looked
    up in the task that reads it; beyond it the likely runs of a text are
    written as one row, and the names among all of them, which the corpus
    bounds and not the number of names, are looked up there.  Only when those
    pass the bound too do runs and names meet by shuffle.
    """
    known = docs.where(F.col("content").isNotNull()).select("doc_num", "content")
    few = within(grams, bound)
    lengths = sorted(r[0] for r in grams.select(F.size(F.split("gram", " ")).alias("n")).distinct().collect())
    if few and len(lengths) > LENGTHS:
        return _in_tasks(known, grams), None
    runs = _runs(grams, lengths)
    if few:
        return _by_runs(known, grams, runs), None
    tried = _by_text(known, runs)
    present = materialize(tried.select(F.explode("gram").alias("gram")).distinct().join(grams, "gram", "left_semi"), "present")
    return (_looked_up if within(present, bound) else _by_joins)(tried, present), present


def _of(table: DataFrame, present: DataFrame | None, bound: int) -> DataFrame:
    """The rows of ``table`` (gram, ...) that spans can meet, for a broadcast when few."""
    if present is not None and within(present, bound):
        table = materialize(table.join(F.broadcast(present), "gram", "left_semi"), "present")
    return small(table, bound)


def occurrences(docs: DataFrame, gazetteer: DataFrame, bound: int = BROADCAST_NAMES) -> DataFrame:
    """doc_num, pos, alias, entity_id, type of every span of an alias.

    ``gazetteer`` (alias, entity_id, type) is a written table with one row per
    alias, its tokens joined by a blank; ``pos`` is the first token, from 0.
    """
    named = gazetteer.select(F.col("alias").alias("gram"), "entity_id", "type")
    found, present = _found(docs, named.select("gram"), bound)
    return found.select("doc_num", F.col("first").alias("pos"), "gram").join(_of(named, present, bound), "gram").select(
        "doc_num", "pos", F.col("gram").alias("alias"), "entity_id", "type")


def name_spans(docs: DataFrame, names: DataFrame, bound: int = BROADCAST_NAMES) -> DataFrame:
    """doc_num, entity_id, name, first, n, start, stop, score of every span.

    ``docs`` has doc_num (one row each) and content, ``names`` entity_id and
    name: any number of words, letters and frequency.  Names are cut into the
    same lower-cased tokens as texts; ``first`` and ``n`` count tokens,
    ``start`` and ``stop`` code points of the lower-cased text.  A span that
    several entities share is one row for each, and its score the share of one.
    """
    key = text.tokens(F.col("name"))
    named = materialize(names.select("entity_id", "name", F.array_join(key, " ").alias("gram")).where("gram != ''").distinct(), "names")
    grams = materialize(named.select("gram").distinct(), "grams")
    found, present = _found(docs, grams, bound)
    sharing = named.groupBy("gram").agg(F.round(1 / F.count_distinct("entity_id"), 6).alias("score"))
    return found.join(_of(materialize(named.join(sharing, "gram"), "shared"), present, bound), "gram").select(
        "doc_num", "entity_id", "name", "first", "n", "start", "stop", "score")
