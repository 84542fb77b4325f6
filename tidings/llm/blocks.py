"""Packed questions and answers between parts of a corpus and hash buckets.

A part (``chunk``) of the documents asks about many 64-bit keys.  It sends
each bucket one block: its sorted distinct keys and a value for each, as
packed bytes.  A bucket sees the blocks of all chunks, works on the keys together
and answers each block in its own order, so an answer holds values only.  A
row costs 7 to 24 bytes instead of a full record, and a key that holds a third
of the corpus still reaches its bucket once per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame

BLOCK = "bucket int, chunk int, kind string, keys binary, data binary, size long"

_FAST = zstandard.ZstdCompressor(level=1)
_OPEN = zstandard.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    return _FAST.compress(np.ascontiguousarray(values).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(_OPEN.decompress(data), dtype)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted codes as differences, byte by byte: the upper bytes of the
    differences are mostly zero and vanish.  Pairs of codes are kept as they are."""
    if keys.ndim == 2:
        return b"2" + keys.tobytes()
    steps = np.diff(keys, prepend=np.uint64(0))
    return b"1" + pack(steps.view(np.uint8).reshape(-1, 8).T)


def unpack_keys(data: bytes) -> np.ndarray:
    if data[:1] == b"2":
        return np.frombuffer(data[1:], np.uint64).reshape(-1, 2)
    steps = np.ascontiguousarray(unpack(data[1:], np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def mix(a: np.ndarray, b: np.ndarray | int = 0) -> np.ndarray:
    """One well-spread 64-bit code of two (order matters)."""
    with np.errstate(over="ignore"):
        x = (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(b, np.uint64)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the high bits, so sorted keys are in bucket order."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def questions(kind: str, chunk: int, buckets: int, keys: np.ndarray, data: np.ndarray) -> Iterator[tuple]:
    """Blocks of sorted distinct ``keys`` with one row of ``data`` each.

    Keys are one code a row, or two (shape n x 2) where 64 bits would let
    different ones meet.
    """
    first = keys if keys.ndim == 1 else keys[:, 0]
    cuts = np.searchsorted(bucket_of(first, buckets), np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        part = slice(cuts[b], cuts[b + 1])
        yield int(b), chunk, kind, pack_keys(keys[part]), pack(data[part]), int(cuts[b + 1] - cuts[b])


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct keys, place of each row among them); keys as in ``questions``."""
    if keys.ndim == 1:
        return np.unique(keys, return_inverse=True)
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[new], place


def frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in BLOCK.split(", ")], dtype=object)


def answer(blocks: DataFrame, answers: dict[str, Callable]) -> DataFrame:
    """Answers of each bucket to its blocks, per kind.

    A function takes the sorted distinct keys of the bucket, for each sent row
    the place of its key among them, and the sent data of all blocks one after
    another; it returns one value per key.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for kind, part in pdf.sort_values(["kind", "chunk"]).groupby("kind", sort=True):
            keys = np.concatenate([unpack_keys(bytes(k)) for k in part["keys"]])
            known, place = distinct(keys)
            values = answers[kind](known, place, [bytes(d) for d in part["data"]])
            ends = np.cumsum(part["size"].to_numpy())
            for b, c, size, end in zip(part["bucket"], part["chunk"], part["size"], ends, strict=True):
                out.append((b, c, kind, None, pack(values[place[end - size:end]]), size))
        return frame(out)
    return blocks.groupBy("bucket").applyInPandas(run, BLOCK)


def answered(pdf: pd.DataFrame, kind: str, keys: np.ndarray, buckets: int, dtype) -> np.ndarray:
    """Values for sorted distinct ``keys`` from one chunk's answers."""
    part = pdf[pdf["kind"] == kind].sort_values("bucket")
    values = [unpack(bytes(d), dtype) for d in part["data"]]
    out = np.concatenate(values) if values else np.zeros(0, dtype)
    assert len(out) == len(keys), "questions and answers of a chunk differ"
    return out
