"""Vector columns: cosine, mean, hashed text vectors."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIM = 64


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(as_double(v), F.lit(0.0), lambda acc, x: acc + x * x))


def mean_vector(v: Column) -> Column:
    """Aggregate: element-wise mean, combined map-side like any built-in."""
    return vector_to_array(Summarizer.mean(array_to_vector(as_double(v))))


def hash_slot(token: str, dim: int) -> tuple[int, float]:
    """Feature hashing: md5 picks the bucket (first 7 hex digits) and the sign."""
    h = hashlib.md5(token.encode("utf-8")).hexdigest()
    return int(h[:7], 16) % dim, 1.0 if int(h[7], 16) % 2 == 0 else -1.0


class _Slots(dict):
    """Slot of a token, worked out once: its bucket, plus ``dim`` for a negative sign."""

    def __init__(self, dim: int):
        self.dim = dim

    def __missing__(self, token: str) -> int:
        bucket, sign = hash_slot(token, self.dim)
        self[token] = bucket if sign > 0 else bucket + self.dim
        return self[token]


def hash_model(dim: int = HASH_DIM) -> Callable[[pd.Series], list[np.ndarray]]:
    """Default embedding model: unit-norm signed feature hashing of tokens."""
    slots = _Slots(dim)

    def embed(batch):
        sizes = np.fromiter(map(len, batch), np.int64, len(batch))
        part = np.cumsum(sizes) >> 20           # some million tokens at once, however long the texts
        out, whole = [], list(batch)
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(whole)]
        for start, end in itertools.pairwise(cuts):
            if len(slots) > 500_000:
                slots.clear()
            n = sizes[start:end]
            flat = np.fromiter((slots[t] for toks in whole[start:end] for t in toks), np.int64, int(n.sum()))
            hits = np.bincount(np.repeat(np.arange(end - start), n) * (2 * dim) + flat, minlength=(end - start) * 2 * dim).reshape(-1, 2 * dim)
            v = (hits[:, :dim] - hits[:, dim:]).astype(float)   # second half: negative sign
            norms = np.sqrt((v * v).sum(axis=1, keepdims=True))
            out += list(v / np.where(norms > 0, norms, 1.0))
        return out

    return embed


def embed_tokens(tokens: Column, model_factory: Callable = hash_model) -> Column:
    """Embed token lists with a model built once per worker process.

    ``model_factory`` returns a callable from a batch of token lists to
    vectors; swap in any real model here.
    """

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = model_factory()
        for s in batches:
            yield pd.Series(model(s), index=s.index)

    return run(tokens)
