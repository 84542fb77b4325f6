"""All named queries."""

from __future__ import annotations

from tidings.plans import graph, ingest, io, nlp, profile, quality, search, streams, temporal

AREAS = (ingest, profile, search, nlp, graph, temporal, quality, io, streams)


def queries() -> dict:
    return {n: f for m in AREAS for n, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {n: s for m in AREAS for n, s in m.ORACLES.items()}
