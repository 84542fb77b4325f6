"""Identifier rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings import vocab


def url_md5(url: Column) -> Column:
    return F.md5(url)


def article_id(uri: Column, url: Column) -> Column:
    """Prefix + uri with ``/`` and ``:`` as ``_``; an empty uri falls back to md5(url)."""
    key = F.translate(F.coalesce(uri, F.lit("")), "/:", "__")
    fallback = F.md5(F.coalesce(url, F.lit("")))
    return F.concat(F.lit(vocab.DOC_ID_PREFIX), F.when(key == "", fallback).otherwise(key))


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no fragment, query or trailing slash."""
    bare = F.regexp_replace(url, r"[?#].*$", "")
    head = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1))
    tail = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return F.regexp_replace(F.concat(head, tail), r"/+$", "")


def host(url: Column) -> Column:
    """Host name without a leading ``www.``."""
    return F.regexp_replace(
        F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1)), r"^www\.", "")


def article_global_id(url: Column) -> Column:
    return F.sha2(canonical_url(url), 256)


def entity_global_id(name: Column, kind: Column) -> Column:
    normal = F.lower(F.trim(F.regexp_replace(name, r"[ \t\n\x0B\f\r]+", " ")))
    return F.sha2(F.concat_ws("|", normal, kind), 256)


def edge_global_id(src: Column, dst: Column, predicate: Column) -> Column:
    return F.sha2(F.concat_ws("|", src, dst, predicate), 256)
