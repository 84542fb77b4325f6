"""Text columns: tokens, previews, slugs, clean-up, defaults."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidings import vocab

TOKEN_PATTERN = r"[\p{L}\p{N}]+"
WHITESPACE = r"[ \t\n\x0B\f\r]+"


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def explode_tokens(toks: Column) -> Column:
    """One row per token.

    The outer form, because a plain ``explode`` makes the optimizer test the
    array for emptiness first, which would tokenise every text again.  A text
    without tokens gives one null row; joins and ``is not null`` drop it.
    """
    return F.explode_outer(toks)


def collapse(text: Column) -> Column:
    """Whitespace runs to one space, trimmed; null stays null."""
    return F.trim(F.regexp_replace(text, WHITESPACE, " "))


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def description(body: Column) -> Column:
    return F.substring(F.coalesce(body, F.lit("")), 1, vocab.DESCRIPTION_CHARS)


def preview(text: Column, chars: int = 200) -> Column:
    return F.when(F.length(text) > chars, F.concat(F.substring(text, 1, chars), F.lit("..."))).otherwise(text)


def one_line(text: Column, chars: int = 150) -> Column:
    return F.replace(F.substring(text, 1, chars), F.lit("\n"), F.lit(" "))


def slug(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("_"))


def day_key(ts: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.date_format(ts, pattern)


def parse_iso(value: Column) -> Column:
    """ISO-8601 text (``Z`` or offset allowed) to timestamp; invalid gives null."""
    return F.try_to_timestamp(value)


def category_labels(categories: Column, first: int = 3) -> Column:
    """Non-empty labels, at most ``first`` of them, joined by ', '."""
    labels = F.filter(F.transform(categories, lambda c: c["label"]),
                      lambda x: x.isNotNull() & (x != ""))
    return F.array_join(F.slice(labels, 1, first), ", ")


def embedding_text(title: Column, content: Column, desc: Column) -> Column:
    """Title, blank line, then content (description where content is absent)."""
    body = F.coalesce(content, desc, F.lit(""))
    return F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), body)


def nlp_text(desc: Column, content: Column) -> Column:
    return F.concat(F.coalesce(desc, F.lit("")), F.lit(" "), F.coalesce(content, F.lit("")))


def standard_source(name: Column) -> Column:
    """First matching rung of the source ladder, else title case."""
    out = F.initcap(name)
    for pattern, label in reversed(vocab.SOURCE_LADDER):
        out = F.when(F.lower(name).like(pattern), F.lit(label)).otherwise(out)
    return out


def any_of(terms) -> str:
    """Case-insensitive alternation for ``rlike``: any term, anywhere in the text."""
    return "(?i)(" + "|".join(re.sub(r"([\\.^$*+?()\[\]{}|])", r"\\\1", t) for t in terms) + ")"


def joined(values: Column) -> Column:
    """Sorted, comma-joined array: a stable text form of a set."""
    return F.array_join(F.array_sort(values), ",")
