"""Texts cut at the matches of a pattern, in expressions only; and values bound once inside an expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def matches(text: Column, pattern: str) -> Column:
    """All matches in order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def pieces(text: Column, pattern: str) -> Column:
    """The stretches around the matches: one more than there are matches."""
    return F.split(text, pattern, -1)


def joined(pieces: Column, between: Column) -> Column:
    """The text again, with ``between`` in the place of the matches."""
    return F.array_join(F.flatten(F.zip_with(pieces, between, lambda p, b: F.array(p, F.coalesce(b, F.lit(""))))), "")
