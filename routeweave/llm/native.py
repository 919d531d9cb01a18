"""Small helpers for expressions on arrays inside a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row: bound to the
    variable of a transform over a one-element array."""
    return F.transform(F.array(value), body)[0]


def split_words(text: Column, separators: str) -> Column:
    """The non-empty strings between runs of a character class."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{separators}]+", -1), "")
