"""Expressions over text that several operators use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def occurrences(field: Column, term: str) -> Column:
    """How often a term occurs in a field, without overlaps."""
    return ((F.length(field) - F.length(F.replace(field, F.lit(term), F.lit("")))) / F.lit(len(term))).cast("long")


def clean_text(c: Column) -> Column:
    """The text without NUL characters."""
    return F.translate(c, "\0", "")


def nul_count(c: Column) -> Column:
    return F.coalesce(F.length(c) - F.length(clean_text(c)), F.lit(0)).cast("long")


def grams(c: Column, n: int) -> Column:
    """The distinct runs of n characters of a text, made from its characters and their successors."""
    chars = F.split(c, "")
    runs = chars
    for j in range(1, n):
        runs = F.zip_with(runs, F.slice(chars, j + 1, F.size(chars)), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.array_distinct(F.slice(runs, 1, F.greatest(F.length(c) - (n - 1), F.lit(0))))
