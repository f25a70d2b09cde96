"""Case folding of search terms and fields.

Terms shorter than three characters fold A-Z only. Longer ones fold by a fixed table, one character
to one character, that differs from every library's lower(): it is made here from a rule.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

MATCH_MIN_LENGTH = 3
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The ranges of code points that the table covers.
RANGES = "0041-005A 00B5-024E 0345-0556 10A0-10CD 1E00-1FFC 2126-2183 24B6-24CF 2C00-2CF2 A640-A696 A722-A7AA FF21-FF3A FFFE-FFFF 10400-10427"
#: Letters whose case the table does not know, and code points that it replaces.
UNKNOWN = "037F 0528 052A 052C 052E 2C2F A796 A798 A79A A79C A79E"
REPLACED = {0xFFFE: 0xFFFD, 0xFFFF: 0xFFFD}
FOLD_VERSION = "fold-1057"


@cache
def fold_table() -> dict[str, str]:
    """Each character that folds, and what it folds to."""
    unknown = {int(x, 16) for x in UNKNOWN.split()}
    table = {}
    for bounds in RANGES.split():
        first, last = (int(x, 16) for x in bounds.split("-"))
        for point in range(first, last + 1):
            char = chr(point)
            to = char.casefold() if len(char.casefold()) == 1 else char.lower()
            to = chr(REPLACED.get(point, ord(to) if len(to) == 1 else point))
            if to != char and point not in unknown:
                table[char] = to
    return table


@cache
def fold_pairs() -> tuple[str, str]:
    table = fold_table()
    return "".join(table), "".join(table.values())


def fold_ascii(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def fold_unicode(c: Column) -> Column:
    return F.translate(c, *fold_pairs())


def fold_text(text: str, kind: str) -> str:
    """A term folded on the driver, as the column functions fold fields."""
    if kind == "ascii":
        return text.translate(str.maketrans(ASCII_UPPER, ASCII_LOWER))
    return text.translate(str.maketrans(*fold_pairs()))


def fold_kind(term: str) -> str:
    return "ascii" if len(term) < MATCH_MIN_LENGTH else "unicode"


@cache
def images(kind: str) -> frozenset[str]:
    return frozenset(ASCII_LOWER) if kind == "ascii" else frozenset(fold_table().values())


def needs_fold(folded: str, kind: str) -> bool:
    """Can a field's folding change whether it holds the folded term?"""
    return not images(kind).isdisjoint(folded)
