"""Parsed queries."""

from __future__ import annotations

from dataclasses import dataclass

from quillmark.functions.folding import fold_kind, fold_text, needs_fold


@dataclass(frozen=True)
class Term:
    raw: str
    folded: str
    kind: str
    cased: bool


def parse(query: str) -> tuple[Term, ...]:
    """The query's terms between white space, once each under their own folding, in order."""
    found: dict[tuple[str, str], Term] = {}
    for raw in query.split():
        kind = fold_kind(raw)
        folded = fold_text(raw, kind)
        found.setdefault((kind, folded), Term(raw, folded, kind, needs_fold(folded, kind)))
    return tuple(found.values())
