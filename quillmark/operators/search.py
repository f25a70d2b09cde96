"""Recall, ranking and limits.

Every chunk whose text, title or author holds a term is a candidate, however many there are. The
order is by layers: a hit in the text, the number of terms hit, the score, then chunk_id. A limit
over it is a top-k on every partition and a merge, without a shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.folding import fold_ascii, fold_unicode
from quillmark.functions.text import occurrences
from quillmark.plans.query import Term, parse

#: Weight and most counted hits of each field.
FIELDS = {"text": (3.0, 8), "title": (2.0, 3), "author": (2.0, 2)}
#: What kinds of chunks add to the score.
BONUS = {"curated_method": 5.0, "conflict": 2.0}
FOLDS = {"ascii": fold_ascii, "unicode": fold_unicode}
RANKING = [F.desc, F.desc, F.desc, F.asc]
DEFAULT_LIMIT = 8


def folded_name(field: str, kind: str) -> str:
    return f"_{field}_{kind}"


def with_folds(chunks: DataFrame, terms: tuple[Term, ...]) -> DataFrame:
    """Adds the folded fields that the terms need and the index has not stored.

    They are generated, not projected: the optimizer would write a projection out anew for every
    term and field of a filter above it, and fold each text as often.
    """
    wanted = [(field, kind) for kind in sorted({t.kind for t in terms if t.cased}) for field in FIELDS if folded_name(field, kind) not in chunks.columns]
    if not wanted:
        return chunks
    folds = [FOLDS[kind](F.coalesce(field, F.lit(""))).alias(folded_name(field, kind)) for field, kind in wanted]
    return chunks.select("*", F.inline(F.array(F.struct(*folds))))


def field_of(field: str, term: Term) -> Column:
    return F.col(folded_name(field, term.kind)) if term.cased else F.coalesce(F.col(field), F.lit(""))


def hit(field: str, term: Term) -> Column:
    return F.contains(field_of(field, term), F.lit(term.folded))


def hit_any(term: Term, fields: tuple[str, ...] = tuple(FIELDS)) -> Column:
    return reduce(or_, [hit(f, term) for f in fields])


def recall(chunks: DataFrame, query: str | tuple[Term, ...], source: str | None = None, author: str | None = None) -> DataFrame:
    """All chunks that hold any term of the query, once each; none for a query without terms."""
    terms = parse(query) if isinstance(query, str) else query
    if not terms:
        return with_folds(chunks, terms).limit(0)
    if source is not None:
        chunks = chunks.where(F.col("source_id") == source)
    if author is not None:
        chunks = chunks.where(F.col("author") == author)
    return with_folds(chunks, terms).where(reduce(or_, [hit_any(t) for t in terms]))


def with_kinds(candidates: DataFrame, kinds: DataFrame | None) -> DataFrame:
    """Candidates with chunk_type from ``kinds`` (chunk_id, chunk_type); else their own, or text."""
    if kinds is not None:
        return candidates.drop("chunk_type").join(kinds.select("chunk_id", "chunk_type"), "chunk_id", "left").withColumn("chunk_type", F.coalesce("chunk_type", F.lit("text")))
    return candidates if "chunk_type" in candidates.columns else candidates.withColumn("chunk_type", F.lit("text"))


def bonus_of(kind: Column) -> Column:
    """What a chunk's kind adds to its score."""
    return reduce(lambda otherwise, k: F.when(kind == k, F.lit(BONUS[k])).otherwise(otherwise), BONUS, F.lit(0.0))


def layered(candidates: DataFrame, terms: tuple[Term, ...]) -> DataFrame:
    """Adds prose_hit, term_count and _points: the score without what the kind of a chunk adds."""
    candidates = with_folds(candidates, terms)
    if not terms:
        return candidates.select("*", F.lit(0).alias("prose_hit"), F.lit(0).alias("term_count"), F.lit(0.0).alias("_points"))
    prose = reduce(or_, [hit("text", t) for t in terms]).cast("int")
    count = reduce(add, [hit_any(t).cast("int") for t in terms])
    points = [F.least(occurrences(field_of(f, t), t.folded), F.lit(cap)).cast("double") * weight for f, (weight, cap) in FIELDS.items() for t in terms]
    return candidates.select("*", prose.alias("prose_hit"), count.alias("term_count"), reduce(add, points).alias("_points"))


def scored(candidates: DataFrame, terms: tuple[Term, ...]) -> DataFrame:
    """Adds prose_hit, term_count and score."""
    made = layered(with_kinds(candidates, None), terms)
    return made.withColumn("score", F.col("_points") + bonus_of(F.col("chunk_type"))).drop("_points")


def ordered(ranked: DataFrame) -> DataFrame:
    return ranked.orderBy(F.desc("prose_hit"), F.desc("term_count"), F.desc("score"), F.asc("chunk_id"))


RESULT = ["chunk_id", "source_id", "title", "author", "chunk_type", "prose_hit", "term_count", "score"]


def search(chunks: DataFrame, query: str, limit: int = DEFAULT_LIMIT, source: str | None = None, author: str | None = None, kinds: DataFrame | None = None) -> DataFrame:
    """The first ``limit`` chunks of the order, with their place in each layer.

    ``kinds`` (chunk_id, chunk_type) are joined to the candidates when their texts are scored and dropped, so no text is shuffled.
    """
    terms = parse(query)
    found = layered(recall(chunks, terms, source, author), terms)
    lean = found.select(*[c for c in RESULT if c in found.columns], "_points")
    return ordered(with_kinds(lean, kinds).withColumn("score", F.col("_points") + bonus_of(F.col("chunk_type"))).select(*RESULT)).limit(limit)


def with_rank(results: DataFrame) -> DataFrame:
    """Results with the constant rank that callers of an index's own ranking expect; nothing is ordered by it."""
    return results.withColumn("rank", F.lit(0.0))
