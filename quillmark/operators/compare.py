"""Comparison across sources: each is searched alone, and what is not found says so."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.operators.batch import batch_search

#: Words that stand for one another in the registered queries.
SYNONYMS = {"the": ["the", "les", "die"], "and": ["and", "und", "et"]}


def compare_sources(chunks: DataFrame, query: str, per_source: int = 3, kinds: DataFrame | None = None) -> DataFrame:
    """The first results of each source side by side; sources are never merged or ranked against each other."""
    return batch_search(chunks, {"q": query}, per_source, by_source=True, kinds=kinds).drop("qid")


def expand(query: str, synonyms: dict[str, list[str]] = SYNONYMS) -> str:
    """The query with each term's synonyms as further terms, each counting for itself."""
    return " ".join(dict.fromkeys(s for t in query.split() for s in synonyms.get(t, [t])))


def evidence(chunks: DataFrame, sources: DataFrame, query: str, per_source: int = 3, kinds: DataFrame | None = None) -> DataFrame:
    """A row per registered source: its hits, or found = false; the judgement columns are for people."""
    hits = compare_sources(chunks, query, per_source, kinds).groupBy("source_id").agg(F.count("*").alias("n_hits"), F.min_by("chunk_id", "position").alias("best_chunk"))
    return sources.select("source_id").join(hits, "source_id", "left").select(
        "source_id", F.lit(query).alias("query"), F.coalesce("n_hits", F.lit(0).cast("long")).alias("n_hits"), "best_chunk",
        F.col("n_hits").isNotNull().alias("found"), F.lit(None).cast("string").alias("answers"), F.lit(None).cast("string").alias("missing"),
    )


def with_level(results: DataFrame) -> DataFrame:
    """Where an answer comes from: a method card, a chunk, a whole parent (no chunk named), or the model alone (neither named)."""
    has = lambda c: F.col(c).isNotNull() if c in results.columns else F.lit(False)
    level = F.when(has("chunk_id") & (F.col("chunk_type") == "curated_method"), "method card").when(has("chunk_id"), "chunk").when(has("parent_id"), "parent").otherwise("model")
    return results.withColumn("level", level)


def levels_by_source(chunks: DataFrame, sources: DataFrame, query: str, kinds: DataFrame | None = None) -> DataFrame:
    """source_id, chunk_id, level of each source's best result; where nothing is found only the model could answer."""
    of = kinds if kinds is not None else chunks.select("chunk_id", "chunk_type")
    best = compare_sources(chunks, query, 1, kinds).join(of, "chunk_id", "left").select("source_id", "chunk_id", "chunk_type")
    return with_level(sources.select("source_id").join(best, "source_id", "left")).select("source_id", "chunk_id", "level")
