"""Counts of hits and their breakdowns, smoke queries, and precision."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmark.functions.folding import fold_ascii
from quillmark.functions.text import grams, nul_count
from quillmark.operators.search import hit, hit_any, recall, search, with_folds
from quillmark.plans.query import parse


def _one(term: str):
    (parsed,) = parse(term)
    return parsed


def recall_counts(chunks: DataFrame, terms: list[str]) -> DataFrame:
    """term, hits: how many chunks hold each term. All terms are counted in one scan."""
    parsed = {t: _one(t) for t in terms}
    flags = with_folds(chunks, tuple(parsed.values())).select(*[F.count_if(hit_any(p)).alias(f"_{i}") for i, p in enumerate(parsed.values())])
    return flags.select(F.explode(F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"_{i}").alias("hits")) for i, t in enumerate(parsed)])).alias("r")).select("r.*")


def hits_by_source(chunks: DataFrame, terms: list[str]) -> DataFrame:
    """term, source_id, hits of the sources that hold hits."""
    parsed = {t: _one(t) for t in terms}
    per = with_folds(chunks, tuple(parsed.values())).groupBy("source_id").agg(*[F.count_if(hit_any(p)).alias(f"_{i}") for i, p in enumerate(parsed.values())])
    return per.select("source_id", F.explode(F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"_{i}").alias("hits")) for i, t in enumerate(parsed)])).alias("r")).select("r.term", "source_id", "r.hits").where("hits > 0")


def field_decomposition(chunks: DataFrame, terms: list[str]) -> DataFrame:
    """Of each term: hits in the text, in title or author alone, in either, in topics alone, and in all four."""
    parsed = {t: _one(t) for t in terms}
    df = with_folds(chunks, tuple(parsed.values()))
    made = []
    for i, p in enumerate(parsed.values()):
        prose, union = hit("text", p), hit_any(p)
        topics = F.contains(F.coalesce(F.col("topics_text"), F.lit("")), F.lit(p.folded))
        made += [F.count_if(c).alias(f"_{i}_{n}") for n, c in (("prose", prose), ("other", union & ~prose), ("union_hits", union), ("topics_only", topics & ~union), ("all_fields", union | topics))]
    counts = df.agg(*made)
    names = {"prose": "prose", "other": "title_author_only", "union_hits": "union_hits", "topics_only": "topics_only", "all_fields": "all_fields"}
    return counts.select(F.explode(F.array(*[F.struct(F.lit(t).alias("term"), *[F.col(f"_{i}_{n}").alias(a) for n, a in names.items()]) for i, t in enumerate(parsed)])).alias("r")).select("r.*")


def noise_ratio(chunks: DataFrame, terms: list[str]) -> DataFrame:
    """term, noise: the share of four-field hits that the text does not hold."""
    return field_decomposition(chunks, terms).select("term", F.when(F.col("all_fields") > 0, 1 - F.col("prose") / F.col("all_fields")).alias("noise"))


def smoke_terms(chunks: DataFrame, longest: int = 40, n: int = 3, least: int = 3) -> DataFrame:
    """Of each source, the gram of most of its ``longest`` longest chunks (by text order among equals)."""
    by_length = Window.partitionBy("source_id").orderBy(F.desc(F.length("text")), F.asc("chunk_id"))
    top = chunks.withColumn("_r", F.row_number().over(by_length)).where(F.col("_r") <= longest)
    counts = top.select("source_id", F.explode(grams(F.col("text"), n)).alias("gram")).where(~F.col("gram").rlike(r"\s")).groupBy("source_id", "gram").agg(F.count("*").alias("n_chunks"))
    best = Window.partitionBy("source_id").orderBy(F.desc("n_chunks"), F.asc("gram"))
    return counts.where(F.col("n_chunks") >= least).withColumn("_r", F.row_number().over(best)).where("_r = 1").select("source_id", "gram", "n_chunks")


def smoke_queries(chunks: DataFrame, sources: DataFrame) -> DataFrame:
    """source_id, smoke_query: the registered one, else the derived one."""
    return sources.join(smoke_terms(chunks), "source_id", "left").select("source_id", F.coalesce("smoke_query", "gram").alias("smoke_query"))


def dominant_author(chunks: DataFrame) -> DataFrame:
    """source_id, author, n_chunks of the author with most chunks."""
    counts = chunks.where(F.col("author").isNotNull()).groupBy("source_id", "author").agg(F.count("*").alias("n_chunks"))
    best = Window.partitionBy("source_id").orderBy(F.desc("n_chunks"), F.asc("author"))
    return counts.withColumn("_r", F.row_number().over(best)).where("_r = 1").select("source_id", "author", "n_chunks")


def dominant_author_smoke(chunks: DataFrame, longest: int = 40) -> DataFrame:
    """source_id, author, gram: a smoke query from the dominant author's own text."""
    own = chunks.join(dominant_author(chunks).select("source_id", "author"), ["source_id", "author"], "left_semi")
    return dominant_author(chunks).select("source_id", "author").join(smoke_terms(own, longest), "source_id")


def chunk_counts(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("source_id").agg(F.count("*").alias("n_chunks"))


def source_nonempty(sources: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Every registered source with its rows in each table, and whether none is empty."""
    df = sources.select("source_id")
    for name, t in tables.items():
        df = df.join(t.groupBy("source_id").agg(F.count("*").alias(f"_{name}")), "source_id", "left").withColumn(name, F.coalesce(f"_{name}", F.lit(0).cast("long"))).drop(f"_{name}")
    return df.withColumn("nonempty", F.least(*[F.col(n) for n in tables], F.lit(1).cast("long")) > 0)


def distinct_counts(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.countDistinct("source_id").alias("n_sources"), F.countDistinct("author").alias("n_authors"))


def nul_audit(frame: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, nuls, rows_with_nul of each column."""
    counts = frame.agg(*[F.coalesce(F.sum(nul_count(F.col(c))), F.lit(0)).alias(f"n_{c}") for c in columns], *[F.count_if(nul_count(F.col(c)) > 0).alias(f"r_{c}") for c in columns])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("nuls"), F.col(f"r_{c}").alias("rows_with_nul")) for c in columns])).alias("r")).select("r.*")


def precision_at_k(chunks: DataFrame, query: str, k: int = 8, kinds: DataFrame | None = None) -> DataFrame:
    """query, k, precision: the share of the first k results whose text holds a term."""
    return search(chunks, query, k, kinds=kinds).agg(F.avg("prose_hit").alias("precision")).select(F.lit(query).alias("query"), F.lit(k).alias("k"), "precision")


def substring_union(chunks: DataFrame, term: str) -> DataFrame:
    """The oracle of recall: chunks where instr finds the folded term in a folded field."""
    p = _one(term)
    df = with_folds(chunks, (p,))
    fields = [F.col(f"_{f}_{p.kind}") if p.cased else F.coalesce(F.col(f), F.lit("")) for f in ("text", "title", "author")]
    return df.where(reduce(or_, [F.instr(f, F.lit(p.folded)) > 0 for f in fields])).select("chunk_id")


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Members of one side alone, with the side; empty where two sets are equal."""
    a, b = left.exceptAll(right), right.exceptAll(left)
    return a.withColumn("side", F.lit("left")).unionByName(b.withColumn("side", F.lit("right")))


def prefix_places(chunks: DataFrame, query: str, k: int, more: int, kinds: DataFrame | None = None) -> DataFrame:
    """place, chunk_id, same: the first k results, and whether a longer result has the same chunk at the place."""
    order = Window.orderBy(F.desc("prose_hit"), F.desc("term_count"), F.desc("score"), F.asc("chunk_id"))
    place = lambda n, name: search(chunks, query, n, kinds=kinds).withColumn("place", F.row_number().over(order)).select("place", F.col("chunk_id").alias(name))
    both = place(k, "chunk_id").join(place(more, "_other"), "place", "left")
    return both.select("place", "chunk_id", F.col("chunk_id").eqNullSafe(F.col("_other")).alias("same"))


def _sides(left: DataFrame, right: DataFrame, term: str, names: tuple[str, str]) -> DataFrame:
    """term, how many members each side has, and on_one_side: how many only one of them has."""
    both = left.select("chunk_id").withColumn("_l", F.lit(1)).join(right.select("chunk_id").withColumn("_r", F.lit(1)), "chunk_id", "full_outer")
    return both.agg(F.count("_l").alias(names[0]), F.count("_r").alias(names[1]), F.count_if(F.col("_l").isNull() | F.col("_r").isNull()).alias("on_one_side")).select(F.lit(term).alias("term"), *names, "on_one_side")


def recall_against_instr(chunks: DataFrame, terms: list[str]) -> DataFrame:
    """Recall beside the substring union of each term."""
    return reduce(DataFrame.unionByName, [_sides(recall(chunks, t), substring_union(chunks, t), t, ("recalled", "by_instr")) for t in terms])


def like_against_instr(chunks: DataFrame, terms: list[str]) -> DataFrame:
    """Case-insensitive LIKE with escaped wildcards beside instr over ASCII-folded text, for each term."""
    low = fold_ascii(F.coalesce("text", F.lit("")))
    rows = []
    for t in terms:
        escaped = re.sub(r"([\\%_])", r"\\\1", t)
        rows.append(_sides(chunks.where(F.coalesce("text", F.lit("")).ilike(f"%{escaped}%")), chunks.where(F.instr(low, F.lit(t.lower())) > 0), t, ("by_like", "by_instr")))
    return reduce(DataFrame.unionByName, rows)


def literal_union(chunks: DataFrame, terms: list[str]) -> DataFrame:
    """term, literal and in_text, in_title, in_author: chunks that hold the term as it is written, in one pass for all terms."""
    fields = {c: F.coalesce(c, F.lit("")) for c in ("text", "title", "author")}
    made = []
    for i, t in enumerate(terms):
        held = {c: F.instr(f, F.lit(t)) > 0 for c, f in fields.items()}
        made += [F.count_if(reduce(or_, held.values())).alias(f"literal{i}"), *[F.count_if(h).alias(f"{c}{i}") for c, h in held.items()]]
    rows = [F.struct(F.lit(t).alias("term"), F.col(f"literal{i}").alias("literal"), *[F.col(f"{c}{i}").alias(f"in_{c}") for c in fields]) for i, t in enumerate(terms)]
    return chunks.agg(*made).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def author_sources(chunks: DataFrame, query: str, author: str) -> DataFrame:
    """source_id, has_results of every source that the author has, or that a search of the author gives."""
    own = chunks.where(F.col("author") == author).select("source_id").distinct()
    found = recall(chunks, query, author=author).select("source_id").distinct().withColumn("_found", F.lit(True))
    return own.join(found, "source_id", "full_outer").select("source_id", F.coalesce("_found", F.lit(False)).alias("has_results"))
