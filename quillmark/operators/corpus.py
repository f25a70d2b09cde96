"""Building documents, parents and chunks from raw texts, and tracing chunks back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.folding import FOLD_VERSION, fold_ascii, fold_unicode
from quillmark.functions.text import clean_text, occurrences

CHUNK_CHARS = 800
NO_AUTHOR = "not identified"
#: The words that label a topic in the registered queries.
TOPICS = {"articles": ["the ", "la ", "die "], "links": ["and ", "et ", "und "], "endings": ["tion", "ment", "ung"], "places": [" in ", " en ", " im "]}


def documents_of(raw: DataFrame, prefix: str = "doc") -> DataFrame:
    """doc_id, source_id, title, author, path, sha256 from rows of source_id, path, text and an optional author."""
    sha = F.sha2(clean_text(F.coalesce("text", F.lit(""))), 256)
    author = F.coalesce(F.nullif(F.trim("author"), F.lit("")), F.lit(NO_AUTHOR)) if "author" in raw.columns else F.lit(NO_AUTHOR)
    body = clean_text(F.coalesce("text", F.lit("")))
    return raw.select(F.format_string("%s-%s", F.lit(prefix), F.substring(F.sha2("path", 256), 1, 12)).alias("doc_id"), "source_id", F.substring_index(body, "\n", 1).alias("title"), author.alias("author"), "path", sha.alias("sha256"), body.alias("text"))


def parents_of(documents: DataFrame) -> DataFrame:
    """A parent per line with a character: parent_id, doc_id, source_id, ord, text."""
    lines = documents.select("doc_id", "source_id", F.posexplode(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")).alias("ord", "text"))
    return lines.select(F.format_string("%s-p%03d", "doc_id", "ord").alias("parent_id"), "doc_id", "source_id", "ord", "text")


def chunks_of(parents: DataFrame, documents: DataFrame, size: int = CHUNK_CHARS) -> DataFrame:
    """Windows of ``size`` code points of each parent, with the document's title and author."""
    starts = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / size).cast("int"))
    cut = parents.select("parent_id", "doc_id", "source_id", F.posexplode(F.transform(starts, lambda i: F.substring(F.col("text"), i * size + 1, F.lit(size)))).alias("ord", "text"))
    cut = cut.join(documents.select("doc_id", "title", "author").dropDuplicates(["doc_id"]), "doc_id")
    return cut.select(
        F.format_string("%s-c%02d", "parent_id", "ord").alias("chunk_id"), "parent_id", "doc_id", "source_id", "ord", "text", "title", "author",
        infer_topics(F.col("text")).alias("topics"), F.lit("text").alias("chunk_type"), F.lit("statement").alias("claim_type"),
    )


def kinds(methods: DataFrame, conflicts: DataFrame) -> DataFrame:
    """chunk_id, chunk_type of the chunks that a method (curated_method) or else a conflict names."""
    named = methods.select("chunk_id", F.lit(1).alias("_m")).unionByName(conflicts.select("chunk_id", F.lit(0).alias("_m")))
    return named.groupBy("chunk_id").agg(F.when(F.max("_m") == 1, "curated_method").otherwise("conflict").alias("chunk_type"))


def typed(chunks: DataFrame, methods: DataFrame, conflicts: DataFrame) -> DataFrame:
    """Chunks with chunk_type: curated_method where a method names the chunk, conflict where a conflict does, else as it was or text."""
    old = F.coalesce(F.col("chunk_type"), F.lit("text")) if "chunk_type" in chunks.columns else F.lit("text")
    made = chunks.join(kinds(methods, conflicts).withColumnRenamed("chunk_type", "_kind"), "chunk_id", "left")
    return made.withColumn("chunk_type", F.coalesce("_kind", old)).drop("_kind")


def infer_topics(text: Column, topics: dict[str, list[str]] = TOPICS, least: int = 1) -> Column:
    """Topics with at least ``least`` of their words' occurrences, most first, then by name."""
    low = fold_ascii(F.coalesce(text, F.lit("")))
    counted = F.array(*[F.struct((-sum((occurrences(low, w) for w in words), F.lit(0))).alias("n"), F.lit(t).alias("topic")) for t, words in topics.items()])
    return F.transform(F.array_sort(F.filter(counted, lambda x: x["n"] <= -least)), lambda x: x["topic"])


def index_of(chunks: DataFrame) -> DataFrame:
    """Chunks with their folded fields stored, so that no query folds again."""
    folded = {f"_{c}_{k}": f(F.coalesce(c, F.lit(""))) for c in ("text", "title", "author") for k, f in (("ascii", fold_ascii), ("unicode", fold_unicode))}
    return chunks.withColumns(folded).withColumn("fold_version", F.lit(FOLD_VERSION))


def trace(results: DataFrame, parents: DataFrame, documents: DataFrame) -> DataFrame:
    """Results with parent and document: chunk to parent to raw path."""
    return results.join(parents.select("parent_id", F.col("ord").alias("parent_ord")), "parent_id", "left").join(documents.select("doc_id", "path", "sha256").dropDuplicates(["doc_id"]), "doc_id", "left")
