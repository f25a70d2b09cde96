"""Checks of a corpus, each a frame of violations (check, source_id, detail); no rows, no fault."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.folding import FOLD_VERSION, MATCH_MIN_LENGTH
from quillmark.functions.text import nul_count
from quillmark.operators import batch, merkle, postings

#: Every check by name.
CHECKS = ["id_sets", "nonempty", "row_counts", "integrity", "fold_version", "nul_free", "smoke_length", "source_reachable", "author_reachable", "recall_coverage", "raw_unchanged", "run_status", "manifest_digest", "outputs", "source_credentials"]
#: What a source's credential holds, in its summary and in the index.
CREDENTIAL = "source_id string, status string, attempt_id string, manifest_digest string, outputs_sha256 string"


def _violations(frame: DataFrame, check: str, source: Column, detail: Column) -> DataFrame:
    return frame.select(F.lit(check).alias("check"), source.cast("string").alias("source_id"), detail.cast("string").alias("detail"))


def id_sets(registry: DataFrame, directories: DataFrame, index: DataFrame) -> DataFrame:
    """Sources that the registry, the directories and the index do not all have."""
    ids = lambda df, name: df.select("source_id").distinct().withColumn(name, F.lit(True))
    all_ = ids(registry, "r").join(ids(directories, "d"), "source_id", "full_outer").join(ids(index, "i"), "source_id", "full_outer")
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), n) for c, n in (("r", "registry"), ("d", "directory"), ("i", "index"))])
    return _violations(all_.withColumn("_m", missing).where("_m <> ''"), "id_sets", F.col("source_id"), F.concat(F.lit("missing in "), F.col("_m")))


def integrity(chunks: DataFrame) -> DataFrame:
    """Chunks without a key, and keys used twice."""
    twice = chunks.groupBy("chunk_id").agg(F.count("*").alias("n"), F.min("source_id").alias("source_id")).where("n > 1 or chunk_id is null")
    return _violations(twice, "integrity", F.col("source_id"), F.concat_ws(" x", "chunk_id", "n"))


def fold_version(index: DataFrame) -> DataFrame:
    other = index.where(F.col("fold_version").isNull() | (F.col("fold_version") != FOLD_VERSION)).groupBy("source_id").agg(F.count("*").alias("n"))
    return _violations(other, "fold_version", F.col("source_id"), F.col("n"))


def nul_free(frame: DataFrame, columns: list[str]) -> DataFrame:
    nuls = frame.groupBy("source_id").agg(*[F.sum(nul_count(F.col(c))).alias(c) for c in columns])
    each = nuls.select("source_id", F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in columns])).alias("r")).where("r.n > 0")
    return _violations(each, "nul_free", F.col("source_id"), F.concat_ws("=", "r.c", "r.n"))


def smoke_length(registry: DataFrame) -> DataFrame:
    return _violations(registry.where(F.length("smoke_query") < MATCH_MIN_LENGTH), "smoke_length", F.col("source_id"), F.col("smoke_query"))


def manifest_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """path, state of every file: unchanged, changed, removed or added."""
    both = old.select("path", F.col("sha256").alias("_old")).join(new.select("path", F.col("sha256").alias("_new")), "path", "full_outer")
    state = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.col("_old") == F.col("_new"), "unchanged").otherwise("changed")
    return both.select("path", state.alias("state"))


def raw_unchanged(old: DataFrame, new: DataFrame) -> DataFrame:
    """Files of rows of source_id, path, sha256, size that are not as they were recorded."""
    return _violations(merkle.changes(old, new), "raw_unchanged", F.col("source_id"), F.concat_ws(":", "state", "path"))


def nonempty(sources: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Registered sources without a row in one of the tables."""
    every = reduce(DataFrame.unionByName, [t.select("source_id").distinct().withColumn("name", F.lit(n)) for n, t in tables.items()])
    wanted = sources.select("source_id").distinct().select("source_id", F.explode(F.array(*map(F.lit, tables))).alias("name"))
    return _violations(wanted.join(every, ["source_id", "name"], "left_anti"), "nonempty", F.col("source_id"), F.col("name"))


def row_counts(recorded: dict[str, int], tables: dict[str, DataFrame]) -> DataFrame:
    """Tables that hold another number of rows than the index says."""
    counts = reduce(DataFrame.unionByName, [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n", F.lit(recorded.get(name)).cast("long").alias("said")) for name, t in tables.items()])
    return _violations(counts.where(~F.col("n").eqNullSafe(F.col("said"))), "row_counts", F.lit(None), F.concat_ws(" ", "name", "n", "said"))


def source_reachable(index: postings.Index, smoke: DataFrame) -> DataFrame:
    """Sources (source_id, smoke_query) whose smoke query does not find them; without a query they are not found either."""
    asked = smoke.select("source_id", "smoke_query").collect()  # a row a registered source
    found = postings.hits(index, sorted({r.smoke_query for r in asked if r.smoke_query})).select("source_id", F.col("term").alias("smoke_query")).distinct()
    return _violations(smoke.join(found, ["source_id", "smoke_query"], "left_anti"), "source_reachable", F.col("source_id"), F.coalesce("smoke_query", F.lit("no query")))


def author_reachable(index: postings.Index, chunks: DataFrame, smoke: DataFrame) -> DataFrame:
    """Sources with authors (source_id, author, gram) whose main author is not found there, and sources found for an author who has no chunk in them."""
    terms = sorted({r.gram for r in smoke.select("gram").collect()})  # a row a source with authors
    hits = postings.hits(index, terms).select(F.col("term").alias("gram"), "chunk_id", F.col("source_id").alias("hit_source"))
    by = hits.join(chunks.select("chunk_id", "author"), "chunk_id").select("gram", "author", "hit_source").distinct()
    lost = smoke.join(by.withColumnRenamed("hit_source", "source_id"), ["source_id", "author", "gram"], "left_anti").select("source_id", "author")
    holding = chunks.select("author", F.col("source_id").alias("hit_source")).distinct()
    strange = smoke.select("author", "gram").join(by, ["author", "gram"]).join(holding, ["author", "hit_source"], "left_anti").select(F.col("hit_source").alias("source_id"), "author")
    return _violations(lost.unionByName(strange), "author_reachable", F.col("source_id"), F.col("author"))


def recall_coverage(index: postings.Index, chunks: DataFrame, terms: list[str]) -> DataFrame:
    """Terms and sources of which the index finds another number of chunks than a scan does."""
    parsed, wanted = batch.distinct_terms({t: t for t in terms})
    names = chunks.sparkSession.createDataFrame([(i, t) for t, i in wanted], "number int, name string")
    scan = batch.term_hits(chunks, parsed).groupBy("source_id", F.col("term").alias("number")).agg(F.count("*").alias("scanned")).join(F.broadcast(names), "number").select("source_id", F.col("name").alias("term"), "scanned")
    found = postings.hits(index, terms).groupBy("source_id", "term").agg(F.count("*").alias("found"))
    both = scan.join(found, ["source_id", "term"], "full_outer").where(~F.col("scanned").eqNullSafe(F.col("found")))
    return _violations(both, "recall_coverage", F.col("source_id"), F.concat_ws(" ", "term", F.coalesce("found", F.lit(0)), F.coalesce("scanned", F.lit(0))))


def run_status(summaries: DataFrame) -> DataFrame:
    """Sources whose last run did not end in success."""
    return _violations(summaries.where(~F.col("status").eqNullSafe("success")), "run_status", F.col("source_id"), F.coalesce("status", F.lit("none")))


def _unlike(summaries: DataFrame, now: DataFrame, column: str, check: str) -> DataFrame:
    other = now.select("source_id", F.col(column).alias("_now"))
    return _violations(summaries.join(other, "source_id", "left").where(~F.col(column).eqNullSafe(F.col("_now"))), check, F.col("source_id"), F.coalesce("_now", F.lit("none")))


def manifest_digests(summaries: DataFrame, files: DataFrame) -> DataFrame:
    """Summaries whose recorded digest is not that of the raw files (source_id, path, sha256, size) as they are."""
    return _unlike(summaries, merkle.digests(files), "manifest_digest", "manifest_digest")


def outputs(summaries: DataFrame, now: DataFrame) -> DataFrame:
    """Summaries whose recorded products are not those (source_id, outputs_sha256) that are there."""
    return _unlike(summaries, now, "outputs_sha256", "outputs")


def source_credentials(summaries: DataFrame, indexed: DataFrame) -> DataFrame:
    """Sources whose credential in the index (same columns) differs in any field from their summary, or is missing on one side."""
    fields = [c.split()[0] for c in CREDENTIAL.split(", ")[1:]]
    both = summaries.select("source_id", F.struct(*fields).alias("_said")).join(indexed.select("source_id", F.struct(*fields).alias("_has")), "source_id", "full_outer")
    which = F.concat_ws(",", *[F.when(~F.col(f"_said.{f}").eqNullSafe(F.col(f"_has.{f}")), f) for f in fields])
    return _violations(both.withColumn("_w", which).where("_w <> ''"), "source_credentials", F.col("source_id"), F.col("_w"))


def all_violations(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def report(violations: DataFrame, ran: list[str]) -> DataFrame:
    """check, violations, status of every check: failed or passed for those that ran, and not run (without a number) for the others."""
    unknown = set(ran) - set(CHECKS)
    if unknown:
        raise ValueError(f"no such checks: {sorted(unknown)}")
    counts = violations.groupBy("check").agg(F.count("*").alias("n"))
    every = violations.sparkSession.createDataFrame([(c, c in ran) for c in CHECKS], "check string, ran boolean")
    number = F.when(F.col("ran"), F.coalesce("n", F.lit(0).cast("long")))
    return every.join(counts, "check", "left").select("check", number.alias("violations"), F.when(~F.col("ran"), "not run").when(F.col("n") > 0, "failed").otherwise("passed").alias("status"))
