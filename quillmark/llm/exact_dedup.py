"""Exact deduplication: groups of one 128-bit content hash, compared byte by byte.

A first pass over the texts leaves a row of doc_id, row number, hash and digest of each document, written once
to the shared folder; counts and kept rows of the groups come from it, summed before they are shuffled. A
second pass reads the texts again, keeps those whose hash occurs twice or more, and compares the bytes of
each group by the least and the greatest of its texts: equal ones mean that all are equal. Both are
summed on each task first, then on groups salted by task, so a group of any size sends a row for each task and
no text that stands alone is shuffled for a comparison. Where a hash's texts differ, its rows are grouped by
the texts themselves.

Groups of up to ``most_broadcast`` rows (one a hash that occurs twice or more) are broadcast to the rows, beyond
that the two are shuffled. There a group of more than 1/``SHARES`` of all rows is cut into as many salts as it has such
shares: fewer than ``SHARES`` groups are that large, which bounds the broadcast that says how many. Every step writes
what it must reread to the shared folder, so a lost executor costs its own tasks alone.

Defined cases: a null text counts as empty, and all empty texts are one group. A null doc_id is less than any other; it
stays only if all of its group are null. Of repeated rows with the kept doc_id exactly one stays (the first of
the written table; they differ in nothing that is read). Texts are read whole. An empty table gives an empty result.
Other columns are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import lower_ascii, materialize


def content_hash(digest: Column) -> Column:
    """The first 128 bits of a text's SHA-256."""
    return F.substring(digest, 1, 16)


SHARES = 1000


def fold(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is; a text of ASCII alone by the faster function."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(lower_ascii(c))


def _meet(rows: DataFrame, groups: DataFrame, total: int, how: str, most_broadcast: int) -> DataFrame:
    """Rows (with a number each, ``row``) joined with the groups of their hash (one row each, ``size`` says of how many)."""
    if groups.count() <= most_broadcast:
        return rows.join(F.broadcast(groups), "hash", how)
    salts = F.ceil(F.col("size") * SHARES / F.lit(max(total, 1))).cast("int")
    hot = groups.where(salts > 1).select("hash", salts.alias("_salts"))
    salted = rows.join(F.broadcast(hot), "hash", "left").withColumn("_salt", F.pmod("row", F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")
    every = groups.select("*", F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt"))
    return salted.join(every, ["hash", "_salt"], how).drop("_salt")


def differing(texts: DataFrame, salts: int = 64) -> DataFrame:
    """The hashes, of rows of hash and text, whose texts are not all the same bytes."""
    ends = texts.groupBy("hash", (F.spark_partition_id() % salts).alias("salt")).agg(F.min("text").alias("least"), F.max("text").alias("greatest"))
    whole = ends.groupBy("hash").agg(F.min("least").alias("least"), F.max("greatest").alias("greatest"))
    return whole.where("least <> greatest").select("hash")


def _groups(rows: DataFrame, keep: str) -> DataFrame:
    """hash, size and first (the row that stays) of each hash of two rows or more."""
    by = F.col("doc_id") if keep == "smallest" else F.bitwise_not("doc_id")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), by.alias("by"), F.col("row"), F.col("doc_id").alias("doc_id"))
    return materialize(rows.groupBy("hash").agg(F.count("*").alias("size"), F.min(rank).alias("first")).where("size > 1"))


def judge(documents: DataFrame, keep: str = "smallest", normalise: Callable[[Column], Column] = fold, hash_of: Callable[[Column], Column] = content_hash, most_broadcast: int = 1_000_000) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document; of equal texts the smallest or largest doc_id stays.

    ``normalise`` says which texts are equal, ``hash_of`` makes the content hash of a text's SHA-256.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    text = normalise(F.coalesce(F.col("text"), F.lit("")))
    texts = documents.select("doc_id", F.monotonically_increasing_id().alias("row"), text.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256))).withColumn("hash", hash_of(F.col("digest")))
    rows = materialize(texts.drop("text"))
    total = rows.count()
    groups = _groups(rows, keep)
    mixed = materialize(differing(_meet(texts.select("row", "hash", "text"), groups.select("hash", "size"), total, "left_semi", most_broadcast)))
    if mixed.isEmpty():
        return _result(_meet(rows, groups, total, "left", most_broadcast))
    # Rows of a hash with several texts take the text as their key; the rest of the table never does.
    apart = materialize(_meet(texts, groups.join(mixed, "hash", "left_semi").select("hash", "size"), total, "left_semi", most_broadcast).withColumn("hash", F.col("text").cast("binary")).drop("text"))
    rest = rows.join(mixed, "hash", "left_anti")
    whole = _result(_meet(rest, groups.join(mixed, "hash", "left_anti"), total, "left", most_broadcast))
    return whole.unionByName(_result(_meet(apart, _groups(apart, keep), total, "left", most_broadcast)))


def _result(met: DataFrame) -> DataFrame:
    """Rows without a group stand alone."""
    alone = F.col("size").isNull()
    return met.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"), F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("first.row") == F.col("row"))).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )
