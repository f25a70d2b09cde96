"""Manifests as hash trees: one digest a source, and differences found by descending.

A file's place is the hash of its path. Files whose first six hex digits agree share a leaf, whose digest is that of their sorted
lines (path, hash, size); a node of four, two and no digits digests its children's prefixes and digests in order. The
formula is one for every size: a node has at most 256 children, and a leaf the files of one in 16.7 million places, so no task
gathers more than that, whatever a source holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = (6, 4, 2, 0)


def _digest(children: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(F.collect_list(children)), "\n"), 256)


def tree(files: DataFrame) -> DataFrame:
    """source_id, level (hex digits), prefix, digest and file_count of every node, of rows of source_id, path, sha256, size."""
    line = F.concat_ws("\t", "path", F.coalesce("sha256", F.lit("")), F.coalesce(F.col("size").cast("string"), F.lit("")))
    leaf = F.substring(F.sha2("path", 256), 1, LEVELS[0])
    level = files.groupBy("source_id", leaf.alias("prefix")).agg(_digest(line).alias("digest"), F.count("*").alias("file_count"))
    made = [level.withColumn("level", F.lit(LEVELS[0]))]
    for n in LEVELS[1:]:
        level = level.groupBy("source_id", F.substring("prefix", 1, n).alias("prefix")).agg(_digest(F.concat_ws(":", "prefix", "digest")).alias("digest"), F.sum("file_count").alias("file_count"))
        made.append(level.withColumn("level", F.lit(n)))
    return reduce(DataFrame.unionByName, made).select("source_id", "level", "prefix", "digest", "file_count")


def digests(files: DataFrame) -> DataFrame:
    """source_id, manifest_digest and file_count of each source."""
    return tree(files).where("level = 0").select("source_id", F.col("digest").alias("manifest_digest"), "file_count")


def differing(old: DataFrame, new: DataFrame) -> DataFrame:
    """source_id, level, prefix of the nodes of two stored trees that differ; below equal nodes nothing is looked at."""
    found, above = [], None
    for n in reversed(LEVELS):
        sides = []
        for side, nodes in (("_old", old), ("_new", new)):
            own = nodes.where(F.col("level") == n)
            if above is not None:
                own = own.withColumn("_up", F.substring("prefix", 1, n - 2)).join(above, ["source_id", "_up"], "left_semi")
            sides.append(own.select("source_id", "prefix", F.col("digest").alias(side)))
        level = sides[0].join(sides[1], ["source_id", "prefix"], "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new"))).select("source_id", "prefix")
        found.append(level.select("source_id", F.lit(n).alias("level"), "prefix"))
        above = level.withColumnRenamed("prefix", "_up")
    return reduce(DataFrame.unionByName, found)


def changes(old_files: DataFrame, new_files: DataFrame, old: DataFrame | None = None, new: DataFrame | None = None) -> DataFrame:
    """source_id, path, state (changed, removed or added) of the files that differ.

    With the stored trees of both, ``old`` and ``new``, only files under leaves that differ are compared; without, all are.
    """
    if old is not None and new is not None:
        leaves = differing(old, new).where(F.col("level") == LEVELS[0]).select("source_id", "prefix")
        leaf = F.substring(F.sha2("path", 256), 1, LEVELS[0])
        old_files, new_files = (f.withColumn("prefix", leaf).join(leaves, ["source_id", "prefix"], "left_semi") for f in (old_files, new_files))
    named = lambda files, name: files.select("source_id", "path", F.struct("sha256", "size").alias(name))
    both = named(old_files, "_old").join(named(new_files, "_new"), ["source_id", "path"], "full_outer")
    state = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.col("_old") == F.col("_new"), "unchanged").otherwise("changed")
    return both.select("source_id", "path", state.alias("state")).where("state <> 'unchanged'")
