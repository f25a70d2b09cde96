"""The stored index: segments, a log of versions, snapshots, and changes that rewrite only what changed.

    path/segments/<number>/{chunks,postings,grams,blocks,documents,parents}
    path/removed/<name>          doc_ids that a version took out or replaced
    path/_log/<version>.json     what a version consists of

A version names segments, each with the version that added it, and removals, each with the version that made it. A
removal holds for segments that are older than it, so a changed document is a new segment and a removal, and nothing
else is written. Writers agree by the log alone: a version's file is put in place in one step that fails if it is there,
and the writer that comes second reads what the first one did and commits on top of it. A reader keeps
the version it opened; files are deleted only by ``vacuum``, when none of the last versions names them.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions.folding import FOLD_VERSION
from quillmark.operators import corpus, postings
from quillmark.operators.validate import manifest_diff
from quillmark.sources.sinks import _file, _get, _now

TABLES = ("chunks", "postings", "grams", "blocks", "documents", "parents")
#: What an index without a chunk reads.
EMPTY = {
    "postings": f"{postings.SCHEMA}, bucket int, segment int",
    "grams": "bucket int, gram string, df long, n_blocks long, segment int",
    "blocks": "block long, sources array<string>, max_bonus double, chunks array<struct<place:int,chunk_id:string,doc_id:string,source_id:string,author:string,chunk_type:string>>, segment int",
}
VERSION = re.compile(r"^(\d{20})\.json$")


class Conflict(RuntimeError):
    """Another writer made the version first."""


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that the log holds, oldest first."""
    fs, log = _file(spark, f"{path}/_log")
    if not fs.exists(log):
        return []
    found = (VERSION.match(s.getPath().getName()) for s in fs.listStatus(log))
    return sorted(int(m[1]) for m in found if m)


def _put_new(spark: SparkSession, path: str, text: str) -> None:
    """Puts a small file in place in one step, or raises ``Conflict`` where one is."""
    fs, target = _file(spark, path)
    fs.mkdirs(target.getParent())
    _, staged = _file(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(staged, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":  # there a rename may replace; a link can't
            files = spark._jvm.java.nio.file
            files.Files.createLink(files.Paths.get(target.toUri().getPath(), spark.sparkContext._gateway.new_array(spark._jvm.String, 0)), files.Paths.get(staged.toUri().getPath(), spark.sparkContext._gateway.new_array(spark._jvm.String, 0)))
        else:
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            context.rename(fs.makeQualified(staged), fs.makeQualified(target), spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Exception as error:
        if fs.exists(target):
            raise Conflict(path) from error
        raise
    finally:
        fs.delete(staged, False)


def _commit(spark: SparkSession, path: str, state: dict) -> None:
    _put_new(spark, f"{path}/_log/{state['version']:020d}.json", json.dumps(state, sort_keys=True))


@dataclass(frozen=True)
class Snapshot:
    """One version of an index; what it reads does not change."""

    spark: SparkSession
    path: str
    state: dict

    @property
    def version(self) -> int:
        return self.state["version"]

    def _raw(self, name: str) -> DataFrame | None:
        parts = [self.spark.read.parquet(f"{self.path}/segments/{s}/{name}").withColumn("segment", F.lit(int(s))) for s, made in sorted(self.state["segments"].items(), key=lambda x: int(x[0])) if name in made["tables"]]
        if not parts and name in EMPTY:
            return self.spark.createDataFrame([], EMPTY[name])
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None

    def removed(self) -> DataFrame | None:
        """segment, doc_id: what newer versions took out of each segment."""
        pairs = [(int(s), r["name"]) for s, made in self.state["segments"].items() for r in self.state["removed"] if r["version"] > made["since"]]
        if not pairs:
            return None
        names = sorted({n for _, n in pairs})
        every = reduce(DataFrame.unionByName, [self.spark.read.parquet(f"{self.path}/removed/{n}").withColumn("name", F.lit(n)) for n in names])
        hold = self.spark.createDataFrame(pairs, "segment int, name string")  # segments times removals; compaction ends both
        return every.join(F.broadcast(hold), "name").select("segment", "doc_id").distinct()

    def table(self, name: str) -> DataFrame:
        """The live rows of chunks, documents or parents."""
        rows, gone = self._raw(name), self.removed()
        if rows is None:
            raise FileNotFoundError(f"{self.path} holds no {name}")
        if gone is not None:
            rows = rows.join(gone, ["segment", "doc_id"], "left_anti")
        return rows.drop("segment")

    def index(self) -> postings.Index:
        """What searches by postings read."""
        return postings.Index(self._raw("postings").drop("segment"), self._raw("grams").drop("segment"), self._raw("blocks").drop("segment"), self.removed())

    def metadata(self) -> dict[str, str]:
        rows = {name: sum(made["rows"].get(name, 0) for made in self.state["segments"].values()) for name in ("chunks", "documents", "parents")}
        return {"fold_version": self.state["fold_version"], "rows": json.dumps(rows, sort_keys=True), "source_credentials": json.dumps(self.state["source_credentials"], sort_keys=True)}


def open_index(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """The latest version, or one that is still kept."""
    have = versions(spark, path)
    if not have or (version is not None and version not in have):
        raise FileNotFoundError(f"{path} holds no index" if version is None else f"{path} holds no version {version}")
    number = have[-1] if version is None else version
    return Snapshot(spark, path, json.loads(_get(spark, f"{path}/_log/{number:020d}.json")))


def find(snapshot: Snapshot, words: str, limit: int, source: str | None = None, author: str | None = None, columns: tuple[str, ...] = ("title",), stepwise: bool = True) -> DataFrame:
    """The first ``limit`` results of a query, found by postings, with more ``columns`` of their chunks.

    The results, at most ``limit``, name the blocks of chunks that are read for them; ``stepwise`` skips blocks that a bound rules out.
    """
    index, spark = snapshot.index(), snapshot.spark
    rows = postings.top(index, words, limit, source, author).rows if stepwise else postings.search(index, words, limit, source, author)
    got = rows.collect()
    found = spark.createDataFrame(got, rows.schema)
    chunks = snapshot._raw("chunks").where(F.col("block").isin(sorted({r.block for r in got}))).select("block", "place", *columns)
    return found.join(chunks, ["block", "place"]).drop("block", "place")


def _claim(spark: SparkSession, path: str) -> int:
    """A number for a segment that no other writer has."""
    number = 0
    fs, folder = _file(spark, f"{path}/segments")
    if fs.exists(folder):
        number = max([0, *(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit())])
    while True:
        number += 1
        try:
            _put_new(spark, f"{path}/segments/{number}/_claimed", "")
            return number
        except Conflict:
            continue


def write_segment(path: str, chunks: DataFrame, documents: DataFrame | None = None, parents: DataFrame | None = None) -> tuple[str, dict]:
    """Writes a segment, which no version names yet: its number, tables and rows.

    Chunks are numbered once, in the written table; all else is made from that, so a retried task can't number them otherwise.
    """
    spark = chunks.sparkSession
    number = _claim(spark, path)
    root = f"{path}/segments/{number}"
    if "doc_id" not in chunks.columns:
        chunks = chunks.withColumn("doc_id", F.col("chunk_id"))
    if "chunk_type" not in chunks.columns:
        chunks = chunks.withColumn("chunk_type", F.lit("text"))
    postings.placed(chunks, number).withColumn("fold_version", F.lit(FOLD_VERSION)).write.option("compression", "zstd").parquet(f"{root}/chunks")
    made = spark.read.parquet(f"{root}/chunks")
    rows, tables = {"chunks": made.count()}, ["chunks"]
    if rows["chunks"]:
        lists = postings.build(made).withColumn("bucket", postings.bucket_of(F.col("gram")))
        # Each task sorts and writes the lists of its own chunks: a shuffle of all positions would need as much disk again and more.
        lists = lists.sortWithinPartitions("bucket", "gram", "unit")
        lists.write.partitionBy("bucket").option("compression", "zstd").parquet(f"{root}/postings")
        df = spark.read.schema(f"{postings.SCHEMA}, bucket int").parquet(f"{root}/postings").groupBy("bucket", "gram").agg(F.sum("n").alias("df"), F.sum("n_blocks").alias("n_blocks"))
        df.repartition("bucket").sortWithinPartitions("bucket", "gram").write.partitionBy("bucket").option("compression", "zstd").parquet(f"{root}/grams")
        postings.blocks_of(made).write.option("compression", "zstd").parquet(f"{root}/blocks")
        if _file(spark, f"{root}/grams/bucket=*")[0].globStatus(_file(spark, f"{root}/grams/bucket=*")[1]):
            tables += ["postings", "grams"]
        tables.append("blocks")
    for name, frame in (("documents", documents), ("parents", parents)):
        if frame is not None:
            frame.write.option("compression", "zstd").parquet(f"{root}/{name}")
            rows[name] = spark.read.parquet(f"{root}/{name}").count()
            tables.append(name)
    return str(number), {"tables": tables, "rows": rows}


def _segment_of(path: str, raw: DataFrame) -> tuple[tuple[str, dict], DataFrame]:
    """A segment of raw texts, and their doc_ids. What they are is worked out once, and read again from where it was written."""
    spark, staged = raw.sparkSession, f"{path}/staged/{uuid.uuid4().hex}"
    corpus.documents_of(raw).write.option("compression", "zstd").parquet(staged)
    docs = spark.read.parquet(staged)
    parents = corpus.parents_of(docs)
    segment = write_segment(path, corpus.chunks_of(parents, docs), docs.drop("text"), parents)
    fs, p = _file(spark, staged)
    fs.delete(p, True)
    return segment, spark.read.parquet(f"{path}/segments/{segment[0]}/documents").select("doc_id")


def _remove(spark: SparkSession, path: str, doc_ids: DataFrame) -> str:
    name = uuid.uuid4().hex
    doc_ids.select("doc_id").distinct().write.parquet(f"{path}/removed/{name}")
    return name


def _add(spark: SparkSession, path: str, segment: tuple[str, dict] | None, removed: str | None, credentials: dict | None = None, mark: tuple[str, int] | None = None) -> Snapshot:
    """Commits a segment and a removal on top of the latest version, whichever that is by then."""
    while True:
        have = versions(spark, path)
        old = open_index(spark, path, have[-1]).state if have else {"version": -1, "segments": {}, "removed": [], "source_credentials": {}, "marks": {}}
        if mark and old["marks"].get(mark[0], -1) >= mark[1]:
            return Snapshot(spark, path, old)
        number = old["version"] + 1
        state = {
            "version": number, "written_at": _now(), "fold_version": FOLD_VERSION,
            "segments": old["segments"] | ({segment[0]: segment[1] | {"since": number}} if segment else {}),
            "removed": old["removed"] + ([{"name": removed, "version": number}] if removed else []),
            "source_credentials": old["source_credentials"] | (credentials or {}),
            "marks": old["marks"] | ({mark[0]: mark[1]} if mark else {}),
        }
        try:
            _commit(spark, path, state)
            return Snapshot(spark, path, state)
        except Conflict:
            continue


def write(path: str, chunks: DataFrame, documents: DataFrame | None = None, parents: DataFrame | None = None, source_credentials: dict | None = None, expected: int | None = None) -> Snapshot:
    """A version of one new segment in place of all before. With ``expected``, raises ``Conflict`` if that is no longer the latest (-1: none is)."""
    spark = chunks.sparkSession
    number, made = write_segment(path, chunks, documents, parents)
    while True:
        latest = (versions(spark, path) or [-1])[-1]
        if expected is not None and latest != expected:
            raise Conflict(f"{path} is at version {latest}, not {expected}")
        state = {"version": latest + 1, "written_at": _now(), "fold_version": FOLD_VERSION, "segments": {number: made | {"since": latest + 1}}, "removed": [], "source_credentials": source_credentials or {}, "marks": {}}
        try:
            _commit(spark, path, state)
            return Snapshot(spark, path, state)
        except Conflict:
            if expected is not None:
                raise


def upsert(path: str, raw: DataFrame, mark: tuple[str, int] | None = None, credentials: dict | None = None) -> Snapshot:
    """Adds raw texts (source_id, path, text, author, once each); what the index holds of their documents is replaced.

    Of an empty text only the removal is left. A ``mark`` (name, number) that the index has reached is not committed again.
    """
    spark = raw.sparkSession
    if mark and (have := versions(spark, path)) and open_index(spark, path, have[-1]).state["marks"].get(mark[0], -1) >= mark[1]:
        return open_index(spark, path)
    segment, doc_ids = _segment_of(path, raw)
    return _add(spark, path, segment, _remove(spark, path, doc_ids), credentials, mark)


def update(path: str, raw: DataFrame, credentials: dict | None = None) -> tuple[Snapshot, DataFrame]:
    """Brings the index to the state of ``raw`` (all files: source_id, path, text, author): the new version, and path, state of every file.

    Only changed and added files are cut, folded and written; removed and changed ones are taken out by their ids. A file whose
    source or author changed counts as changed too.
    """
    spark = raw.sparkSession
    now = corpus.documents_of(raw)
    have = versions(spark, path)
    before = open_index(spark, path, have[-1]).table("documents") if have else spark.createDataFrame([], now.drop("text").schema)
    known = lambda d: d.select("path", F.sha2(F.concat_ws("\x1f", "sha256", "source_id", "author"), 256).alias("sha256"))
    states = manifest_diff(known(before), known(now))
    segment, doc_ids = _segment_of(path, raw.join(states.where(F.col("state").isin("changed", "added")).select("path"), "path", "left_semi"))
    gone = before.join(states.where(F.col("state") == "removed").select("path"), "path", "left_semi").select("doc_id").unionByName(doc_ids)
    if have and gone.isEmpty():
        fs, p = _file(spark, f"{path}/segments/{segment[0]}")
        fs.delete(p, True)
        return open_index(spark, path), states
    return _add(spark, path, segment, _remove(spark, path, gone), credentials), states


def compact(spark: SparkSession, path: str) -> Snapshot:
    """One segment of the live rows of all; raises ``Conflict`` if a writer commits meanwhile, and leaves the index as it is."""
    old = open_index(spark, path)
    if len(old.state["segments"]) == 1 and not old.state["removed"]:
        return old
    own = lambda name: old.table(name) if old._raw(name) is not None else None
    number, made = write_segment(path, old.table("chunks").drop("block", "place", "fold_version"), own("documents"), own("parents"))
    state = old.state | {"version": old.version + 1, "written_at": _now(), "segments": {number: made | {"since": old.version + 1}}, "removed": []}
    _commit(spark, path, state)
    return Snapshot(spark, path, state)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Deletes the log of all but the last ``keep`` versions, and segments and removals that none of those names; what went.

    Segments newer than any that the last version names may be a writer's at work, and stay.
    """
    if keep < 1:
        raise ValueError("at least one version stays")
    have = versions(spark, path)
    states = [open_index(spark, path, v).state for v in have[-keep:]]
    segments = {s for state in states for s in state["segments"]}
    removed = {r["name"] for state in states for r in state["removed"]}
    newest = max(map(int, segments), default=0)
    gone = [f"_log/{v:020d}.json" for v in have[:-keep]]
    for folder, kept in (("segments", segments), ("removed", removed)):
        fs, top = _file(spark, f"{path}/{folder}")
        for status in fs.listStatus(top) if fs.exists(top) else ():
            name = status.getPath().getName()
            if name not in kept and (folder == "removed" and status.getModificationTime() < _oldest(spark, path, have, keep) or folder == "segments" and name.isdigit() and int(name) < newest):
                gone.append(f"{folder}/{name}")
    for name in gone:
        fs, p = _file(spark, f"{path}/{name}")
        fs.delete(p, True)
    return sorted(gone)


def _oldest(spark: SparkSession, path: str, have: list[int], keep: int) -> int:
    """When the oldest kept version was written: a removal that is newer and not yet named may be a writer's at work."""
    fs, p = _file(spark, f"{path}/_log/{have[-keep:][0]:020d}.json")
    return fs.getFileStatus(p).getModificationTime()
