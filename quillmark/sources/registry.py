"""Registered sources and the scans of what they hold."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.operators import corpus
from quillmark.sources import sinks

SOURCES = "source_id string, display_name string, status string, source_path string, approved_on date, smoke_query string, author string"
DOCUMENTS = "doc_id string, source_id string, title string, author string, path string, sha256 string"
PARENTS = "parent_id string, doc_id string, source_id string, ord int, text string"
CHUNKS = "chunk_id string, parent_id string, doc_id string, source_id string, ord int, text string, title string, author string, topics array<string>, chunk_type string, claim_type string"
METHODS = "method_id string, source_id string, chunk_id string, title string"
CONFLICTS = "conflict_id string, source_id string, chunk_id string, title string"
APPROVED = "approved"


def parse_registry(text: str) -> list[dict[str, str]]:
    """Reads the registry's form: a list of flat entries, ``- key: value`` and further ``key: value`` lines."""
    rows: list[dict[str, str]] = []
    for line in text.splitlines():
        body = line.split(" #")[0].rstrip()
        if not body.strip() or body.lstrip().startswith("#") or body.strip() == "sources:":
            continue
        body = body.strip()
        if body.startswith("- "):
            rows.append({})
            body = body[2:]
        key, _, value = body.partition(":")
        rows[-1][key.strip()] = value.strip().strip("'\"")
    return rows


def registered_sources(spark: SparkSession, path: str) -> DataFrame:
    """The registry as it is now; its entries are a short list read on the driver."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    rows = [{"source_id": r.get("id", r.get("source_id")), **{k: r.get(k) for k in ("display_name", "status", "source_path", "smoke_query", "author", "approved_on")}} for r in parse_registry(text)]
    names = [c.split()[0] for c in SOURCES.split(", ")]
    made = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SOURCES.replace(" date", " string"))
    return made.withColumn("approved_on", F.to_date("approved_on"))


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of a product or plain file under a fixed schema; no rows where an optional one is missing."""
    found = sinks.product(spark, path)
    return spark.read.schema(schema).json(found) if found else spark.createDataFrame([], schema)


def libraries(spark: SparkSession, root: str, sources: DataFrame, name: str, schema: str) -> DataFrame:
    """One kind of record from the library directory of every approved source; records that name another source are left out."""
    approved = sorted(r.source_id for r in sources.where(F.col("status") == APPROVED).select("source_id").distinct().collect())  # the registry is a short list
    paths = [p for p in (sinks.product(spark, f"{root}/{s}/{name}.jsonl") for s in approved) if p]
    rows = spark.read.schema(schema).json(paths) if paths else spark.createDataFrame([], schema)
    return rows.where(F.col("source_id").isin(approved))


def directories(spark: SparkSession, root: str) -> DataFrame:
    """source_id of every library directory, whatever its status."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    return names.select(F.regexp_extract("path", rf"{Path(root).name}/([^/]+)/", 1).alias("source_id")).distinct()


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """path and text of whole text files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def raw_manifest(spark: SparkSession, root: str) -> DataFrame:
    """path, sha256 and size of every raw file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def preview(raw: DataFrame, source_id: str) -> DataFrame:
    """What registering a source would add, without a write."""
    return raw.groupBy().agg(F.count("*").alias("files"), F.sum("size").alias("bytes")).select(F.lit(source_id).alias("source_id"), "files", "bytes")


def preview_documents(raw: DataFrame) -> DataFrame:
    """The documents that registering raw texts would add, with the parents and chunks of each; nothing is written."""
    docs = corpus.documents_of(raw)
    parents = corpus.parents_of(docs)
    chunks = corpus.chunks_of(parents, docs)
    count = lambda frame, name: frame.groupBy("doc_id").agg(F.count("*").alias(name))
    whole = docs.drop("text").join(count(parents, "n_parents"), "doc_id", "left").join(count(chunks, "n_chunks"), "doc_id", "left")
    return whole.fillna(0, ["n_parents", "n_chunks"])
