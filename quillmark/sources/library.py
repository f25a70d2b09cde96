"""The library of sources: import of raw files, the index of all approved sources, and the run of all checks over both.

    root/<source_id>/raw/...                      the files as they came
    root/<source_id>/{documents,parents,chunks}.jsonl, methods.jsonl, conflicts.jsonl
    root/<source_id>/manifest, summary.json       what the last import read and wrote
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.operators import analytics, corpus, merkle, validate
from quillmark.sources import index, pdf, registry, sinks

PRODUCTS = {"documents": registry.DOCUMENTS, "parents": registry.PARENTS, "chunks": registry.CHUNKS}


def raw_manifest(spark: SparkSession, root: str, sources: list[str]) -> DataFrame:
    """source_id, path, sha256 and size of the raw files of sources; paths begin at the root."""
    folders = [f"{root}/{s}/raw" for s in sources if sinks.product(spark, f"{root}/{s}/raw")]
    if not folders:
        return spark.createDataFrame([], "source_id string, path string, sha256 string, size long")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
    own = F.regexp_extract("path", r"/([^/]+/raw/.*)$", 1)
    return files.select(F.substring_index(own, "/", 1).alias("source_id"), own.alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def raw_texts(spark: SparkSession, root: str, source_id: str) -> DataFrame:
    """source_id, path, text of a source's raw text files."""
    texts = spark.read.option("recursiveFileLookup", "true").text(f"{root}/{source_id}/raw", wholetext=True)
    return texts.select(F.lit(source_id).alias("source_id"), F.regexp_extract("_metadata.file_path", r"/([^/]+/raw/.*)$", 1).alias("path"), F.col("value").alias("text"))


def pdf_texts(spark: SparkSession, root: str, source_id: str) -> DataFrame:
    """source_id, path, text of the pages of a source's raw PDF files; pages once read are kept beside the products, by the file's hash."""
    pages = pdf.import_pdf(spark, f"{root}/{source_id}/raw", f"{root}/{source_id}/page_texts")
    return pdf.texts_of(pages.withColumn("path", F.regexp_extract("path", r"/([^/]+/raw/.*)$", 1)), source_id)


def product_digests(spark: SparkSession, root: str, sources: list[str]) -> DataFrame:
    """source_id and outputs_sha256: one digest of the files of all products of each source, with their rows."""
    made = []
    for s in sources:
        for name in PRODUCTS:
            path = sinks.product(spark, f"{root}/{s}/{name}.jsonl")
            if path:
                made.append(sinks.output_hashes(spark, path).select(F.lit(s).alias("source_id"), F.concat_ws("/", F.lit(name), F.element_at(F.split("path", "/"), -1)).alias("path"), "sha256", F.col("rows").alias("size")))
    if not made:
        return spark.createDataFrame([], "source_id string, outputs_sha256 string")
    every = made[0]
    for other in made[1:]:
        every = every.unionByName(other)
    return merkle.digests(every).select("source_id", F.col("manifest_digest").alias("outputs_sha256"))


def import_source(spark: SparkSession, root: str, source_id: str, texts: Callable[[SparkSession, str, str], DataFrame] = raw_texts) -> dict:
    """Cuts a source's raw files into its products. The summary says in_progress until the last of them is written."""
    folder, manifest = f"{root}/{source_id}", raw_manifest(spark, root, [source_id])
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    read = spark.read.parquet(f"{folder}/manifest")
    about = merkle.digests(read).first()
    inputs = {"manifest_digest": about.manifest_digest if about else None, "file_count": about.file_count if about else 0}
    state = sinks.start_run(spark, f"{folder}/summary.json", inputs)
    docs = corpus.documents_of(texts(spark, root, source_id))
    parents = corpus.parents_of(docs)
    for name, frame in (("documents", docs.drop("text")), ("parents", parents), ("chunks", corpus.chunks_of(parents, docs))):
        sinks.write_jsonl(frame, f"{folder}/{name}.jsonl")
    outputs = product_digests(spark, root, [source_id]).first()
    return sinks.finish_run(spark, f"{folder}/summary.json", state, {"sha256": outputs.outputs_sha256 if outputs else None})


def summaries(spark: SparkSession, root: str, sources: list[str]) -> list[tuple]:
    """A credential row for each source; all but the source is null where no summary is."""
    rows = []
    for s in sources:
        text = sinks._get(spark, f"{root}/{s}/summary.json")
        got = json.loads(text) if text else {"run": {}, "inputs": {}, "outputs": {}}
        rows.append((s, got["run"].get("status"), got["run"].get("attempt_id"), got["inputs"].get("manifest_digest"), (got["outputs"] or {}).get("sha256")))
    return rows


def approved(sources: DataFrame) -> list[str]:
    return sorted(r.source_id for r in sources.where(F.col("status") == registry.APPROVED).select("source_id").distinct().collect())


def build(spark: SparkSession, root: str, sources: DataFrame, path: str) -> index.Snapshot:
    """The index of all approved sources' products, methods and conflicts typed, with the sources' credentials."""
    read = lambda name, schema: registry.libraries(spark, root, sources, name, schema)
    chunks = corpus.typed(read("chunks", registry.CHUNKS), read("methods", registry.METHODS), read("conflicts", registry.CONFLICTS))
    fields = [c.split()[0] for c in validate.CREDENTIAL.split(", ")]
    credentials = {row[0]: dict(zip(fields, row, strict=True)) for row in summaries(spark, root, approved(sources))}
    return index.write(path, chunks, read("documents", registry.DOCUMENTS), read("parents", registry.PARENTS), credentials)


def check(spark: SparkSession, root: str, sources: DataFrame, path: str, only: set[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """All checks over a library and its stored index, or ``only`` some: the report, and the violations."""
    snapshot, own = index.open_index(spark, path), approved(sources)
    others = [r.source_id for r in sources.select("source_id").distinct().collect() if r.source_id not in own]
    formal = sources.where(F.col("source_id").isin(own))
    tables = {name: snapshot.table(name) for name in ("documents", "parents", "chunks")}
    chunks, ix, meta = tables["chunks"], snapshot.index(), snapshot.metadata()
    smoke = spark.createDataFrame(analytics.smoke_queries(chunks, formal.select("source_id", "smoke_query")).collect(), "source_id string, smoke_query string")  # a row a registered source
    said = spark.createDataFrame(summaries(spark, root, own), validate.CREDENTIAL)
    fields = [c.split()[0] for c in validate.CREDENTIAL.split(", ")]
    has = spark.createDataFrame([tuple(c.get(f) for f in fields) for c in json.loads(meta["source_credentials"]).values()], validate.CREDENTIAL)
    files = raw_manifest(spark, root, own)
    manifests = [m for s in own if sinks.product(spark, m := f"{root}/{s}/manifest")]
    recorded = spark.read.parquet(*manifests) if manifests else files.limit(0)
    products = [registry.libraries(spark, root, sources, name, schema) for name, schema in PRODUCTS.items()]
    text = lambda frame: validate.nul_free(frame, [c for c, t in frame.dtypes if t == "string" and c != "source_id"])
    smoke_terms = sorted({t for r in smoke.collect() if r.smoke_query for t in (r.smoke_query, r.smoke_query[:2])})
    every = {
        "id_sets": lambda: validate.id_sets(formal, registry.directories(spark, root).where(~F.col("source_id").isin(others)), chunks),
        "nonempty": lambda: validate.nonempty(formal, tables),
        "row_counts": lambda: validate.row_counts(json.loads(meta["rows"]), tables),
        "integrity": lambda: validate.integrity(chunks),
        "fold_version": lambda: validate.fold_version(chunks),
        "nul_free": lambda: validate.all_violations(*map(text, [*tables.values(), *products])),
        "smoke_length": lambda: validate.smoke_length(smoke),
        "source_reachable": lambda: validate.source_reachable(ix, smoke),
        "author_reachable": lambda: validate.author_reachable(ix, chunks, analytics.dominant_author_smoke(chunks.where(F.col("author") != corpus.NO_AUTHOR))),
        "recall_coverage": lambda: validate.recall_coverage(ix, chunks, smoke_terms),
        "raw_unchanged": lambda: validate.raw_unchanged(recorded, files),
        "run_status": lambda: validate.run_status(said),
        "manifest_digest": lambda: validate.manifest_digests(said, files),
        "outputs": lambda: validate.outputs(said, product_digests(spark, root, own)),
        "source_credentials": lambda: validate.source_credentials(said, has),
    }
    if snapshot.removed() is not None:  # what a version says it holds counts removed rows too, until it is compacted
        del every["row_counts"]
    ran = [name for name in every if only is None or name in only]
    violations = validate.all_violations(*(every[name]() for name in ran)).persist()  # few rows, counted and shown
    return validate.report(violations, ran), violations
