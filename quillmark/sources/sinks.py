"""Products, and the run credentials that tie them to their inputs."""

from __future__ import annotations

import json
import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file beside its place and renames it into it."""
    fs, target = _file(spark, path)
    _, staged = _file(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(staged, True)
    out.write(bytearray(text.encode()))
    out.close()
    # One rename that replaces: a reader sees the old file or the new one, never none.
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(staged), fs.makeQualified(target), options)


def _get(spark: SparkSession, path: str) -> str | None:
    fs, p = _file(spark, path)
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()) if fs.exists(p) else None


def scratch(spark: SparkSession) -> str:
    """A shared folder for what the engine stores: spark.checkpoint.dir; one of our own only where all is one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return named or tempfile.mkdtemp(prefix="quillmark-")


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def start_run(spark: SparkSession, summary: str, inputs: dict) -> dict:
    """Marks a run in progress; a crash leaves it so."""
    state = {"inputs": inputs, "run": {"attempt_id": str(uuid.uuid4()), "status": "in_progress", "started_at": _now(), "finished_at": None}, "outputs": None}
    _put(spark, summary, json.dumps(state, sort_keys=True))
    return state


def finish_run(spark: SparkSession, summary: str, state: dict, outputs: dict) -> dict:
    state = {**state, "run": {**state["run"], "status": "success", "finished_at": _now()}, "outputs": outputs}
    _put(spark, summary, json.dumps(state, sort_keys=True))
    return state


def write_jsonl(frame: DataFrame, path: str) -> None:
    """Replaces a product as a whole: a folder of its own in ``path``, which ``CURRENT`` names from one moment on.

    At every moment the old product or the new one is there; the one before the last is deleted, so a reader that
    began before a replacement can end.
    """
    spark, version = frame.sparkSession, f"v-{uuid.uuid4().hex}"
    before = _get(spark, f"{path}/CURRENT")
    frame.write.json(f"{path}/{version}")
    _put(spark, f"{path}/CURRENT", version)
    fs, top = _file(spark, path)
    for status in fs.listStatus(top):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in (version, before):
            fs.delete(status.getPath(), True)


def product(spark: SparkSession, path: str) -> str | None:
    """The folder of a product's files; a plain file or folder is its own; none where nothing is."""
    fs, p = _file(spark, path)
    if not fs.exists(p):
        return None
    version = _get(spark, f"{path}/CURRENT")
    return f"{path}/{version.strip()}" if version else path


def output_hashes(spark: SparkSession, path: str) -> DataFrame:
    """path, sha256 and rows of each product file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    rows = spark.read.option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").text(path).groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count("*").alias("rows"))
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256")).join(rows, "name", "left").select("path", "sha256", F.coalesce("rows", F.lit(0)).alias("rows"))
