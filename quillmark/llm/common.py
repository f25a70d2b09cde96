"""Helpers that the training-data operators share."""

from __future__ import annotations

import contextlib
import ctypes
import os
import shutil
import tempfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words: space, and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, unless their path has it already."""
    sc = spark.sparkContext
    path = [Path.cwd(), *map(Path, os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    if sc.applicationId not in _shipped and ROOT not in [p.resolve() for p in path]:
        folder = tempfile.mkdtemp(prefix="quillmark-code-")
        sc.addPyFile(shutil.make_archive(f"{folder}/quillmark", "zip", ROOT, "quillmark"))
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; a folder of our own only where that is unset and all is one machine (tests)."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and sc.getCheckpointDir() is None and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="quillmark-ckpt-"))
    return named or sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of our own in the shared file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release() -> None:
    """Gives memory that Arrow and the C library hold free back to the system, as far as they can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(c: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), SPACE + "+"), "")


def crc_mod(c: Column, n: int) -> Column:
    """crc32 of a column as text, modulo n; null for null."""
    return F.crc32(c.cast("string")) % F.lit(n)


def pack(*arrays: np.ndarray) -> bytes:
    """Floats, counts, or ascending 64-bit hashes (as differences), byte by byte and compressed."""
    out = []
    for a in arrays:
        code = 0
        if a.dtype == np.uint64:
            a, code = np.diff(a, prepend=np.uint64(0)), 200
        elif a.dtype == np.float64:
            code = 100
        else:
            a = a.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if not len(a) or int(a.max()) <= np.iinfo(t).max))
        body = pa.compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T), codec="zstd", asbytes=True) if len(a) else b""
        out.append(np.array([code + a.itemsize, len(a), len(body)], np.int64).tobytes() + body)
    return b"".join(out)


def unpack(body: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(body):
        code, n, size = np.frombuffer(body, np.int64, 3, at).tolist()
        item, at = code % 100, at + 24
        if n:
            flat = np.frombuffer(pa.decompress(body[at : at + size], decompressed_size=item * n, codec="zstd", asbytes=True), np.uint8)
            a = np.ascontiguousarray(flat.reshape(item, n).T).reshape(-1).view(np.float64 if 100 < code < 200 else f"u{item}")
            a = np.cumsum(a, dtype=np.uint64) if code > 200 else a
        else:
            a = np.zeros(0, np.float64 if 100 < code < 200 else np.uint64)
        out.append(a)
        at += size
    return out


def edges(buckets: int) -> np.ndarray:
    """Where ranges of hashes begin."""
    return np.array([-(-(i << 64) // buckets) for i in range(buckets)], np.uint64)
