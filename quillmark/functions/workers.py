"""Makes this package importable where Spark's Python workers run."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package's code once a session, unless the workers' path has it."""
    sc = spark.sparkContext
    path = [Path.cwd(), *map(Path, os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    if sc.applicationId not in _shipped and ROOT not in [p.resolve() for p in path]:
        folder = tempfile.mkdtemp(prefix="quillmark-code-")  # read by the driver alone, which serves it
        sc.addPyFile(shutil.make_archive(f"{folder}/quillmark", "zip", ROOT, "quillmark"))
    _shipped.add(sc.applicationId)
