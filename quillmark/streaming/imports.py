"""Continuous import: arriving JSON lines become versions of a stored index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillmark.sources import index

RAW = "source_id string, path string, text string, author string, sent_at timestamp"


def last_sent(batch: DataFrame) -> DataFrame:
    """One row a path: the one sent last; of rows sent at once the one in the newest file, then the greatest by its values.

    Reduced by a maximum, so that a path that was sent very often is summed up on each task first.
    """
    order = F.struct(F.coalesce("sent_at", F.lit("0001-01-01").cast("timestamp")).alias("sent"), "written", "file", *[F.coalesce(c, F.lit("")).alias(f"_{c}") for c in ("source_id", "text", "author")])
    return batch.groupBy("path").agg(F.max_by(F.struct("source_id", "text", "author"), order).alias("r")).select("r.source_id", "path", "r.text", "r.author")


def _put(path: str, name: str):
    def put(batch: DataFrame, epoch: int) -> None:
        # A repeated epoch is one that the index has reached: it changes nothing. A text sent empty leaves the removal of its old chunks.
        index.upsert(path, last_sent(batch), mark=(name, epoch))

    return put


def imported(spark: SparkSession, path: str) -> DataFrame:
    """The imported chunks: of a document that was sent more than once, those of its last text."""
    return index.open_index(spark, path).table("chunks")


def import_stream(spark: SparkSession, folder: str, path: str, checkpoint: str, name: str = "import") -> StreamingQuery:
    """Imports what lies in ``folder`` now and ends. ``name`` tells streams into one index apart; one name, one checkpoint."""
    raw = spark.readStream.schema(RAW).json(folder).select("*", F.col("_metadata.file_modification_time").alias("written"), F.col("_metadata.file_path").alias("file"))
    return raw.writeStream.foreachBatch(_put(path, name)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
