"""The corpus pipeline: quality rules, language ID, near-duplicate removal, packing.

Defined cases: null and empty texts have no words, so the quality rules drop them; repeated rows with
one doc_id and text are one document after the third stage; an empty table gives no pieces; extra
columns, whatever their names, are carried up to the last stage. Of documents alike in all that a stage compares, any one may
stay, and always the same. Long texts are read whole by each stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm import divergence, langid, packing, partenum
from quillmark.llm.common import materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the divergence from their language's references both keep."""
    return divergence.judge(docs, carry=True)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near enough to a centroid of some language."""
    whole = docs.select("doc_id", "text", "lang", F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    return langid.identify(whole, carry=["_row"]).where(~F.col("rejected")).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least doc_id, of each component of the n-gram Jaccard join.

    Rows go by a number, a hash of their doc_id and text, so those that share a doc_id are told apart, and only
    repeated rows share a number; of these one stays. Documents without words are no one's copies.
    """
    numbered = docs.select(F.xxhash64(docs["doc_id"], docs["text"]).alias("doc_id"), docs["text"].alias("text"), docs["doc_id"].alias("own_id"))
    found = partenum.join(numbered, count_links=False, carry="own_id")
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col("own_id").isNull().alias("none"), "own_id", "doc_id")).alias("r")).select(F.col("r.doc_id").alias("kept")).alias("first")
    own = docs.alias("own")
    kept = own.join(first, F.xxhash64("own.doc_id", "own.text") == F.col("first.kept"), "left_semi").select("own.*")
    return kept.dropDuplicates(["doc_id", "text"])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rules), ("language ID", language_id), ("n-gram Jaccard join", near_duplicates), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to documents, each over a written copy of what the one before it kept."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
