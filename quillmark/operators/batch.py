"""Many queries in one pass over raw chunks: an automaton of all terms reads each folded field once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmark.functions.folding import fold_ascii, fold_unicode
from quillmark.functions.workers import ship
from quillmark.operators.postings import _points
from quillmark.operators.search import FIELDS, bonus_of, with_kinds
from quillmark.plans.query import parse

FOLDS = {"ascii": fold_ascii, "unicode": fold_unicode}
#: Terms of one automaton; more of them are matched in further passes, so a task's memory is bounded whatever their number.
TERMS_PER_PASS = 200_000


def distinct_terms(queries: dict[str, str]) -> tuple[list[tuple[str, str]], list[tuple[str, int]]]:
    """kind and folded form of the different terms, and which query has which of them."""
    numbers: dict[tuple[str, str], int] = {}
    wanted = [(qid, numbers.setdefault((t.kind, t.folded), len(numbers))) for qid, q in queries.items() for t in parse(q)]
    return list(numbers), wanted


def counted(text: str, automaton) -> dict[int, int]:
    """How often each term of the automaton is in a text, without overlaps with itself."""
    found: dict[int, int] = {}
    free: dict[int, int] = {}  # where each term's next occurrence may begin
    for end, (term, size) in automaton.iter(text):
        if end - size + 1 >= free.get(term, 0):
            found[term] = found.get(term, 0) + 1
            free[term] = end + 1
    return found


def term_hits(chunks: DataFrame, terms: list[tuple[str, str]], first: int = 0, keys: tuple[str, ...] = ("chunk_id", "source_id")) -> DataFrame:
    """``keys`` of each chunk that holds a term, the term's number (from ``first``), and its count in each field."""
    spark, kinds = chunks.sparkSession, sorted({k for k, _ in terms})
    ship(spark)
    sent = spark.sparkContext.broadcast(terms)
    schema = ", ".join([*(f"`{k}` {chunks.schema[k].dataType.simpleString()}" for k in keys), "term int", *(f"{f} long" for f in FIELDS)])
    names = [*keys, "term", *FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        made = {k: ahocorasick.Automaton() for k in kinds}
        for i, (kind, folded) in enumerate(sent.value):
            made[kind].add_word(folded, (first + i, len(folded)))
        for automaton in made.values():
            automaton.make_automaton()
        for batch in batches:
            rows, each = [], []
            for field in FIELDS:
                totals = [{} for _ in range(batch.num_rows)]
                for kind, automaton in made.items():
                    for total, text in zip(totals, batch[f"{field}_{kind}"].to_pylist(), strict=True):
                        if text:
                            total.update(counted(text, automaton))
                each.append(totals)
            for i, fields in enumerate(zip(*each, strict=True)):
                rows += [(i, term, *(f.get(term, 0) for f in fields)) for term in sorted(set().union(*fields))]
            if rows:
                at, *columns = zip(*rows, strict=True)
                taken = batch.select(list(keys)).take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(columns[0], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[1:]]], names=names)

    folded = [FOLDS[k](F.coalesce(f, F.lit(""))).alias(f"{f}_{k}") for f in FIELDS for k in kinds]
    return chunks.select(*keys, *folded).mapInArrow(run, schema)


def batch_search(chunks: DataFrame, queries: dict[str, str], limit: int, by_source: bool = False, kinds: DataFrame | None = None, per_pass: int = TERMS_PER_PASS) -> DataFrame:
    """The first ``limit`` chunks of each query (and of each source, with ``by_source``).

    ``kinds`` (chunk_id, chunk_type) are joined to the candidates, or chunk_type is a column of the chunks. Only rows of
    hits leave a task, without text; those of a query and chunk are summed before they are ranked.
    """
    spark, (terms, wanted) = chunks.sparkSession, distinct_terms(queries)
    if not terms:
        return _empty(spark, chunks)
    typed = kinds is None and "chunk_type" in chunks.columns
    keys = ("chunk_id", "source_id", "chunk_type") if typed else ("chunk_id", "source_id")
    hits = reduce(DataFrame.unionByName, [term_hits(chunks, terms[i : i + per_pass], i, keys) for i in range(0, len(terms), per_pass)])
    of = spark.createDataFrame(wanted, "qid string, term int")
    per = hits.join(F.broadcast(of) if len(wanted) <= 1_000_000 else of, "term")
    ranked = per.groupBy("qid", *keys).agg(F.max((F.col("text") > 0).cast("int")).alias("prose_hit"), F.count("*").cast("int").alias("term_count"), F.sum(_points()).alias("_points"))
    ranked = with_kinds(ranked, kinds).withColumn("score", F.col("_points") + bonus_of(F.col("chunk_type")))
    order = Window.partitionBy("qid", *["source_id"] * by_source).orderBy(F.desc("prose_hit"), F.desc("term_count"), F.desc("score"), F.asc("chunk_id"))
    return ranked.withColumn("position", F.row_number().over(order)).where(F.col("position") <= limit).select("qid", "position", "chunk_id", "source_id", "prose_hit", "term_count", "score")


def _empty(spark: SparkSession, chunks: DataFrame) -> DataFrame:
    return spark.createDataFrame([], f"qid string, position int, chunk_id {chunks.schema['chunk_id'].dataType.simpleString()}, source_id string, prose_hit int, term_count int, score double")
