"""Language ID by the nearest of several centroids per language.

A text is the vector of its hashed letter n-grams (1 to 3 letters, words apart, lower case), term
frequency damped by a root, times inverse document frequency, normalised. Document frequencies come
from all learning documents: each task counts its own, and what is shuffled is one row per feature
and task. Centroids come from spherical k-means over a bounded sample: at most ``per_language``
different rows of a language, those of least hash, in every language. Each language's centroids are fitted
where its sample is, and only centroids reach the driver. The score is the cosine with the nearest centroid; texts nearer to none than
``reject_below`` are marked rejected.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and rejected. Null
languages teach nothing; a null doc_id is never held out nor learned from. Without anything to
learn from every text is ``und``. Texts are read whole. Of centroids as near the first by language wins. Repeated rows are judged one by one. An empty table gives an empty
result. Extra columns pass through where ``carry`` names them, else they are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmark.llm.bytebpe import slices
from quillmark.llm.common import crc_mod, materialize

FEATURES = 1 << 12
UNKNOWN = "und"


_not_alpha: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text with every run of other characters as one 0, and 0 at both ends."""
    if not _not_alpha:  # a table over the basic plane, made once per worker
        _not_alpha.append(np.array([not chr(c).isalpha() for c in range(1 << 16)]))
    raw = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    other = _not_alpha[0][np.minimum(raw, 0xFFFF)]
    high = np.flatnonzero(raw >= 1 << 16)
    other[high] = [not chr(c).isalpha() for c in raw[high].tolist()]
    kept = np.concatenate([[0], np.where(other, 0, raw), [0]]).astype(np.uint64)
    return kept[np.append(True, (kept[1:] != 0) | (kept[:-1] != 0))]


def counts(text: str | None, n_features: int = FEATURES) -> np.ndarray | None:
    """How often each hashed n-gram occurs; None without a letter."""
    c = letters(text or "")
    if len(c) < 3:
        return None
    mix = np.uint64(0x9E3779B97F4A7C15)
    shift = np.uint64(64 - n_features.bit_length() + 1)
    one = c[c > 0] * mix
    two = (c[:-1] << np.uint64(21) | c[1:]) * mix + np.uint64(1)
    three = ((c[:-2] << np.uint64(42)) ^ (c[1:-1] << np.uint64(21)) ^ c[2:]) * mix
    three = three[c[1:-1] > 0]
    hashed = np.concatenate([one, two, three])
    return np.bincount(((hashed ^ (hashed >> np.uint64(29))) * mix >> shift).astype(np.int64), minlength=n_features)


def vectors(texts: list[str | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised vectors of the texts that have letters, and which texts those are."""
    made = [None if c is None else c.astype(np.float32) for c in (counts(t, len(idf)) for t in texts)]
    has = np.array([c is not None for c in made], bool)
    if not has.any():
        return np.zeros((0, len(idf)), np.float32), has
    x = np.sqrt(np.array([c for c in made if c is not None])) * idf.astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12), has


def document_frequency(learning: DataFrame, n_features: int = FEATURES) -> tuple[np.ndarray, int]:
    """In how many documents each feature occurs, over all of them, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        total, n = np.zeros(n_features, np.int64), 0
        for batch in slices(batches, "text"):
            for text in batch["text"].to_pylist():
                c = counts(text, n_features)
                if c is not None:
                    total += c > 0
                    n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], names=["feature", "n"])

    rows = learning.select("text").mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    df, n = np.zeros(n_features, np.int64), 0
    for r in rows:  # at most one row per feature and one more
        if r["feature"] < 0:
            n = r["n"]
        else:
            df[r["feature"]] = r["n"]
    return df, n


def cluster(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from spread-out starts."""
    chosen = [0]
    for _ in range(min(k, len(x)) - 1):
        chosen.append(int((x @ x[chosen].T).max(axis=1).argmin()))
    c = x[chosen]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        c = np.array([x[near == j].sum(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def fit(learning: DataFrame, per_language: int = 200, k: int = 3, n_features: int = FEATURES, most_broadcast: int = 1_000_000) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(idf, centroids, language of each centroid) from rows with doc_id, text and lang."""
    learning = learning.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    df, n = document_frequency(learning, n_features)
    idf = np.log((1 + n) / (1 + df)) + 1
    # Equal rows are one, so a language gives as many texts as are picked, however often a doc_id or a row repeats.
    keyed = learning.select("lang", "text", F.xxhash64("doc_id", "text").alias("key"))
    least = Window.partitionBy("lang").orderBy("key")
    keys = keyed.select("lang", "key").distinct().withColumn("_r", F.row_number().over(least)).where(F.col("_r") <= per_language)
    keys = materialize(keys.select("lang", "key"))
    if keys.count() <= most_broadcast:  # else the join is shuffled
        keys = F.broadcast(keys)
    picked = keyed.join(keys, ["lang", "key"], "left_semi").dropDuplicates(["lang", "key"]).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in slices(batches, "text"):
            x, has = vectors(batch["text"].to_pylist(), idf)
            yield pa.RecordBatch.from_arrays([batch["lang"].filter(pa.array(has)), pa.array([v.tobytes() for v in x], pa.binary())], names=["lang", "x"])

    def centroids(group: pa.Table) -> pa.Table:
        c = cluster(np.array([np.frombuffer(v, np.float32) for v in sorted(x.as_py() for x in group["x"])]), k)
        return pa.table({"lang": pa.array([group["lang"][0].as_py()] * len(c), pa.string()), "at": pa.array(range(len(c)), pa.int32()), "c": pa.array([v.tobytes() for v in c.astype(np.float32)], pa.binary())})

    made = picked.mapInArrow(run, "lang string, x binary").groupBy("lang").applyInArrow(centroids, "lang string, at int, c binary").collect()
    made.sort(key=lambda r: (r["lang"], r["at"]))
    cents, langs = [np.frombuffer(bytes(r["c"]), np.float32)[None] for r in made], [r["lang"] for r in made]
    return idf, np.concatenate(cents) if cents else np.zeros((0, n_features), np.float32), langs


def predict(documents: DataFrame, model: tuple[np.ndarray, np.ndarray, list[str]], reject_below: float = 0.2, carry: list[str] | None = None) -> DataFrame:
    """The carried columns (doc_id) with lang_pred, score and rejected."""
    carry = carry or ["doc_id"]
    shared = documents.sparkSession.sparkContext.broadcast(model)
    source = documents.select(*carry, F.col("text").alias("_text"))
    made = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    schema = T.StructType([f for f in source.schema.fields if f.name != "_text"] + made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        idf, cents, langs = shared.value
        short = (b.slice(i, 1000) for b in slices(batches, "_text") for i in range(0, b.num_rows, 1000))
        for batch in short:
            x, has = vectors(batch["_text"].to_pylist(), idf)
            lang, score = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
            if len(cents) and len(x):
                cos = x @ cents.T.astype(np.float32)
                best = cos.argmax(axis=1)
                lang[has], score[has] = np.array(langs, object)[best], np.clip(cos[np.arange(len(x)), best], 0, 1)
            reject = (score < reject_below) | (lang == UNKNOWN)
            own = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(reject)], names=[f.name for f in schema.fields])

    return source.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(crc_mod(doc_id, 4) == 2, F.lit(False))


def identify(documents: DataFrame, reject_below: float = 0.2, carry: list[str] | None = None) -> DataFrame:
    """Learns from the documents that are not held out and predicts all."""
    model = fit(documents.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    return predict(documents, model, reject_below, carry)


def query(documents: DataFrame) -> DataFrame:
    return identify(documents).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
