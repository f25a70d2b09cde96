"""Embedding whitening by digit-slice GEMM.

Entries become integers, and all that is summed over rows is exact: each task centres its integers first
(n times a value less the sum of all), cuts them into signed limbs of 20 bits and multiplies limb by limb in
float64, in blocks of at most 8192 rows, so that no product or sum of a BLAS call needs more than 53 bits. The
products are recombined to big integers; a task's sums leave it as digits of 18 decimal places, which Spark sums
for all tasks and the driver joins again. The covariance is one exact division for each pair of dimensions, rounded once, and its
eigenvectors give the components. As nothing is rounded before that, the result does not depend on how
rows are dealt to tasks, nor on an offset that dwarfs the spread.

Vectors are read four times (sums, products, whiteness, output), each time in one pass without a shuffle of rows. A
task keeps one matrix for each number of dimensions that it sees, and sends one row of digits for each pair of dimensions. The driver and the tasks
get the pairs' sums and the components: bounded by the square of the dimensions, whatever the number of rows.

Defined cases: a vector that is null, or holds null, NaN or an infinity, is dropped, and so is an empty one, which has no component.
Vectors of each length are fitted apart. Scaled entries beyond 2**62 are taken as 2**62. Repeated rows and null ids count
each. Components of equal variance come in the solver's order; each component's largest entry is positive. A component without
variance (not above rounding of the largest) has a null ``whitened`` and is no part of ``identity_error``, which is 0 if all are so. A
``deviation`` too large for a long is null in the query's long, never wrong; ``deviations`` has it as text. Very long vectors are
cut into smaller blocks of rows. An empty table gives an empty result. Other columns are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SCALE, OFFSET, LARGEST = 64, 1_000_000, 2.0**62
LIMB_BITS, BLOCK_ROWS, BLOCK_ENTRIES = 20, 8192, 1 << 21
DIGITS = 10**18
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Model:
    """What one number of dimensions was fitted to."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray  # a column each, by falling variance
    variances: np.ndarray
    trace: float
    usable: int  # so many components have variance


def finite(embeddings: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows whose vector has only finite entries, at least one."""
    v = F.col("embedding").cast("array<double>")
    good = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector")).where(F.coalesce(good, F.lit(False)))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integers (rows by dimensions) of rows with one number of dimensions, in blocks of bounded size."""
    for batch in batches:
        ids, lists = batch["vec_id"], batch["vector"]
        ends = np.asarray(lists.offsets.to_numpy(zero_copy_only=False), np.int64)
        sizes, values = np.diff(ends), lists.values.to_numpy(zero_copy_only=False)
        for d in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == d)
            step = max(1, min(BLOCK_ROWS, BLOCK_ENTRIES // d))
            for at in range(0, len(rows), step):
                own = rows[at : at + step]
                x = values[ends[own][:, None] + np.arange(d)]
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(x * SCALE), -LARGEST, LARGEST)
                yield ids.take(pa.array(own)), x.astype(np.int64) + OFFSET


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - sums, exactly: in 64 bits where they hold it, else as Python's integers."""
    # Bounded by |n x| + |S|; both are below n times the largest possible entry.
    if n * int(np.abs(x).max(initial=0)) + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """Signed limbs, least first, as float64: y is their sum, each times 2 ** (20 * its place)."""
    out, mask = [], (1 << LIMB_BITS) - 1
    while True:
        if not y.size or max(abs(int(y.max())), abs(int(y.min()))) <= mask:
            return [*out, y.astype(np.float64)]
        out.append((y & mask).astype(np.float64))
        y = y >> LIMB_BITS


def products(y: np.ndarray) -> np.ndarray:
    """The upper triangle of y.T @ y by places of 20 bits, from exact float64 products of limbs; at most 8192 rows."""
    if len(y) > BLOCK_ROWS:
        raise ValueError("too many rows for exact products")
    parts, upper = limbs(y), np.triu_indices(y.shape[1])
    out = np.zeros((2 * len(parts) - 1, len(upper[0])), np.int64)
    for i, a in enumerate(parts):
        for j in range(i, len(parts)):
            p = (a.T @ parts[j]).astype(np.int64)
            out[i + j] += p[upper] if i == j else p[upper] + p.T[upper]
    return out


class Places:
    """Sums of numbers by places of 20 bits, a row a place, without overflow: every 32nd addition carries."""

    def __init__(self) -> None:
        self.sums, self.added = np.zeros((0, 0), np.int64), 0

    def add(self, places: np.ndarray) -> None:
        rows, cells = max(len(places), len(self.sums)), places.shape[1]
        if len(self.sums) < rows:
            self.sums = np.vstack([self.sums.reshape(-1, cells), np.zeros((rows - len(self.sums), cells), np.int64)])
        self.sums[: len(places)] += places
        self.added += 1
        if self.added % 32 == 0:
            last = len(self.sums) - 1
            if np.abs(self.sums[last]).max(initial=0) > 1 << 58:
                self.sums, last = np.vstack([self.sums, np.zeros((1, cells), np.int64)]), last + 1
            for i in range(last):
                self.sums[i + 1] += self.sums[i] >> LIMB_BITS
                self.sums[i] &= (1 << LIMB_BITS) - 1

    def values(self, first: int, last: int) -> list[int]:
        """The numbers as Python's integers."""
        columns = self.sums[:, first:last].T.tolist()
        return [sum(v << (LIMB_BITS * i) for i, v in enumerate(c)) for c in columns]


def digits_of(value: int) -> list[int]:
    """The value in base 10 ** 18, least first; all of them have its sign."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        value, low = divmod(value, DIGITS)
        out.append(sign * low)
    return out


def _summed(rows: DataFrame) -> list:
    """dims, cell and value (a Python integer) of the sums of digits over all tasks."""
    each = rows.select("dims", "start", F.posexplode("cells").alias("at", "digits")).select("dims", (F.col("start") + F.col("at")).alias("cell"), F.posexplode("digits").alias("place", "digit"))
    total = each.groupBy("dims", "cell", "place").agg(F.sum(F.col("digit").cast("decimal(38,0)")).alias("sum"))
    return total.groupBy("dims", "cell").agg(F.collect_list(F.struct("place", F.col("sum").cast("string").alias("sum"))).alias("sums")).collect()  # a row a pair of dimensions


def _values(rows: list) -> dict[int, dict[int, int]]:
    out: dict[int, dict[int, int]] = {}
    for r in rows:
        out.setdefault(r.dims, {})[r.cell] = sum(int(s["sum"]) * DIGITS ** s["place"] for s in r.sums)
    return out


CELLS, CHUNK = "dims int, start int, cells array<array<long>>", 1 << 16


def _emit(found: dict[int, Places]) -> Iterator[pa.RecordBatch]:
    for d, sums in found.items():
        for at in range(0, sums.sums.shape[1], CHUNK):
            cells = [digits_of(v) for v in sums.values(at, at + CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([at], pa.int32()), pa.array([cells], pa.list_(pa.list_(pa.int64())))], names=["dims", "start", "cells"])


def _per_task(places_of, most_cells: int = 1 << 24):
    """A task that adds its blocks up, for each number of dimensions; it hands over early what takes too much memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Places] = {}
        for _, x in blocks(batches):
            found.setdefault(x.shape[1], Places()).add(places_of(x))
            if len(found) > 1 and sum(p.sums.size for p in found.values()) > most_cells:
                yield from _emit(found)
                found = {}
        yield from _emit(found)

    return run


def counts(x: np.ndarray) -> np.ndarray:
    """The number of rows and the column sums, by places of 20 bits."""
    ones = np.concatenate([np.ones((len(x), 1), np.int64), x], axis=1)
    return np.stack([np.where(i < 3, ones >> (LIMB_BITS * i) & ((1 << LIMB_BITS) - 1), ones >> (LIMB_BITS * i)).sum(axis=0) for i in range(4)])


def fit(vectors: DataFrame, most: int = 32) -> dict[int, Model]:
    """The model of each number of dimensions, from all vectors."""
    per_task = lambda places_of: _values(_summed(vectors.select("vec_id", "vector").mapInArrow(_per_task(places_of), CELLS)))
    counted = {d: (v[0], tuple(v.get(i + 1, 0) for i in range(d))) for d, v in per_task(counts).items()}

    def scatter(x: np.ndarray) -> np.ndarray:
        return products(centred(x, *counted[x.shape[1]]))

    sums, models = per_task(scatter), {}
    for d, (n, totals) in counted.items():
        cells, v, upper = sums.get(d, {}), np.zeros((d, d)), np.triu_indices(d)
        v[upper] = [cells.get(i, 0) / n**3 for i in range(len(upper[0]))]  # of integers: rounded once
        values, vectors_ = np.linalg.eigh(np.triu(v) + np.triu(v, 1).T)
        order = np.argsort(-values, kind="stable")[:most]
        values, vectors_ = np.maximum(values[order], 0.0), vectors_[:, order]
        vectors_ = vectors_ * np.where(vectors_[np.abs(vectors_).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
        usable = int(np.count_nonzero(values > d * np.finfo(float).eps * values.max(initial=0.0)))
        trace = sum(cells.get(i * d - i * (i - 1) // 2, 0) for i in range(d)) / n**3
        models[d] = Model(n, totals, vectors_, values, trace, usable)
    return models


def _projected(y: np.ndarray, m: Model) -> np.ndarray:
    """The usable components of centred rows, whitened."""
    return (y.astype(np.float64) / m.n) @ m.components[:, : m.usable] / np.sqrt(m.variances[: m.usable])


def deviations(y: np.ndarray) -> list[int]:
    """The exact sum of squares of each row."""
    if y.dtype != object and int(np.abs(y).max(initial=0)) ** 2 * max(1, y.shape[1]) < 1 << 62:
        return (y * y).sum(axis=1).tolist()
    y = y.astype(object)
    return (y * y).sum(axis=1).tolist()


def identity_errors(vectors: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """Of each number of dimensions, the largest entry of the whitened rows' covariance less the identity.

    A block is centred on its own mean before it is multiplied; the blocks' means are put back in their weighted squares.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in blocks(batches):
            m = models[x.shape[1]]
            w = _projected(centred(x, m.n, m.sums), m)
            mean = w.mean(axis=0)
            w = w - mean
            cells = np.concatenate([len(w) * mean, (w.T @ w + len(w) * np.outer(mean, mean)).ravel()])
            yield pa.RecordBatch.from_arrays([pa.array([x.shape[1]], pa.int32()), pa.array([cells.tolist()], pa.list_(pa.float64()))], names=["dims", "cells"])

    cells = vectors.select("vec_id", "vector").mapInArrow(run, "dims int, cells array<double>").select("dims", F.posexplode("cells").alias("cell", "value"))
    sums: dict[int, dict[int, float]] = {}
    for r in cells.groupBy("dims", "cell").agg(F.sum("value").alias("value")).collect():  # a row a pair of components
        sums.setdefault(r.dims, {})[r.cell] = r.value
    out = {}
    for d, m in models.items():
        k, own = m.usable, sums.get(d, {})
        mean = np.array([own[i] for i in range(k)]) / m.n
        squares = np.array([own[k + i] for i in range(k * k)]).reshape(k, k) / m.n
        out[d] = float(np.abs(squares - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))
    return out


def whiten(vectors: DataFrame, models: dict[int, Model]) -> DataFrame:
    """vec_id, dims, n, deviation (exact, as text) and whitened (an array by component, null without variance) of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in blocks(batches):
            m = models[x.shape[1]]
            y = centred(x, m.n, m.sums)
            w = _projected(y, m)
            k = m.components.shape[1]
            made = [row + [None] * (k - m.usable) for row in w.tolist()]
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array([x.shape[1]] * len(x), pa.int32()), pa.array([m.n] * len(x), pa.int64()), pa.array(list(map(str, deviations(y)))), pa.array(made, pa.list_(pa.float64()))], names=["vec_id", "dims", "n", "deviation", "whitened"])

    return vectors.select("vec_id", "vector").mapInArrow(run, "vec_id long, dims int, n long, deviation string, whitened array<double>")


def components(embeddings: DataFrame, most: int = 32) -> DataFrame:
    """A row for each finite vector and component: see RESULT."""
    spark, vectors = embeddings.sparkSession, finite(embeddings)
    models = fit(vectors, most)
    errors = identity_errors(vectors, models)
    about = [(d, [float(v / m.trace) if m.trace else 0.0 for v in m.variances], errors[d]) for d, m in models.items()]
    facts = spark.createDataFrame(about, "dims int, explained array<double>, identity_error double")  # a row a number of dimensions
    each = whiten(vectors, models).join(F.broadcast(facts), "dims")
    each = each.select("vec_id", "n", "explained", "identity_error", F.expr("try_cast(deviation as bigint)").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened", F.get("explained", F.col("at")).alias("explained"), "identity_error")
