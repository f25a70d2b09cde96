"""LM scoring: a Katz back-off model of any order with Good-Turing discounts.

P(w|h) is d(c) c(h,w) / c(h) where the n-gram (h,w) was learned, else alpha(h) P(w|h'), h' being h
without its first word, and P(w|h') itself where h was never learned; P(w) is d(c) c(w) / N, what the
discounts leave being the probability of any unknown word. Discounts follow the Good-Turing counts of
counts of each order up to ``K`` and are at most ``CEILING``, so every context leaves some mass, and
alpha(h) = (1 - sum of P(w|h)) / (1 - sum of P(w|h')) over the words seen after h, summed exactly.

Work goes by slices and buckets. A slice is a bounded run of tokens; a long text is cut over
several, each led by the words before it. A slice asks, for each of its *distinct* n-grams of each
order, the bucket that holds the n-gram's hash; the bucket adds up what slices learned and answers
with the counts. One of the slices that hold an n-gram owns it and adds its part to its context's
sums, which meet, by the context's hash, in the same way; a slice that backs off asks for the
context's weight there. The slice then follows each token's recursion down the orders. A bucket thus
meets an n-gram or a context once a slice at most, however often it occurs: the end of a text, or a
word that is a third of all, weighs no more than any other. The number of buckets follows the
amount of text. Nothing but a row of counts of counts is broadcast.

Counts and weights are stored as tables, partitioned by kind and order, rows by range of hashes:
``ngrams`` (sorted hashes, counts) and ``weights`` (sorted hashes of contexts, log10 of alpha).

Defined cases: a null text counts as empty, whose only token is the end. A null doc_id teaches
nothing and is not held out. Long texts are cut over slices, and their scores are added up. Repeated
rows teach as often as they occur, and each is scored. Ties cannot arise: no row is chosen over
another. Without anything to learn from, score is null and base_score 0 or below by its formula. An
empty table gives an empty result. Extra columns are dropped.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.bytebpe import slices
from quillmark.llm.common import crc_mod, edges, ensure_checkpoint_dir, materialize, pack, remove, unpack

#: Hashes that stand for the end of a text, for what is before its first word, and for what is before that.
END, START, NONE = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x85EBCA77C2B2AE63)
MIX, S29, S32 = np.uint64(0x9E3779B97F4A7C15), np.uint64(29), np.uint64(32)
K, CEILING = 5, 0.999
#: What travels: to a slice (its number) or a bucket (below zero), of an order, from a slice or for a range of hashes.
PARCEL = "dest long, kind int, n int, source long, body binary"
OUT = "kind string, n int, bucket long, doc long, doc_id long, n_tokens long, n_known long, train_tokens long, base double, score double, body binary"
SPACES = re.compile(rb"[\x20\x09-\x0D]").search


def token_hashes(text: str | None, most_bytes: int = 6_000_000) -> Iterator[np.ndarray]:
    """The text's tokens as hashes, the end included, in pieces of bounded size."""
    data = (text or "").encode().lower()
    start = 0
    while True:
        cut = SPACES(data, start + most_bytes) if len(data) > start + most_bytes else None
        own = data[start : cut.end() if cut else len(data)].split()
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
        if not cut:
            yield np.append(h, END)
            return
        yield h
        start = cut.end()


def longer(context: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of their contexts and last words."""
    x = (context ^ (context >> S29)) * MIX + w
    x = (x ^ (x >> S32)) * MIX
    return x ^ (x >> S29)


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["dest", "kind", "n", "source", "body"])


def _table(rows: list[tuple]) -> pa.Table:
    schema = pa.schema([("dest", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()), ("source", pa.int64()), ("body", pa.binary())])
    return pa.Table.from_batches(_batches(rows), schema) if rows else schema.empty_table()


def _rows(group: pa.Table) -> list[tuple]:
    """(kind, n, source, body), by source, so that what is made of them is the same at every try."""
    return sorted(zip(*[group[c].to_pylist() for c in ("kind", "n", "source", "body")], strict=True), key=lambda r: r[:3])


def sliced(documents: DataFrame, order: int, most_tokens: int) -> DataFrame:
    """Slices: what tokens there are, in what order, by which documents. ``documents`` has doc_id, learn, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        held, size, made, row = [], 0, 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            x = np.concatenate([h[3] for h in held])
            vocabulary, stream, often = np.unique(x, return_inverse=True, return_counts=True)
            by_count = np.argsort(-often, kind="stable")
            place = np.empty(len(by_count), np.int64)
            place[by_count] = np.arange(len(by_count))
            known = np.array([h[1] is not None for h in held], np.int64)
            ids = np.array([h[1] or 0 for h in held], np.int64).view(np.uint64).astype(np.uint64)
            docs = np.array([h[0] for h in held], np.int64)
            learn, lens = np.array([h[2] for h in held], np.int64), np.array([len(h[3]) for h in held], np.int64)
            # Vocabulary and ids as floats' bytes: they are not ascending.
            body = pack(vocabulary[by_count].view(np.float64), place[stream], lens, learn, docs, known, ids.view(np.float64))
            yield from _batches([(first + made, 0, 0, first + made, body)])

        for batch in slices(batches, "text"):
            for doc_id, learn, text in zip(*[batch[c].to_pylist() for c in ("doc_id", "learn", "text")], strict=True):
                lead = np.array([NONE] * (order - 2) + [START] * (order > 1), np.uint64)
                for own in token_hashes(text):
                    x = np.concatenate([lead, own])
                    lead = x[len(x) - order + 1 :] if order > 1 else lead
                    held.append((first + row, doc_id, bool(learn), x))
                    size += len(x)
                    if size >= most_tokens:
                        yield from flush()
                        held, size, made = [], 0, made + 1
                row += 1
        if held:
            yield from flush()

    return documents.select("doc_id", "learn", "text").mapInArrow(run, PARCEL)


class _Slice:
    """A slice's tokens and its distinct n-grams of each order."""

    def __init__(self, body: bytes, order: int):
        vocabulary, stream, lens, learn, docs, known, ids = unpack(body)
        lens, stream = lens.astype(np.int64), stream.astype(np.int64)
        self.doc, self.doc_of = docs.astype(np.int64), np.repeat(np.arange(len(lens)), lens)
        self.doc_id = [int(i) if k else None for i, k in zip(ids.view(np.int64), known, strict=True)]
        self.x = vocabulary.view(np.uint64)[stream]
        ends = np.cumsum(lens)
        self.own = np.ones(len(self.x), bool)
        for j in range(order - 1):
            self.own[(ends - lens)[lens > j] + j] = False
        self.learn = self.own & (learn.astype(bool)[self.doc_of])
        words, back = np.unique(vocabulary.view(np.uint64), return_inverse=True)
        self.grams, self.at, gram = [words], [back[stream]], self.x
        for n in range(2, order + 1):
            gram = np.append(np.zeros(1, np.uint64), longer(gram[:-1], self.x[1:]))
            own, at = np.unique(gram[n - 1 :], return_inverse=True)
            self.grams.append(own)
            self.at.append(np.concatenate([np.zeros(n - 1, np.int64), at]))

    def learned(self, n: int) -> np.ndarray:
        """How often each n-gram is to be learned here."""
        proper = self.learn.copy()
        proper[: n - 1] = False
        proper[n - 1 :] &= self.x[: len(self.x) - n + 1] != NONE
        return np.bincount(self.at[n - 1][proper], minlength=len(self.grams[n - 1]))


def asked(parts: DataFrame, order: int, buckets: list[int]) -> DataFrame:
    """The slices' n-grams, for the buckets that count them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, body in zip(batch["source"].to_pylist(), batch["body"].to_pylist(), strict=True):
                own, rows = _Slice(body, order), []
                for n in range(1, order + 1):
                    keys, times = own.grams[n - 1], own.learned(n)
                    cut = [*np.searchsorted(keys, edges(buckets[n - 1])).tolist(), len(keys)]
                    rows += [(-(n << 32 | b) - 1, 0, n, source, pack(keys[i:j], times[i:j])) for b, (i, j) in enumerate(zip(cut, cut[1:], strict=False)) if j > i]
                yield from _batches(rows)

    return parts.mapInArrow(run, PARCEL)


class _Bucket:
    """A range of n-grams, counted over all slices."""

    def __init__(self, group: pa.Table):
        self.rows = _rows(group)
        self.dest, self.n = group["dest"][0].as_py(), self.rows[0][1]
        made = [unpack(body) for *_, body in self.rows]
        self.size = [len(k) for k, _ in made]
        self.keys, self.first, self.at = np.unique(np.concatenate([k for k, _ in made]), return_index=True, return_inverse=True)
        self.count = np.rint(np.bincount(self.at, np.concatenate([t.astype(float) for _, t in made]))).astype(np.int64)

    def totals(self) -> list[int]:
        c = self.count
        return [int(c.sum()), int((c > 0).sum()), int(c[self.keys == END].sum()), *[int((c == r).sum()) for r in range(1, K + 2)]]

    def answers(self) -> list[tuple]:
        """To each slice its counts, in the order asked, doubled, and one more where it owns the n-gram."""
        answer = 2 * self.count[self.at]
        answer[self.first] += 1
        ends = np.cumsum(self.size)
        return [(source, 1, n, -self.dest, pack(answer[b - size : b])) for (_, n, source, _), b, size in zip(self.rows, ends, self.size, strict=True)]


def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """d(r) for r = 0 to K, and beyond as the last: Katz's form of Good-Turing, at most CEILING."""
    n = [0, *map(int, counts_of_counts)]
    d = np.full(K + 2, CEILING)
    d[0] = 0
    tail = (K + 1) * n[K + 1] / n[1] if n[1] else 1
    for r in range(1, K + 1):
        if n[r] and n[r + 1] and tail < 1:
            made = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail)
            if 0 < made <= 1:
                d[r] = min(made, CEILING)
    return d


def word_probability(count: np.ndarray, total: int, d: np.ndarray, counts_of_counts: list[int]) -> np.ndarray:
    """P(w) by the word's count; unknown words share what the discounts leave, as one class."""
    known = CEILING * (total - sum(r * n for r, n in enumerate(counts_of_counts[:K], 1))) + sum(d[r] * r * n for r, n in enumerate(counts_of_counts[:K], 1))
    unknown = 1 - known / total
    return np.where(count > 0, d[np.minimum(count, K + 1)] * count / total, unknown)


def _evaluate(source: int, own: _Slice, answers: list[tuple], totals: dict[tuple[int, str], int], order: int, ranges: int) -> list[tuple]:
    """Follows each token down the orders; gives sums and asks for weights by context, and keeps the rest for later."""
    counts, owned = [], []
    for n in range(1, order + 1):
        got = np.concatenate([unpack(body)[0].astype(np.int64) for _, m, _, body in sorted((a for a in answers if a[1] == n), key=lambda a: a[2])])
        counts.append(got >> 1)
        owned.append(got & 1 == 1)
    total, words, texts = (totals[1, c] for c in ("tokens", "types", "texts"))
    counts[0][own.grams[0] == START] = texts
    r = {n: [totals[n, f"r{i}"] for i in range(1, K + 2)] for n in range(1, order + 1)}
    d = {n: discounts(r[n]) for n in r}
    kept = lambda n, c: d[n][np.minimum(c, K + 1)] * c
    p1 = word_probability(counts[0], total, d[1], r[1]) if total else np.ones(len(counts[0]))

    at = np.flatnonzero(own.own)
    doc, c1 = own.doc_of[at], counts[0][own.at[0][at]]
    score, level = np.log10(p1[own.at[0][at]]), np.ones(len(at), np.int64)
    rows, met = [], []
    for n in range(2, order + 1):
        gram, context = own.at[n - 1], np.append(0, own.at[n - 2][:-1])  # of each position
        c, before = counts[n - 1][gram[at]], counts[n - 2][context[at]]
        seen = c > 0
        score[seen], level[seen] = np.log10(kept(n, c[seen]) / before[seen]), n

        where = np.full(len(own.grams[n - 1]), -1)
        where[gram[n - 1 :]] = np.arange(n - 1, len(own.x))
        p = where[owned[n - 1] & (counts[n - 1] > 0)]
        lower = p1[own.at[0][p]] if n == 2 else kept(n - 1, counts[n - 2][own.at[n - 2][p]]) / counts[n - 3][own.at[n - 3][p - 1]]
        size = len(own.grams[n - 2])
        parts = [np.bincount(context[p], v, minlength=size) for v in (kept(n, counts[n - 1][gram[p]]), lower)]
        rows += _by_range(n, 2, source, np.unique(context[p]), own.grams[n - 2], ranges, *parts, counts[n - 2])
    for n in range(2, order + 1):
        context = np.append(0, own.at[n - 2][:-1])[at]
        back = (level < n) & (counts[n - 2][context] > 0)
        wanted, which = np.unique(context[back], return_inverse=True)
        rows += _by_range(n, 3, source, wanted, own.grams[n - 2], ranges)
        pairs, times = np.unique(which.astype(np.int64) * len(own.doc) + doc[back], return_counts=True)
        met += [pairs // len(own.doc), pairs % len(own.doc), times]
    base = np.log10((c1 + 0.5) / (total + 0.5 * (words + 1)))
    sums = [np.bincount(doc, v, minlength=len(own.doc)) for v in (np.ones(len(at)), c1 > 0, base, score)]
    known = np.array([i is not None for i in own.doc_id], np.int64)
    ids = np.array([i or 0 for i in own.doc_id], np.int64)
    rows.append((source, 4, 0, total, pack(own.doc, known, ids.view(np.float64), sums[0].astype(np.int64), sums[1].astype(np.int64), sums[2], sums[3], *met)))
    return rows


def _by_range(n: int, kind: int, source: int, index: np.ndarray, keys: np.ndarray, ranges: int, *values: np.ndarray) -> list[tuple]:
    keys = keys[index]
    cut = [*np.searchsorted(keys, edges(ranges)).tolist(), len(keys)]
    return [(-(n << 32 | b) - 1, kind, n, source, pack(keys[i:j], *[v[index[i:j]] for v in values])) for b, (i, j) in enumerate(zip(cut, cut[1:], strict=False)) if j > i]


def _weigh(group: pa.Table) -> pa.Table:
    """A range of contexts: adds up their sums, answers with their weights, gives the weights as a table's row."""
    dest, rows = group["dest"][0].as_py(), _rows(group)
    if dest >= 0:
        return group.select(["dest", "kind", "n", "source", "body"])
    parts = [unpack(body) for kind, _, _, body in rows if kind == 2]
    if not parts:  # cannot be: a context that was learned has its sums
        raise ValueError("weights of contexts that were not learned")
    keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    top, low = (np.bincount(at, np.concatenate([p[i] for p in parts])) for i in (1, 2))
    count = np.zeros(len(keys))
    count[at] = np.concatenate([p[3] for p in parts])
    weight = np.log10((1 - top / count) / (1 - low))
    made = [(source, 5, n, -dest, pack(weight[np.searchsorted(keys, unpack(body)[0])])) for kind, n, source, body in rows if kind == 3]
    return _table([*made, (dest, 6, rows[0][1], -dest, pack(keys, weight))])


def _finish(group: pa.Table) -> pa.Table:
    """A slice's scores, its weights added; or a row of the weights' table."""
    columns = {f.split()[0]: [] for f in OUT.split(", ")}
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}

    def put(size: int, **values: object) -> None:
        for name, held in columns.items():
            v = values.get(name)
            held.extend(v if isinstance(v, list) else [v] * size)

    rows = _rows(group)
    for kind, n, source, body in rows:
        if kind == 6:
            put(1, kind="weights", n=n, bucket=source, body=body)
        elif kind == 4:
            doc, known, ids, n_tokens, n_known, base, score, *met = unpack(body)
            score = score.copy()
            for i in range(len(met) // 3):
                context, where, times = (m.astype(np.int64) for m in met[3 * i : 3 * i + 3])
                if len(context):
                    weight = np.concatenate([unpack(b)[0] for _, _, b in sorted((s, k, b) for k, m, s, b in rows if k == 5 and m == i + 2)])
                    score += np.bincount(where, weight[context] * times, minlength=len(score))
            ids = [i if k else None for i, k in zip(ids.view(np.int64).tolist(), known.tolist(), strict=True)]
            put(len(doc), kind="scores", n=0, doc=doc.tolist(), doc_id=ids, n_tokens=n_tokens.tolist(), n_known=n_known.tolist(), train_tokens=source, base=base.tolist(), score=score.tolist())
    return pa.table({name: pa.array(held, types[f.split()[1]]) for (name, held), f in zip(columns.items(), OUT.split(", "), strict=True)})


def learned(doc_id: Column) -> Column:
    return F.coalesce(crc_mod(doc_id, 5) != 1, F.lit(False))


def build(documents: DataFrame, path: str, order: int, per_bucket: int, most_tokens: int) -> None:
    """Writes the tables ``ngrams``, ``weights`` and ``scores`` under ``path``, one folder a kind and order."""
    rows = documents.select("doc_id", learned(F.col("doc_id")).alias("learn"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = [max(1, size // (6 * per_bucket * 4) + 1), *[max(2, size // (6 * per_bucket) + 1)] * (order - 1)]
    ranges = buckets[0] if order == 2 else buckets[-1]
    parts = sliced(rows, order, most_tokens).repartition("dest")
    dealt = asked(parts, order, buckets).repartition("dest")
    names = ["tokens", "types", "texts", *[f"r{i}" for i in range(1, K + 2)]]
    fields = [f"{c}_{n}" for n in range(1, order + 1) for c in names]

    def count(group: pa.Table) -> pa.Table:
        b = _Bucket(group)
        own = {f"{c}_{b.n}": v for c, v in zip(names, b.totals(), strict=True)}
        return pa.table({f: pa.array([own.get(f, 0)], pa.int64()) for f in fields})

    def answer(group: pa.Table) -> pa.Table:
        return _table(_Bucket(group).answers())

    def store(group: pa.Table) -> pa.Table:
        b = _Bucket(group)
        seen = b.count > 0
        row = {"kind": "ngrams", "n": b.n, "bucket": -b.dest, "body": pack(b.keys[seen], b.count[seen])}
        types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
        return pa.table({f.split()[0]: pa.array([row.get(f.split()[0])], types[f.split()[1]]) for f in OUT.split(", ")})

    def evaluate(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table([])
        totals = {(int(f.rpartition("_")[2]), f.rpartition("_")[0]): left[f][0].as_py() or 0 for f in fields}
        source = left["source"][0].as_py()
        return _table(_evaluate(source, _Slice(left["body"][0].as_py(), order), _rows(right), totals, order, ranges))

    totals = dealt.groupBy("dest").applyInArrow(count, ", ".join(f"{f} long" for f in fields)).agg(*[F.sum(f).alias(f) for f in fields])
    answers = dealt.groupBy("dest").applyInArrow(answer, PARCEL)
    whole = parts.crossJoin(F.broadcast(totals))
    sums = whole.groupBy("dest").cogroup(answers.groupBy("dest")).applyInArrow(evaluate, PARCEL)
    weights = sums.groupBy("dest").applyInArrow(_weigh, PARCEL)
    made = weights.groupBy("dest").applyInArrow(_finish, OUT)
    stored = dealt.groupBy("dest").applyInArrow(store, OUT)
    made.unionByName(stored).write.partitionBy("kind", "n").parquet(path)


def score(documents: DataFrame, order: int = 2, path: str | None = None, per_bucket: int = 3_000_000, most_tokens: int = 2_500_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    The model's tables stay under ``path`` where it is given, and else go when the scores are made.
    """
    spark = documents.sparkSession
    folder = path or f"{ensure_checkpoint_dir(spark)}/katz-{uuid.uuid4().hex}"
    build(documents, folder, order, per_bucket, most_tokens)
    per = spark.read.schema(OUT).parquet(folder).where("kind = 'scores'").groupBy("doc", "doc_id").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")], F.max("train_tokens").alias("train_tokens"))
    df = per.select(
        "doc_id",
        F.coalesce(crc_mod(F.col("doc_id"), 5) == 1, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        F.col("base").alias("base_score"),
        F.when(F.col("train_tokens") > 0, F.col("score")).alias("score"),
    )
    if path is None:
        df = materialize(df)
        remove(spark, folder)
    return df
