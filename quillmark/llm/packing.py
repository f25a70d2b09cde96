"""Packing by cutting-stock column generation.

A document's ids are cut into full sequences, then, of what is left, a body whose length is a
multiple of ``grain`` and a tail below it. All pieces have one of about ``capacity / grain + grain``
lengths, so the problem is a cutting-stock problem over an exact, small histogram. A linear program
over patterns (how many pieces of each length fill a sequence) is solved by column generation: a
knapsack by dynamic programming over the dual prices finds the next pattern. Rounded down, patterns
become runs of sequences; what rounding leaves over, a few sequences however many documents there
are, is filled by first fit decreasing; those sequences end where their pieces end. A
document's piece takes the slot of its rank among pieces of its length: sequence and offset follow
by arithmetic from a table as small as the patterns, so no piece is shuffled to meet its sequence.

Only the histogram reaches the driver. Ranks come from counts per (share of the pieces, length).

Defined cases: a null text counts as empty, which is the end id alone. Long texts are encoded whole
and cut. Repeated rows are packed as often as they occur, and rows that tie in everything take any of
their ranks. A special token's string in a text is that token, as the library reads it. An empty table gives an empty result. Extra columns are dropped.
"""

from __future__ import annotations

import itertools
import re
import threading
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.bytebpe import WHITE, slices
from quillmark.llm.common import materialize, release

CAPACITY, GRAIN, END_ID = 4096, 64, 2
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
REMEMBERED = 600_000
#: A worker without a task for so long lets its tokenizer go.
IDLE_SECONDS = 3.0
#: The vocabulary's pattern, on lower-case text, and as it is for ASCII.
CUT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + WHITE + r"\p{L}\p{N}]+").findall
ASCII_CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0d\x20a-z0-9]+").findall


def pieces_of(word: str) -> list[str] | tuple[str]:
    """The pieces in which ids are merged; a word that normalising or lower-casing may change in other ways, whole in a tuple."""
    if word.isascii():
        return ASCII_CUT(word.lower())
    if unicodedata.is_normalized("NFC", word) and "\u0130" not in word and "\u03a3" not in word:
        lower = word.lower()
        return [lower] if lower.isalpha() else CUT(lower)
    return (word,)


class WordTokenizer:
    """Ids of whole texts as the library gives them, word by word: this vocabulary drops white space and merges within pieces of words.

    Each batch's distinct words are looked up once. A word not met before is cut into pieces by the
    vocabulary's own pattern, and the pieces not met before are encoded together. Texts that hold one of
    the vocabulary's special tokens go through the library whole, since those may stand inside words.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))).search if special else lambda _: None
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}  # of a word
        self.pieces: dict[str, bytes] = {}
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0
        self.start, self.size = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int64)

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> int:
        """Remembers words that are not known yet; they are numbered on from what is returned."""
        cut = list(map(pieces_of, words))
        new = list(set(itertools.chain.from_iterable(cut)) - self.pieces.keys())
        whole = {cut[i][0] for i, w in enumerate(words) if type(cut[i]) is tuple}
        plain, rest = [p for p in new if p not in whole], [p for p in new if p in whole]
        if plain:
            ids = self._library([" ".join(plain)])[0]
            at = [0, *(4 * np.flatnonzero(self.ends[np.frombuffer(ids, "<u4")]) + 4).tolist()]
            if len(at) == len(plain) + 1:
                self.pieces.update(zip(plain, [ids[a:b] for a, b in itertools.pairwise(at)], strict=True))
            else:  # cannot be while each piece is one of the pattern's
                rest += plain
        self.pieces.update(zip(rest, self._library(rest), strict=True))
        piece = self.pieces
        made = [piece[ps[0]] if len(ps) == 1 else b"".join([piece[p] for p in ps]) for ps in cut]
        sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
        first, total = len(self.number), int(sizes.sum())
        while first + len(made) > len(self.start):
            self.start, self.size = (np.append(a, np.zeros_like(a)) for a in (self.start, self.size))
        while self.used + total > len(self.flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        self.size[first : first + len(made)] = sizes
        self.start[first : first + len(made)] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used : self.used + total] = np.frombuffer(b"".join(made), "<u4")
        self.used += total
        self.number.update(zip(words, range(first, first + len(made)), strict=True))
        return first

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Each text's ids as little-endian 32-bit integers; none for null."""
        words = pa.compute.ascii_split_whitespace(texts.fill_null(""))
        flat = words.flatten().dictionary_encode()
        distinct = flat.dictionary.to_pylist()
        if len(self.number) + len(distinct) > self.remembered:
            self._forget()
        found = list(map(self.number.get, distinct))
        if None in found:
            fresh = [i for i, n in enumerate(found) if n is None]
            first = self._learn([distinct[i] for i in fresh])
            for n, i in enumerate(fresh, first):
                found[i] = n
        number = np.array(found, np.int32)[flat.indices.to_numpy()]
        size = self.size[number]
        ends = np.cumsum(size)
        n = int(ends[-1]) if len(ends) else 0
        index = np.int32 if max(n, self.used) < 1 << 31 else np.int64
        place = np.repeat((self.start[number] - ends + size).astype(index), size)
        place += np.arange(n, dtype=index)
        ids = self.flat[place].astype("<u4", copy=False).tobytes()
        at = 4 * np.append(0, ends)[words.offsets.to_numpy() - words.offsets[0].as_py()]
        made = [ids[a:b] for a, b in itertools.pairwise(at.tolist())]
        if any(map(self.special, distinct)):
            for i, text in enumerate(texts.to_pylist()):
                if text and self.special(text):
                    made[i] = self._library([text])[0]
        return made


_made: dict[str, WordTokenizer] = {}
_unused: dict[str, threading.Timer] = {}


def tokenizer_of(path: str) -> WordTokenizer:
    """This worker's tokenizer, which knows the words of the worker's tasks before."""
    if path in _unused:
        _unused.pop(path).cancel()
    return _made.setdefault(path, WordTokenizer(path)) if path not in _made else _made[path]


def leave(path: str, seconds: float = IDLE_SECONDS) -> None:
    """Lets the worker's tokenizer go unless a task asks for it soon, since Spark keeps idle workers for a minute beside other stages."""

    def drop() -> None:
        _made.pop(path, None)
        release()

    _unused[path] = threading.Timer(seconds, drop)
    _unused[path].daemon = True
    _unused[path].start()


def cuts(length: int, capacity: int = CAPACITY, grain: int = GRAIN) -> list[int]:
    """Lengths of the pieces of a document: full sequences, a body, a tail."""
    left = length % capacity
    return [capacity] * (length // capacity) + [x for x in (left - left % grain, left % grain) if x]


def pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """One row per piece of each document, in PIECES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        import pyarrow.compute  # noqa: F401

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        tokenizer = tokenizer_of(path)
        end = np.array([END_ID], "<u4").tobytes()
        try:
            for batch in slices(batches, "text", 3_000_000):
                rows = []
                for doc_id, ids in zip(batch["doc_id"].to_pylist(), tokenizer.encode(batch["text"]), strict=True):
                    ids += end
                    n, start = len(ids) // 4, 0
                    for length in cuts(n, capacity, grain):
                        rows.append((doc_id, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n))
                        start += length
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
                release()
        finally:
            leave(path)

    return documents.select("doc_id", "text").mapInArrow(run, PIECES)


def best_pattern(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The unbounded knapsack: how many of each length fill a sequence at the greatest price."""
    value, steps = np.zeros(capacity + 1), []
    for j in np.argsort(-prices / lengths, kind="stable"):
        copies = 1
        while (n := copies * int(lengths[j])) <= capacity and prices[j] > 0:
            options = value[:-n] + copies * prices[j]
            better = options > value[n:] + 1e-12
            if better.any():
                value[n:][better] = options[better]
                steps.append((j, copies, n, better))
            copies *= 2
    pattern, c = np.zeros(len(lengths), np.int64), int(value.argmax())
    for j, copies, n, better in reversed(steps):
        if c >= n and better[c - n]:
            pattern[j] += copies
            c -= n
    return pattern


def inverted(a: np.ndarray) -> np.ndarray:
    """The inverse by elimination with row pivots, in plain array arithmetic.

    The linear-algebra library's threads may wait for ever in a process that has forked, as a driver has.
    """
    m = len(a)
    both = np.hstack([a.astype(float), np.eye(m)])
    for j in range(m):
        pivot = j + int(np.abs(both[j:, j]).argmax())
        both[[j, pivot]] = both[[pivot, j]]
        both[j] /= both[j, j]
        factor = both[:, j].copy()
        factor[j] = 0
        both -= factor[:, None] * both[j]
    return both[:, m:]


def solve(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-3, rounds: int = 800) -> tuple[np.ndarray, np.ndarray]:
    """Column generation by the revised simplex: patterns as columns, and how often each is used.

    Stops within ``gap`` of the bounds that no solution can beat (the value over the best price, and
    the sum of lengths over the capacity), or after ``rounds`` columns; either way the solution meets the demand.
    """
    m = len(lengths)
    basis = np.diag((capacity // lengths).astype(float))
    inverse, x = np.diag(1 / np.diag(basis)), demand / np.diag(basis)
    least = float((lengths * demand).sum()) / capacity
    for i in range(rounds):
        prices = inverse.sum(axis=0)
        pattern = best_pattern(np.maximum(prices, 0.0), lengths, capacity)
        worth = float((prices * pattern).sum())
        if worth <= 1 + gap or x.sum() <= (1 + gap) * least:
            break
        step = (inverse * pattern).sum(axis=1)
        ratios = np.where(step > 1e-9, np.maximum(x, 0) / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(ratios.argmin())
        if not np.isfinite(ratios[leave]):
            break
        x = x - ratios[leave] * step
        x[leave] = ratios[leave]
        basis[:, leave] = pattern
        inverse[leave] /= step[leave]
        others = np.arange(m) != leave
        inverse[others] -= np.outer(step[others], inverse[leave])
        if i % 100 == 99:
            inverse = inverted(basis)
            x = (inverse * demand).sum(axis=1)
    return np.rint(basis).astype(np.int64), np.maximum(x, 0)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Runs of equal sequences: ([(length, pieces of it)], number of sequences). Every piece has a slot."""
    runs = []
    left = dict(histogram)
    if full := left.pop(capacity, 0):
        runs.append(([(capacity, 1)], full))
    lengths = np.array(sorted(left, reverse=True), np.int64)
    if len(lengths):
        demand = np.array([left[int(n)] for n in lengths], float)
        columns, times = solve(lengths, demand, capacity)
        for j in np.argsort(-times, kind="stable"):
            used = [(int(n), int(k)) for n, k in zip(lengths, columns[:, j], strict=True) if k]
            whole = min([int(times[j] + 1e-9), *[left[n] // k for n, k in used]])
            if whole:
                runs.append((used, whole))
                for n, k in used:
                    left[n] -= k * whole
    while any(left.values()):  # first fit decreasing, a sequence at a time
        room, used = capacity, []
        for n in map(int, lengths):
            if k := min(left[n], room // n):
                used.append((n, k))
                left[n] -= k
                room -= n * k
        again = min(left[n] // k for n, k in used)
        for n, k in used:
            left[n] -= k * again
        runs.append((used, 1 + again))
    return runs


def slots(runs: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, pieces of that length in a sequence, first sequence, offset of the first of them)."""
    rows, ranks, sequence = [], {}, 0
    for used, times in runs:
        offset = 0
        for n, k in used:
            first = ranks.get(n, 0)
            ranks[n] = first + k * times
            rows.append((n, first, ranks[n], k, sequence, offset))
            offset += n * k
        sequence += times
    return rows


def ranked(made: DataFrame, shares: int) -> DataFrame:
    """Adds rank: 0, 1, ... among the pieces of a length. No task sorts more than its share of them."""
    made = made.withColumn("_share", F.pmod(F.xxhash64("doc_id", "start"), F.lit(shares)))
    counts = made.groupBy("_share", "length").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_share")) - F.col("_n")).drop("_n")
    local = F.row_number().over(Window.partitionBy("_share", "length").orderBy("doc_id", "start", "ids_crc32", "doc_tokens"))
    return made.withColumn("_local", local).join(before, ["_share", "length"]).withColumn("rank", F.col("_before") + F.col("_local") - 1).drop("_share", "_local", "_before")


def place(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Gives each piece its sequence_id and offset. ``made`` is read three times; give it materialised."""
    spark = made.sparkSession
    histogram = {int(r["length"]): int(r["n"]) for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(plan(histogram, capacity))
    at = spark.createDataFrame(table, "length long, first long, end long, per long, sequence long, base long")
    shares = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = ranked(made, shares).join(F.broadcast(at), "length").where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    inside = F.col("rank") - F.col("first")
    return df.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("sequence") + F.floor(inside / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("base") + (inside % F.col("per")) * F.col("length")).cast("long").alias("offset"),
    )


def pack(documents: DataFrame, path: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return place(materialize(pieces(documents, path)))
