"""Postings: where each gram stands, in blocks of chunks, so that terms are found, counted and ranked without text.

Chunks are numbered in blocks of 64. A posting is a gram and a block: how many of the block's
chunks hold the gram, the most occurrences in any one of them for each field (the block's bound), and a list of
keys. Grams of three characters, under the fold of long terms, list the position of each occurrence; grams of one
and two, under the fold of short terms, list a count for each chunk and field, without overlaps.

Stored are rows of a gram and 16 blocks: the cells (chunk and field) that hold the gram, how often each does, and the
positions there, each as differences in as few bytes as they need. Bounds and short terms need no positions. A field that is the same
in neighbouring chunks, as the title is in all chunks of a document, is listed once, with how many chunks after its own repeat it. A task writes the
rows of the chunks that it read, so no list is shuffled.

A long term needs only grams that cover it, and of those the rarest: the cover is the one whose lists hold least. The
positions of its grams, each less its own place in the term, intersect in exactly the term's
occurrences, so no text is read to verify. A short term is one gram. Terms of many queries share one pass.

The first results of a query need not look at each block. A bound of each layer of the order is known for
a block from its rows without their lists; blocks are taken by falling bound, and once the k-th result is above a block's
bound, nothing in it can count.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.functions.folding import MATCH_MIN_LENGTH, fold_pairs
from quillmark.functions.workers import ship
from quillmark.operators.search import FIELDS, bonus_of
from quillmark.plans.query import Term, parse

BLOCK_BITS, FIELD_BITS, COUNT_BITS, SEGMENT_BITS, UNIT_BITS, BUCKETS = 6, 2, 34, 46, 4, 16
PLACE_BITS = BLOCK_BITS + FIELD_BITS
COUNT_MASK = (1 << COUNT_BITS) - 1
#: As stored: ``unit`` is a run of blocks; ``n`` chunks and ``n_blocks`` blocks of it hold the gram.
SCHEMA = "gram string, unit long, n int, n_blocks int, cells binary, sizes binary, runs binary, positions binary"
#: Plans of terms up to so many rows are broadcast, beyond that joined by a shuffle.
MOST_BROADCAST = 1_000_000


# ---- building --------------------------------------------------------------------------------


def placed(chunks: DataFrame, segment: int = 0) -> DataFrame:
    """Chunks by source and id, with the block and the place in it of each."""
    sorted_ = chunks.repartitionByRange("source_id", "chunk_id").sortWithinPartitions("source_id", "chunk_id")
    numbered = sorted_.withColumn("_at", F.monotonically_increasing_id())
    return numbered.withColumn("block", F.lit(segment << SEGMENT_BITS) + F.shiftright("_at", BLOCK_BITS)).withColumn("place", F.col("_at").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int")).drop("_at")


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Both folds by code point."""
    ascii_, unicode = np.arange(0x110000, dtype=np.int64), np.arange(0x110000, dtype=np.int64)
    ascii_[65:91] += 32
    source, target = fold_pairs()
    unicode[[ord(c) for c in source]] = [ord(c) for c in target]
    return ascii_, unicode


def _grams_of(codes: np.ndarray, n: int) -> list[str]:
    """The strings of packed grams of n characters."""
    points = np.stack([(codes >> (21 * (n - 1 - i))) & 0x1FFFFF for i in range(n)], axis=1).astype("<u4")
    text = points.tobytes().decode("utf-32-le")
    return [text[i : i + n] for i in range(0, len(text), n)]


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where any of the columns differs from the row before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def _packed(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Numbers from 0 up, seven bits a byte, the low ones first; a binary for each run that begins at ``starts``."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for k in range(7, 64, 7):
        if not (more := values >> np.uint64(k) > 0).any():
            break
        sizes += more
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(sizes.max(initial=0))):
        has = np.flatnonzero(sizes > k)
        out[ends[has] - sizes[has] + k] = (values[has] >> np.uint64(7 * k) & np.uint64(127)) | np.where(sizes[has] > k + 1, 128, 0).astype(np.uint64)
    offsets = np.concatenate([[0], ends])[[*starts, len(values)]].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all runs, and how many each run has."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    body = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(column) else np.zeros(0, np.uint8)
    ends = np.flatnonzero(body < 128)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    shifts = 7 * (np.arange(len(body)) - np.repeat(starts, ends - starts + 1))
    values = np.add.reduceat((body & 127).astype(np.int64) << shifts, starts) if len(ends) else np.zeros(0, np.int64)
    return values, np.diff(np.searchsorted(ends, offsets - offsets[0]))


def _differences(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    out = np.diff(values, prepend=0)
    out[starts] = values[starts]
    return out


def _sums(differences: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What ``_differences`` had, from runs of ``sizes``."""
    total = np.cumsum(differences)
    before = np.concatenate([[0], total])[np.cumsum(sizes) - sizes]
    return total - np.repeat(before, sizes)


def _spread(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each number, 0 to itself: whose it is, and the step."""
    owner = np.repeat(np.arange(len(runs)), runs + 1)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(runs + 1) - runs - 1, runs + 1)


def _rows(codes: np.ndarray, blocks: np.ndarray, places: np.ndarray, values: np.ndarray, runs: np.ndarray, n: int, counted: bool) -> Iterator[pa.RecordBatch]:
    """Posting rows of one length of grams, from occurrences in order of block and place (place and field packed)."""
    if not len(codes):
        return
    order = np.argsort(codes, kind="stable")
    codes, blocks, places, values, runs = codes[order], blocks[order], places[order], values[order], runs[order]
    units, at = blocks >> UNIT_BITS, (blocks & ((1 << UNIT_BITS) - 1)) << PLACE_BITS | places
    cells = _starts(codes, units, at)
    sizes = np.diff([*cells, len(codes)])
    codes, units, at, runs = codes[cells], units[cells], at[cells], runs[cells]
    rows = _starts(codes, units)
    per_row = np.diff([*rows, len(cells)])
    row = np.repeat(np.arange(len(rows)), per_row)
    owner, step = _spread(runs)
    held = np.sort(row[owner] << UNIT_BITS + PLACE_BITS | at[owner] + (step << FIELD_BITS))
    some = np.maximum.reduceat(runs, rows) > 0  # the runs of other rows are not stored
    kept = np.concatenate([[0], np.cumsum(np.where(some, per_row, 0))[:-1]])

    def different(bits: int) -> pa.Array:
        first = held[_starts(held >> bits)]
        return pa.array(np.bincount(first >> UNIT_BITS + PLACE_BITS, minlength=len(rows)).astype(np.int32))

    positions = _packed(values[:0], np.zeros(len(rows), np.int64)) if counted else _packed(_differences(values, cells), cells[rows])
    yield pa.RecordBatch.from_arrays(
        [pa.array(_grams_of(codes[rows], n)), pa.array(units[rows]), different(FIELD_BITS), different(PLACE_BITS), _packed(_differences(at, rows), rows), _packed(sizes - 1, rows), _packed(runs[some[row]], kept), positions],
        names=[c.split()[0] for c in SCHEMA.split(", ")],
    )


def _blocks_of(batch: pa.RecordBatch, keys: bool) -> pa.RecordBatch:
    """Stored rows by gram and block: their bounds, or else their keys."""
    gaps, per_row = _unpacked(batch["cells"])
    sizes = _unpacked(batch["sizes"])[0] + 1
    row, at = np.repeat(np.arange(len(batch)), per_row), _sums(gaps, per_row)
    own, n_runs = _unpacked(batch["runs"])
    runs = np.zeros(len(row), np.int64)
    runs[np.repeat(n_runs > 0, per_row)] = own
    cell, step = _spread(runs)
    sorted_ = np.argsort(row[cell] << UNIT_BITS + PLACE_BITS | at[cell] + (step << FIELD_BITS), kind="stable")
    cell, step, stored = cell[sorted_], step[sorted_], (row, sizes)
    row, at, sizes = row[cell], at[cell] + (step << FIELD_BITS), sizes[cell]
    blocks = batch["unit"].to_numpy()[row] << UNIT_BITS | at >> PLACE_BITS
    starts = _starts(row, blocks) if len(row) else row
    named = [batch["gram"].take(pa.array(row[starts])), pa.array(blocks[starts])]
    if not keys:
        field = at & ((1 << FIELD_BITS) - 1)
        most = [np.maximum.reduceat(np.where(field == f, sizes, 0), starts) if len(starts) else starts for f in range(3)]
        return pa.RecordBatch.from_arrays([*named, *[pa.array(m.astype(np.int32)) for m in most]], names=["gram", "block", *[f"max_{f}" for f in FIELDS]])
    counted = np.array([len(g) < MATCH_MIN_LENGTH for g in batch["gram"].to_pylist()], bool)
    per_stored = np.where(counted[stored[0]], 1, stored[1])
    values = np.zeros(int(per_stored.sum()), np.int64)
    one = np.repeat(counted[stored[0]], per_stored)
    values[one] = stored[1][counted[stored[0]]]
    values[~one] = _sums(_unpacked(batch["positions"])[0], stored[1][~counted[stored[0]]])
    per_cell = per_stored[cell]
    begun = (np.cumsum(per_stored) - per_stored)[cell]
    values = values[np.arange(int(per_cell.sum())) + np.repeat(begun - np.cumsum(per_cell) + per_cell, per_cell)]
    found = np.repeat((at & ((1 << PLACE_BITS) - 1)) << COUNT_BITS, per_cell) | values
    offsets = np.concatenate([[0], np.cumsum(per_cell)])[[*starts, len(row)]].astype(np.int32)
    return pa.RecordBatch.from_arrays([*named, pa.ListArray.from_arrays(pa.array(offsets), pa.array(found))], names=["gram", "block", "keys"])


def _occurrences(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ascii_, unicode = _tables()
    order = np.lexsort([batch["place"].to_numpy(), batch["block"].to_numpy()])
    if np.any(np.diff(order) < 0):  # a task may read parts of a file in another order
        batch = batch.take(pa.array(order))
    at = batch["block"].to_numpy() << BLOCK_BITS | batch["place"].to_numpy()
    follows = np.append(False, (np.diff(at) == 1) & (np.diff(at >> UNIT_BITS + BLOCK_BITS) == 0))[: len(at)]
    texts, repeats = [batch[f].to_pylist() for f in FIELDS], []
    for k, field in enumerate(texts):
        again = np.array([a and t == before for t, before, a in zip(field, [None, *field], follows.tolist(), strict=False)], bool)
        firsts = np.flatnonzero(~again)
        runs = np.zeros(len(again), np.int64)
        runs[firsts] = np.diff([*firsts, len(again)]) - 1
        repeats.append(runs)
        texts[k] = [None if a else t for t, a in zip(field, again.tolist(), strict=True)]
    parts = [np.frombuffer((t or "").encode("utf-32-le"), "<u4") for row in zip(*texts, strict=True) for t in row]
    sizes = np.array([len(p) for p in parts], np.int64)
    points = np.concatenate(parts)
    owner = np.repeat(np.arange(len(parts)), sizes)
    at = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    blocks = np.repeat(batch["block"].to_numpy(), 3)[owner]
    places = (np.repeat(batch["place"].to_numpy().astype(np.int64) << FIELD_BITS, 3) + np.tile(np.arange(3), len(batch)))[owner]
    runs = np.stack(repeats, axis=1).reshape(-1)[owner]
    left = sizes[owner] - at  # characters from here to the field's end
    long, short = unicode[points], ascii_[points]
    i = np.flatnonzero(left >= 3)
    yield from _rows(long[i] << 42 | long[i + 1] << 21 | long[i + 2] if len(i) else long[:0], blocks[i], places[i], at[i], runs[i], 3, False)
    yield from _rows(short, blocks, places, at, runs, 1, True)
    i = np.flatnonzero(left >= 2)
    if len(i):
        twin = short[i] == short[i + 1]
        # In a run of one character every second pair overlaps the one before it.
        breaks = np.where(twin & np.concatenate([[False], twin[:-1] & (np.diff(i) == 1)]), -1, np.arange(len(i)))
        i = i[~twin | ((np.arange(len(i)) - np.maximum.accumulate(breaks)) % 2 == 0)]
        yield from _rows(short[i] << 21 | short[i + 1], blocks[i], places[i], at[i], runs[i], 2, True)


def build(placed_chunks: DataFrame, most_chars: int = 1_000_000) -> DataFrame:
    """The postings of placed chunks as stored. Blocks that a task's input or ``most_chars`` cut have two rows a gram, with the parts of their lists."""
    ship(placed_chunks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = sum(np.array([len(t or "") for t in batch[f].to_pylist()], np.int64) for f in FIELDS)
            parts = np.cumsum(sizes) // most_chars if batch.num_rows else np.zeros(0, np.int64)
            for a, b in zip(starts := _starts(parts).tolist() if len(parts) else [], [*starts[1:], batch.num_rows], strict=True):
                yield from _occurrences(batch.slice(a, b - a))

    return placed_chunks.select("block", "place", *FIELDS).mapInArrow(run, SCHEMA)


def by_block(stored: DataFrame, keys: bool, most_bytes: int = 1_000_000) -> DataFrame:
    """gram, block, and either max_text, max_title and max_author or keys, of stored rows."""
    ship(stored.sparkSession)
    columns = ["cells", "sizes", "runs", *["positions"] * keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = np.cumsum(sum(np.diff(np.frombuffer(batch[c].buffers()[1], np.int32, len(batch) + 1, 4 * batch[c].offset).astype(np.int64)) for c in columns)) // most_bytes if batch.num_rows else np.zeros(0, np.int64)
            for a, b in zip(starts := _starts(parts).tolist() if len(parts) else [], [*starts[1:], batch.num_rows], strict=True):
                yield _blocks_of(batch.slice(a, b - a), keys)

    return stored.select("gram", "unit", *columns).mapInArrow(run, "gram string, block long, " + ("keys array<long>" if keys else ", ".join(f"max_{f} int" for f in FIELDS)))


def bucket_of(gram: Column) -> Column:
    return (F.crc32(gram) % BUCKETS).cast("int")


def blocks_of(placed_chunks: DataFrame) -> DataFrame:
    """A row a block: its sources, the most that a chunk's kind adds, and what ranking and filters need of each chunk."""
    kind = F.col("chunk_type") if "chunk_type" in placed_chunks.columns else F.lit("text")
    doc = F.col("doc_id") if "doc_id" in placed_chunks.columns else F.col("chunk_id")
    row = F.struct("place", "chunk_id", doc.alias("doc_id"), "source_id", "author", kind.alias("chunk_type"))
    return placed_chunks.groupBy("block").agg(F.collect_set("source_id").alias("sources"), F.max(bonus_of(kind)).alias("max_bonus"), F.sort_array(F.collect_list(row)).alias("chunks"))


# ---- plans of terms --------------------------------------------------------------------------


@dataclass(frozen=True)
class Index:
    """The tables of an opened index that searches read."""

    postings: DataFrame
    grams: DataFrame  # gram, df, n_blocks, bucket
    blocks: DataFrame
    removed: DataFrame | None = None  # segment, doc_id of chunks that no longer count


def grams_in(folded: str) -> list[str]:
    n = MATCH_MIN_LENGTH
    return [folded] if len(folded) < n else [folded[i : i + n] for i in range(len(folded) - n + 1)]


def cover(folded: str, df: dict[str, int]) -> list[tuple[int, str]]:
    """Places and grams that cover a term and whose lists hold least; empty if one of its grams is nowhere."""
    grams = grams_in(folded)
    if any(not df.get(g) for g in grams):
        return []
    best: list[tuple[int, list[int]]] = []  # by last gram: cost and places
    for i, g in enumerate(grams):
        before = min((best[j] for j in range(max(0, i - MATCH_MIN_LENGTH), i)), default=(0, []))
        best.append((before[0] + df[g], [*before[1], i]))
    return [(i, grams[i]) for i in best[-1][1]]


def overlaps_itself(folded: str) -> bool:
    return any(folded.startswith(folded[i:]) for i in range(1, len(folded)))


@dataclass(frozen=True)
class Plan:
    """A row for each gram that each term reads: term, gram, place in the term, grams read, and the term's length."""

    rows: list[tuple[int, str, int, int, int, bool]]
    frame: DataFrame

    def small(self) -> DataFrame:
        return F.broadcast(self.frame) if len(self.rows) <= MOST_BROADCAST else self.frame


def _in(grams: set[str], frame: DataFrame) -> DataFrame:
    """Rows of the grams' buckets; up to a hundred grams also as a filter of the scan."""
    frame = frame.where(F.col("bucket").isin(sorted({zlib.crc32(g.encode()) % BUCKETS for g in grams})))
    return frame.where(F.col("gram").isin(sorted(grams))) if len(grams) <= 100 else frame


def plan(index: Index, terms: list[Term]) -> Plan:
    """What to read for each term; nothing for terms that the index shows to be nowhere."""
    spark, every = index.grams.sparkSession, {g for t in terms for g in grams_in(t.folded)}
    asked = spark.createDataFrame([(g,) for g in sorted(every)], "gram string")
    found = _in(every, index.grams).join(F.broadcast(asked) if len(every) <= MOST_BROADCAST else asked, "gram", "left_semi")
    df: dict[str, int] = {}
    for r in found.select("gram", "df").collect():  # a row for each of the queries' grams and segments
        df[r.gram] = df.get(r.gram, 0) + r.df
    rows = []
    for i, t in enumerate(terms):
        chosen = cover(t.folded, df)
        rows += [(i, g, shift, len(chosen), len(t.folded), overlaps_itself(t.folded)) for shift, g in chosen]
    return Plan(rows, spark.createDataFrame(rows, "term int, gram string, shift int, parts int, size int, greedy boolean"))


def _read(index: Index, planned: Plan, keys: bool, blocks: DataFrame | None = None) -> DataFrame:
    """The postings of the planned grams, a row for each term that reads them, blocks together."""
    rows = _in({r[1] for r in planned.rows}, index.postings).join(planned.small().select("gram"), "gram", "left_semi")
    if blocks is not None:
        rows = rows.join(blocks.select(F.shiftright("block", UNIT_BITS).alias("unit")), "unit", "left_semi")
    rows = by_block(rows, keys)
    if blocks is not None:
        rows = rows.join(blocks.select("block"), "block", "left_semi")
    return rows.join(planned.small(), "gram").repartition("block")


def bounds(index: Index, planned: Plan) -> DataFrame:
    """term, block and the most occurrences that a chunk of the block can have in each field."""
    most = [f"max_{f}" for f in FIELDS]
    each = _read(index, planned, False).groupBy("block", "term", "shift", "parts").agg(*[F.max(m).alias(m) for m in most])
    return each.groupBy("block", "term", "parts").agg(F.count("*").alias("_have"), *[F.min(m).alias(m) for m in most]).where("_have = parts").drop("_have", "parts")


def counts(index: Index, planned: Plan, blocks: DataFrame | None = None) -> DataFrame:
    """block, place, term, text, title, author: how often each chunk that holds a term holds it in each field."""
    rows = _read(index, planned, True, blocks)
    # A key less the gram's place in the term is the term's start, if it begins in the field.
    starts = F.transform(F.filter("keys", lambda k: k.bitwiseAND(COUNT_MASK) >= F.col("shift")), lambda k: k - F.col("shift"))
    short = F.col("size") < MATCH_MIN_LENGTH
    rows = rows.select("block", "term", "shift", "parts", "size", "greedy", F.when(short, F.col("keys")).otherwise(starts).alias("keys"))
    lists = rows.groupBy("block", "term", "shift", "parts", "size", "greedy").agg(F.flatten(F.collect_list("keys")).alias("keys"))
    # The shortest list first: what the others keep of it only gets shorter.
    terms = lists.groupBy("block", "term", "parts", "size", "greedy").agg(F.sort_array(F.collect_list(F.struct(F.size("keys").alias("n"), "keys"))).alias("lists")).where(F.size("lists") == F.col("parts"))
    held = F.aggregate(F.slice("lists", 2, 1 << 30), F.get("lists", F.lit(0))["keys"], lambda kept, x: F.array_intersect(kept, x["keys"]))
    hits = terms.select("block", "term", "size", "greedy", F.explode(held).alias("key"))
    at, value = F.shiftright("key", COUNT_BITS), F.col("key").bitwiseAND(COUNT_MASK)
    cells = hits.select("block", "term", "size", "greedy", at.alias("at"), value.alias("value")).groupBy("block", "term", "size", "greedy", "at")
    greedy = F.aggregate(
        F.sort_array(F.collect_list(F.when(F.col("greedy") & ~short, F.col("value")))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("end")),
        lambda s, x: F.when(x >= s["end"], F.struct((s["n"] + 1).alias("n"), (x + F.col("size")).alias("end"))).otherwise(s),
        lambda s: s["n"],
    )
    per = cells.agg(F.when(short, F.max("value")).when(F.col("greedy"), greedy).otherwise(F.count("*")).alias("n"))
    field = F.col("at").bitwiseAND((1 << FIELD_BITS) - 1)
    sums = [F.coalesce(F.max(F.when(field == i, F.col("n"))), F.lit(0)).alias(f) for i, f in enumerate(FIELDS)]
    return per.groupBy("block", F.shiftright("at", FIELD_BITS).cast("int").alias("place"), "term").agg(*sums)


# ---- searches --------------------------------------------------------------------------------


def _points(prefix: str = "") -> Column:
    points = F.lit(0.0)
    for f, (weight, cap) in FIELDS.items():
        points = points + F.least(F.col(prefix + f), F.lit(cap)).cast("double") * weight
    return points


def _named(index: Index, found: DataFrame, source: str | None = None, author: str | None = None, blocks: DataFrame | None = None) -> DataFrame:
    """Rows of block and place with their chunk's id, source, author and kind; filtered, and without removed documents.

    The blocks are never broadcast: Spark goes by the size of their files, and in memory they take sixty times that, more than the driver holds.
    Where ``found`` lies in ``blocks`` alone, only those are shuffled.
    """
    names = ["chunk_id", "doc_id", "source_id", "author", "chunk_type"]
    # An array a field, so that those which nobody asks for are neither read nor shuffled.
    held = index.blocks.select("block", *[F.col(f"chunks.{c}").alias(f"_{c}") for c in names])
    if blocks is not None:
        held = held.join(blocks.select("block"), "block", "left_semi")
    rows = found.join(held.hint("merge"), "block").select(*found.columns, *[F.get(f"_{c}", F.col("place")).alias(c) for c in names])
    if source is not None:
        rows = rows.where(F.col("source_id") == source)
    if author is not None:
        rows = rows.where(F.col("author") == author)
    if index.removed is not None:
        rows = rows.withColumn("segment", F.shiftright("block", SEGMENT_BITS).cast("int")).join(index.removed, ["segment", "doc_id"], "left_anti").drop("segment")
    return rows


def _terms(queries: dict[str, str]) -> tuple[list[Term], list[tuple[str, int]]]:
    """The different terms of all queries, and which query has which."""
    numbers: dict[tuple[str, str], int] = {}
    terms, wanted = [], []
    for qid, q in queries.items():
        for t in parse(q):
            if (key := (t.kind, t.folded)) not in numbers:
                numbers[key] = len(terms)
                terms.append(t)
            wanted.append((qid, numbers[key]))
    return terms, wanted


def recall(index: Index, query: str, source: str | None = None, author: str | None = None) -> DataFrame:
    """chunk_id of all chunks that hold any term of the query."""
    found = counts(index, plan(index, _terms({"q": query})[0])).select("block", "place").distinct()
    return _named(index, found, source, author).select("chunk_id")


def hits(index: Index, terms: list[str]) -> DataFrame:
    """term, chunk_id, source_id, text, title, author: a row for each chunk that holds a term, with its counts."""
    parsed, wanted = _terms({t: t for t in terms})
    names = index.postings.sparkSession.createDataFrame([(i, t) for t, i in wanted], "term int, name string")
    return _named(index, counts(index, plan(index, parsed)).withColumnRenamed("author", "in_author")).join(F.broadcast(names), "term").select(F.col("name").alias("term"), "chunk_id", "source_id", "text", "title", F.col("in_author").alias("author"))


def _layers(index: Index, planned: Plan, wanted: DataFrame, source: str | None = None, author: str | None = None, blocks: DataFrame | None = None) -> DataFrame:
    """Each query's candidates with what they are ordered by."""
    per = counts(index, planned, blocks).join(F.broadcast(wanted), "term")
    whole = per.groupBy("block", "place", "qid").agg(F.max((F.col("text") > 0).cast("int")).alias("prose_hit"), F.count("*").cast("int").alias("term_count"), F.sum(_points()).alias("_points"))
    return _named(index, whole, source, author, blocks).withColumn("score", F.col("_points") + bonus_of(F.col("chunk_type"))).drop("_points")


def _order() -> list[Column]:
    return [F.desc("prose_hit"), F.desc("term_count"), F.desc("score"), F.asc("chunk_id")]


def _asked(index: Index, queries: dict[str, str]) -> tuple[Plan, DataFrame]:
    terms, wanted = _terms(queries)
    return plan(index, terms), index.postings.sparkSession.createDataFrame(wanted, "qid string, term int")


def batch(index: Index, queries: dict[str, str], limit: int, by_source: bool = False) -> DataFrame:
    """The first ``limit`` chunks of each query (and source): qid, position, chunk_id, source_id and the layers."""
    window = Window.partitionBy("qid", *["source_id"] * by_source).orderBy(*_order())
    ranked = _layers(index, *_asked(index, queries)).withColumn("position", F.row_number().over(window))
    return ranked.where(F.col("position") <= limit).select("qid", "position", "chunk_id", "source_id", "prose_hit", "term_count", "score")


def search(index: Index, query: str, limit: int, source: str | None = None, author: str | None = None) -> DataFrame:
    """The first ``limit`` chunks of the order, from every block with a candidate."""
    return _layers(index, *_asked(index, {"q": query}), source, author).orderBy(*_order()).limit(limit).drop("qid")


@dataclass(frozen=True)
class Top:
    """The first results, how many blocks had a candidate, and in how many of them lists were read."""

    rows: DataFrame
    candidates: int
    evaluated: int


def top(index: Index, query: str, limit: int, source: str | None = None, author: str | None = None, first: int = 8) -> Top:
    """The same results by blocks of falling bound: the ``first`` blocks, then those whose bound is not below the last result so far."""
    spark = index.postings.sparkSession
    planned, wanted = _asked(index, {"q": query})
    per = bounds(index, planned).groupBy("block").agg(F.max((F.col("max_text") > 0).cast("int")).alias("prose_hit"), F.count("*").cast("int").alias("term_count"), F.sum(_points("max_")).alias("_points"))
    kept = index.blocks if source is None else index.blocks.where(F.array_contains("sources", source))
    layers = ["prose_hit", "term_count", "score"]
    per = per.join(kept.select("block", "max_bonus"), "block").withColumn("score", F.col("_points") + F.col("max_bonus")).select("block", *layers).persist()
    try:
        candidates = per.count()
        begun = [r.block for r in per.orderBy(*map(F.desc, layers), "block").select("block").take(first)]
        look = lambda blocks: _layers(index, planned, wanted, source, author, blocks).orderBy(*_order()).limit(limit).drop("qid")
        one = look(F.broadcast(spark.createDataFrame([(b,) for b in begun], "block long")))
        got = one.collect()  # at most ``limit``, as below
        rest = per.where(~F.col("block").isin(begun))
        if limit and len(got) == limit:
            rest = rest.where(F.struct(*layers) >= F.struct(*[F.lit(got[-1][c]) for c in layers]))
        more = rest.count()
        if more:
            got = got + look(rest.select("block")).collect()
        return Top(spark.createDataFrame(got, one.schema).orderBy(*_order()).limit(limit), candidates, len(begun) + more)
    finally:
        per.unpersist()
