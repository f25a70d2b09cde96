"""Byte-level BPE encoding and decoding by a segment tree over byte positions.

Leaf i of a piece's tree holds the rank of the pair that starts at live position i, with i in the
low digits, so the root is the leftmost pair of minimum rank. A merge takes the right part out of
the list of live parts and updates three leaves, each in logarithmic time. Short pieces (words) run
through their trees together, one merge of every piece at a time, as rows of one array; a piece too
long for that has a tree of its own. Pieces are encoded once per worker and remembered up to a
bound, after which the memory starts afresh: that changes time, never ids.

Defined cases: a null text counts as empty (no ids, digests of nothing). Repeated rows are encoded
one by one. Texts of any length are encoded whole. An empty table gives an empty result. Extra
columns are dropped.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

beside = re.compile(r" \s|\s |^ | \Z").search
NONE = np.int64(1) << 62
#: The white space characters of Unicode.
WHITE = r"\t-\r\x20\x85\xa0  -     　"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class PairTable:
    """Rank of the token that a pair of tokens makes: an open-addressed table of int64 keys."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = rank
        self.pairs = pairs
        keys, values = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int64, len(pairs))
        self.bits = max(8, int(len(pairs) * 4).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int64)
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] < 0
            _, first = np.unique(at, return_index=True)
            takes = np.zeros(len(keys), bool)
            takes[first] = free[first]
            self.keys[at[takes]], self.values[at[takes]] = keys[takes], values[takes]
            keys, values, at = keys[~takes], values[~takes], (at[~takes] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 20 | right
        at = self._slot(keys)
        found, out = self.keys[at], np.where(self.keys[at] == keys, self.values[at], NONE)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


class ByteBpe:
    """Encoder and decoder for one table of ranks."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN, remembered: int = 500_000, together: int = 64):
        self.ranks = read_ranks(path)
        self.table = PairTable(self.ranks)
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.token = {str(rank): token for token, rank in self.ranks.items()}
        self.find = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"(?!\S)", f"(?![^{WHITE}])").replace(r"\s", f"[{WHITE}]")).findall
        self.known: dict[str, str] = {}
        self.remembered, self.together = remembered, together

    def _merge_alone(self, piece: bytes) -> list[int]:
        n = len(piece)
        ids = [int(self.byte[b]) for b in piece]
        size = 1 << max(0, (n - 1).bit_length())
        pairs, none = self.table.pairs, int(NONE)
        tree = [none] * (2 * size)
        for i in range(n - 1):
            rank = pairs.get(ids[i] << 20 | ids[i + 1])
            if rank is not None:
                tree[size + i] = rank * size + i
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i: int, value: int) -> None:
            i += size
            tree[i] = value
            while i > 1:
                i >>= 1
                tree[i] = min(tree[2 * i], tree[2 * i + 1])

        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while tree[1] != none:
            rank, i = divmod(tree[1], size)
            gone = after[i]
            ids[i], ids[gone], after[i] = rank, -1, after[gone]
            put(gone, none)
            for j, k in ((before[i], i), (i, after[i])):
                if j >= 0:
                    rank = pairs.get(ids[j] << 20 | ids[k]) if k < n else None
                    put(j, none if rank is None else rank * size + j)
            if after[i] < n:
                before[after[i]] = i
        return [x for x in ids if x >= 0]

    def _merge_together(self, pieces: list[bytes], size: int) -> list[list[int]]:
        n, lens = len(pieces), np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = np.full((n, size + 1), -1, np.int64)
        inside = np.arange(size) < lens[:, None]
        ids[:, :size][inside] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        after, before = np.tile(np.arange(1, size + 2), (n, 1)), np.tile(np.arange(-1, size), (n, 1))
        tree = np.full((n, 2 * size), NONE, np.int64)
        rows, cols = np.nonzero(inside[:, 1:])
        rank = self.table.look(ids[rows, cols], ids[rows, cols + 1])
        tree[rows, size + cols] = np.where(rank == NONE, NONE, rank * size + cols)
        for i in range(size - 1, 0, -1):
            tree[:, i] = np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1])

        def put(r: np.ndarray, i: np.ndarray, value: np.ndarray | np.int64) -> None:
            i = i + size
            tree[r, i] = value
            for _ in range(size.bit_length() - 1):
                i = i >> 1
                tree[r, i] = np.minimum(tree[r, 2 * i], tree[r, 2 * i + 1])

        live = np.arange(n)
        while len(live := live[tree[live, 1] != NONE]):
            rank, i = np.divmod(tree[live, 1], size)
            gone = after[live, i]
            nxt = after[live, gone]
            ids[live, i], ids[live, gone], after[live, i] = rank, -1, nxt
            put(live, gone, NONE)
            has = nxt < lens[live]
            before[live[has], nxt[has]] = i[has]
            for r, j, k in ((live, i, nxt), (live, before[live, i], i)):
                ok = (j >= 0) & (k < lens[r])
                value = np.full(len(r), NONE, np.int64)
                made = self.table.look(ids[r[ok], j[ok]], ids[r[ok], k[ok]])
                value[ok] = np.where(made == NONE, NONE, made * size + j[ok])
                at = j >= 0
                put(r[at], j[at], value[at])
        kept = ids >= 0
        flat, ends = ids[kept].tolist(), np.cumsum(kept.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece, merged by rank."""
        out: list[list[int] | None] = [None] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if (rank := self.ranks.get(piece)) is not None:
                out[i] = [rank]
            elif len(piece) > self.together:
                out[i] = self._merge_alone(piece)
            elif piece:
                groups.setdefault(1 << (len(piece) - 1).bit_length(), []).append(i)
            else:
                out[i] = []
        for size, members in groups.items():
            for i, ids in zip(members, self._merge_together([pieces[i] for i in members], size), strict=True):
                out[i] = ids
        return out

    def _learn(self, chunks: set[str]) -> None:
        """Remembers the ids, as text, of chunks: runs whose pieces no neighbour can change."""
        split = {c: self.find(c) for c in chunks}
        pieces = list({p for ps in split.values() for p in ps})
        said = dict(zip(pieces, (",".join(map(str, ids)) for ids in self.merge([p.encode() for p in pieces])), strict=True))
        for chunk, ps in split.items():
            self.known[chunk] = ",".join([said[p] for p in ps])

    def encode_said(self, texts: list[str]) -> list[str]:
        """Each text's ids in decimal, joined by commas."""
        # A space between two characters that are not white space starts a piece. Where a space has
        # white space or nothing beside it, the text is cut by the pattern instead.
        cut = [self.find(t) if beside(t) or "\0" in t else t.replace(" ", "\0 ").split("\0") if t else [] for t in texts]
        said = [list(map(self.known.get, chunks)) for chunks in cut]
        short = [i for i, ids in enumerate(said) if None in ids]
        if short:
            new = {c for i in short for c, ids in zip(cut[i], said[i], strict=True) if ids is None}
            if len(self.known) + len(new) > self.remembered:
                self.known.clear()
            self._learn(new)
            for i in short:
                said[i] = [ids if ids is not None else self.known[c] for c, ids in zip(cut[i], said[i], strict=True)]
        return [",".join(ids) for ids in said]

    def encode(self, text: str) -> list[int]:
        said = self.encode_said([text])[0]
        return [int(x) for x in said.split(",")] if said else []

    def decode_said(self, said: str) -> bytes:
        return b"".join(map(self.token.__getitem__, said.split(","))) if said else b""

    def decode(self, ids: list[int]) -> bytes:
        return self.decode_said(",".join(map(str, ids)))


_made: dict[str, ByteBpe] = {}


def worker_codec(path: str) -> ByteBpe:
    """One codec per worker process and table."""
    if path not in _made:
        _made[path] = ByteBpe(path)
    return _made[path]


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches, cut into slices of a bounded size of text (a longer single row stays whole)."""
    for batch in batches:
        if batch.num_rows:
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0).to_numpy()
            part = np.cumsum(sizes) // most_bytes
            at = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for a, b in zip(at, at[1:], strict=False):
                yield batch.slice(a, b - a)


def digests(documents: DataFrame, path: str) -> DataFrame:
    """One row per document: its number of ids, and digests of the ids and of the bytes they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        codec = worker_codec(path)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch in slices(batches, "text"):
            said = codec.encode_said([t or "" for t in batch["text"].to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast(pa.int64()), pa.array([s.count(",") + 1 if s else 0 for s in said], pa.int64()), pa.array([sha(s.encode()) for s in said]), pa.array([sha(codec.decode_said(s)) for s in said])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, DIGESTS)


def encode(documents: DataFrame, path: str) -> DataFrame:
    """The documents' doc_id and text with their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        codec = worker_codec(path)
        for batch in slices(batches, "text"):
            ids = [codec.encode(t or "") for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), batch["text"], pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "text", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, text string, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The bytes that each row's ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(path)
        for batch in batches:
            made = [codec.decode(ids or []) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), pa.array(made, pa.binary())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")
