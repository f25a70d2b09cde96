"""N-gram Jaccard join by PartEnum signatures.

A document's set is its distinct 5-word shingles, hashed to 64 bits; equal sets are one node. Sizes
fall into bands [l, l / 0.8], so a pair of similarity 0.8 lies in one band or two neighbouring ones,
and differs in at most k = 2 r / 9 shingles, r the upper end of the pair's band. For each band the
domain of shingles is dealt, on a first level, into k / 2 + 1 + e groups; two such sets differ by more than one
shingle in at most k / 2 of them. Each group is dealt, on a second level, into three parts, and its signatures are the subsets of
two: sets that differ there by one shingle at most agree on one of these wholly, so they share the signature
(band, group, subset, what the set has in it). A subset that is empty in a set would be shared for nothing. A set with at
most e groups that have such a subset needs none of them, since e + 1 groups are as near as said with any partner;
only the other, rare sets sign their empty subsets.

Signatures travel packed, a row per (slice of documents, bucket) with the nodes of their owners; the number of buckets follows the
number of shingles, so a bucket's size does not grow with the input, and a bucket's signatures meet range by range. A signature shared by at most
``few`` nodes gives their pairs; by more, its pairs with the least node, and its members. Pairs whose
sketches differ too much are dropped, the others verified exactly on their sets. Links make components. A wide signature's members that then are
in different components are paired across components, where sketches allow it, and verified too, so no link between
components is lost. Where a wide signature has two members in one component, pairs of that component
may be untried; since links join members of one component only, its links are counted there: each two
members meet once, in one pair of blocks of a bounded size, and are held against each other by whole
hashes. Only sums per node leave a block, but that work is quadratic in a component's distinct texts.

Nothing but counts reaches the driver; the ids of documents with candidates are broadcast only up
to ``most_broadcast``, beyond it the join is shuffled.

Defined cases: texts without words (and null texts) have 0 shingles and link with nothing; with
fewer than five words the whole sequence is the one shingle. Repeated rows are one node, and all of
them are returned. A null doc_id is never a component's id unless its component has no other. An
empty table gives an empty result. Extra columns are dropped.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.bytebpe import slices
from quillmark.llm.common import edges, materialize, pack, unpack

WORDS = 5
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
S32 = np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> S32)) * K2
    x = (x ^ (x >> S32)) * K2
    return x ^ (x >> S32)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The text's set as sorted 64-bit hashes."""
    own = (text or "").encode().lower().split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
    if not len(h):
        return h
    n = min(words, len(h))
    s = np.full(len(h) - n + 1, n, np.uint64)
    for j in range(n):
        s = mix(s * K1 + h[j : len(h) - n + 1 + j])
    s.sort()
    new = s[1:] != s[:-1]
    return s if new.all() else s[np.append(True, new)]


def node_of(s: np.ndarray) -> int | None:
    return int(np.array([xxhash.xxh3_64_intdigest(s.tobytes())], np.uint64).view(np.int64)[0]) if len(s) else None


def sketch(s: np.ndarray) -> bytes:
    """How many of the set's hashes fall into each of 256 parts, up to 255.

    Two sets differ in at least as many elements as their counts differ.
    """
    return np.minimum(np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=256), 255).astype(np.uint8).tobytes()


def bands(largest: int) -> list[tuple[int, int]]:
    """Ranges of sizes; sets of similarity 0.8 lie in the same or in neighbouring ranges."""
    out, low = [], 1
    while low <= largest:
        out.append((low, low * 100 // 80))
        low = out[-1][1] + 1
    return out


_BANDS = bands(1 << 40)
_ENDS = np.array([r for _, r in _BANDS])


#: The two parts of each subset.
PAIRS = [(1, 2), (0, 2), (0, 1)]


def groups_of(k: int) -> tuple[int, int]:
    """How many groups of the first level a band has whose sets differ in at most k shingles, and how many of those are spare."""
    spare = max(2, k // 12)
    return k // 2 + 1 + spare, spare


@lru_cache(64)
def _dealt(i: int) -> tuple[int, int, np.ndarray, np.ndarray] | None:
    """Groups, spare ones, salt and the subsets' numbers of a band; none where sets are equal or not similar."""
    k = 2 * int(_ENDS[i]) // 9
    if k == 0:
        return None
    groups, spare = groups_of(k)
    salt = mix(np.array([i + 1], np.uint64) * K1)
    return groups, spare, salt, salt * np.arange(1, 3 * groups + 1, dtype=np.uint64).reshape(groups, 3)


def signatures(s: np.ndarray) -> np.ndarray:
    """All signatures of a set."""
    made, band = [], int(np.searchsorted(_ENDS, len(s)))
    for i in (band, band + 1):
        if (dealt := _dealt(i)) is None:
            continue
        groups, spare, salt, subset = dealt
        x = mix(s ^ salt)
        # Numbers of 16 bits are sorted by radix, several times as fast.
        part = ((x >> S32) * np.uint64(3 * groups) >> S32).astype(np.uint16 if 3 * groups <= 1 << 16 else np.int64)
        order = np.argsort(part, kind="stable")
        part = part[order]
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        held = np.zeros(3 * groups, np.uint64)  # a sum of hashes for each part, 0 for an empty one
        held[part[starts]] = mix(np.add.reduceat(mix(x * K1)[order], starts)) | np.uint64(1)
        one, two, has = ((held * m).reshape(groups, 3) for m in (K1, K2, np.uint64(1)))
        own = mix(np.stack([one[:, a] + two[:, b] for a, b in PAIRS], axis=1) + subset)
        some = np.stack([(has[:, a] | has[:, b]) != 0 for a, b in PAIRS], axis=1)
        made.append(own.reshape(-1) if (~some.all(axis=1)).sum() > spare else own[some])
    return np.concatenate(made) if made else np.zeros(0, np.uint64)


def sets_of(documents: DataFrame, carry: str | None = None) -> DataFrame:
    """doc_id, n_shingles, node (null for an empty set), sketch and carried (a column of longs, if one is named) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in slices(batches, "text"):
            made = [shingles(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), pa.array(map(len, made), pa.int64()), pa.array(map(node_of, made), pa.int64()), pa.array(map(sketch, made), pa.binary()), batch["carried"]], names=["doc_id", "n_shingles", "node", "sketch", "carried"])

    carried = F.col(carry).cast("long") if carry else F.lit(None).cast("long")
    return documents.select("doc_id", "text", carried.alias("carried")).mapInArrow(run, "doc_id long, n_shingles long, node long, sketch binary, carried long")


def dealing(total: int, per_bucket: int = 8_000_000) -> tuple[int, int]:
    """Buckets for so many shingles, and the bits that their signatures keep.

    Each bucket holds the node of nearly every document again, so many small ones cost more than the signatures. There are about
    as many signatures as shingles; with ten bits beyond their number one in some thousand meets another by chance.
    """
    return max(8, total // per_bucket + 1), min(64, total.bit_length() + 10)


def packed_signatures(documents: DataFrame, buckets: int, bits: int = 64) -> DataFrame:
    """(bucket, body): a slice's signatures in a range of them, ascending, the owner of each, the owners' nodes and sizes.

    A signature is cut to its first ``bits``; signatures that meet by that alone cost a comparison, not a result.
    """
    starts = edges(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in slices(batches, "text", 6_000_000):
            seen: dict[int, tuple[int, np.ndarray]] = {}
            for text in batch["text"].to_pylist():
                s = shingles(text)
                node = node_of(s)
                if node is not None and node not in seen and len(made := signatures(s)):
                    seen[node] = (len(s), made)
            if not seen:
                continue
            nodes, sizes = np.fromiter(seen, np.int64, len(seen)), np.array([n for n, _ in seen.values()], np.int64)
            sigs = np.concatenate([s for _, s in seen.values()]) >> np.uint64(64 - bits)
            owner = np.repeat(np.arange(len(seen), dtype=np.uint64), [len(s) for _, s in seen.values()])
            low = np.uint64(len(seen).bit_length())
            if bits + int(low) <= 64:  # one number for both is sorted several times as fast
                both = np.sort(sigs << low | owner)
                sigs, owner = both >> low, (both & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
            else:
                order = np.argsort(sigs, kind="stable")
                sigs, owner = sigs[order], owner[order].astype(np.int64)
            cut = [*np.searchsorted(sigs, starts >> np.uint64(64 - bits)).tolist(), len(sigs)]
            rows = []
            for i, (a, b) in enumerate(itertools.pairwise(cut)):
                if b > a:
                    held = np.zeros(len(seen), bool)
                    held[owner[a:b]] = True
                    own, index = np.flatnonzero(held), (np.cumsum(held) - 1)[owner[a:b]]
                    rows.append((i, pack(sigs[a:b], index, nodes[own].view(np.float64), sizes[own])))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary())], names=["bucket", "body"])

    return documents.select("text").mapInArrow(run, "bucket long, body binary")


def candidates(packed: DataFrame, few: int = 3, most: int = 1_000_000) -> DataFrame:
    """kind 0: a pair of nodes (x, y) that share a signature; kind 1: a wide signature x and its member y, of size n."""

    def meet(sigs: np.ndarray, nodes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pairs, and the wide signatures with their members and sizes."""
        order = np.argsort(sigs)
        sigs, nodes, sizes = sigs[order], nodes[order], sizes[order]
        same = np.concatenate([[False], sigs[1:] == sigs[:-1], [False]])
        live = same[1:] | same[:-1]
        sigs, nodes, sizes = sigs[live], nodes[live], sizes[live]
        order = np.lexsort((nodes, sigs))
        sigs, nodes, sizes = sigs[order], nodes[order], sizes[order]
        fresh = np.append(True, (np.diff(sigs) != 0) | (np.diff(nodes) != 0))[: len(sigs)]
        sigs, nodes, sizes = sigs[fresh], nodes[fresh], sizes[fresh]
        starts = np.flatnonzero(np.append(True, np.diff(sigs) != 0)[: len(sigs)])
        length = np.diff(np.append(starts, len(sigs)))
        each, first = np.repeat(length, length), np.repeat(starts, length)
        at = np.arange(len(sigs))
        a, b = [first[(each > few) & (at > first)]], [at[(each > few) & (at > first)]]
        for d in range(1, few):
            ok = np.flatnonzero((each <= few) & (at - first >= d))
            a.append(ok - d)
            b.append(ok)
        a, b = np.concatenate(a), np.concatenate(b)
        near = 100 * np.minimum(sizes[a], sizes[b]) >= 80 * np.maximum(sizes[a], sizes[b])
        pairs = np.unique(np.stack([np.minimum(nodes[a], nodes[b])[near], np.maximum(nodes[a], nodes[b])[near]], axis=1), axis=0)
        wide = each > few
        return pairs, sigs[wide].view(np.int64), nodes[wide], sizes[wide]

    def run(group: pa.Table) -> pa.Table:
        made = [unpack(body.as_py()) for body in group["body"]]
        low, high = min(int(m[0][0]) for m in made), max(int(m[0][-1]) for m in made)
        parts = -(-sum(len(m[0]) for m in made) // most)
        # A bucket's signatures meet range by range, so that what sorting takes does not grow with the bucket.
        starts = np.array([low + (high - low + 1) * i // parts for i in range(1, parts)], np.uint64)
        cuts = [[0, *np.searchsorted(m[0], starts).tolist(), len(m[0])] for m in made]
        met = []
        for i in range(parts):
            own = [(m, slice(c[i], c[i + 1])) for m, c in zip(made, cuts, strict=True) if c[i + 1] > c[i]]
            if own:
                met.append(meet(*(np.concatenate(x) for x in ([m[0][r] for m, r in own], [m[2].view(np.int64)[m[1][r]] for m, r in own], [m[3][m[1][r]].astype(np.int64) for m, r in own]))))
        pairs = np.unique(np.concatenate([m[0] for m in met]), axis=0)
        sigs, nodes, sizes = (np.concatenate([m[k] for m in met]) for k in (1, 2, 3))
        ints = lambda *parts: pa.array(np.concatenate(parts).astype(np.int64))
        return pa.table({
            "kind": ints(np.zeros(len(pairs)), np.ones(len(sigs))),
            "x": ints(pairs[:, 0], sigs),
            "y": ints(pairs[:, 1], nodes),
            "n": ints(np.zeros(len(pairs)), sizes),
        })

    return packed.groupBy("bucket").applyInArrow(run, "kind long, x long, y long, n long")


def plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those pairs (x, y) whose sketches allow similarity; the others differ in too much for sure, and their sets are never shipped."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"k{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, 256).astype(np.int16) for c in ("kx", "ky"))
                near = 9 * np.abs(a - b).sum(axis=1, dtype=np.int64) <= batch["nx"].to_numpy() + batch["ny"].to_numpy()
                yield batch.select(["x", "y"]).filter(pa.array(near))

    return pairs.join(side("x"), "x").join(side("y"), "y").select("x", "y", "nx", "ny", "kx", "ky").mapInArrow(run, "x long, y long")


def _overlaps(documents: DataFrame, nodes: DataFrame, pairs: DataFrame, bits: int, most_broadcast: int) -> DataFrame:
    """The pairs (x, y) with how many shingles they share by hashes of so many bits, and their sizes nx, ny."""
    touched = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    needed = materialize(nodes.join(touched, "node", "left_semi").select("rep"))
    if needed.count() <= most_broadcast:
        needed = F.broadcast(needed)
    picked = documents.select("doc_id", "text").join(needed, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    kind = pa.int32() if bits == 32 else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in slices(batches, "text"):
            made = [s for s in (shingles(t) for t in batch["text"].to_pylist()) if len(s)]
            cut = [(s >> np.uint64(64 - bits)).astype(f"u{bits // 8}").view(f"i{bits // 8}") for s in made]
            yield pa.RecordBatch.from_arrays([pa.array(map(node_of, made), pa.int64()), pa.array(map(len, made), pa.int64()), pa.array(cut, pa.list_(kind))], names=["node", "n", "set"])

    sets = picked.select("text").mapInArrow(run, f"node long, n long, set array<{'int' if bits == 32 else 'long'}>").dropDuplicates(["node"])
    side = lambda c: sets.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("set").alias(f"s{c}"))
    both = pairs.join(side("x"), "x").join(side("y"), "y")
    return both.select("x", "y", "nx", "ny", F.size(F.array_intersect("sx", "sy")).cast("long").alias("shared"))


def verified(documents: DataFrame, nodes: DataFrame, pairs: DataFrame, most_broadcast: int = 1_000_000) -> DataFrame:
    """Those pairs (x, y) whose sets are similar. nodes: node, rep (a doc_id with that set).

    Sets are first compared by half their hashes, which halves what is shuffled; pairs so near the
    limit that chance could have moved them over it are compared again by whole hashes.
    """
    margin = 100 * F.col("shared") - 80 * (F.col("nx") + F.col("ny") - F.col("shared"))
    rough = materialize(_overlaps(documents, nodes, pairs, 32, most_broadcast).select("x", "y", margin.alias("margin"), (180 * (4 + (F.col("nx") + F.col("ny")) / 4096 + F.col("nx") * F.col("ny") / (1 << 31))).alias("doubt")))
    sure = rough.where("margin >= doubt").select("x", "y")
    close = rough.where("abs(margin) < doubt").select("x", "y")
    if close.isEmpty():
        return sure
    return sure.unionByName(_overlaps(documents, nodes, close, 64, most_broadcast).where(margin >= 0).select("x", "y"))


def components(links: DataFrame) -> DataFrame:
    """node, comp (the least node of its component) of every node with a link.

    Each round takes the least label among neighbours and then that label's own; labels only fall, so rounds end.
    """
    edges = materialize(links.select(F.explode(F.array(F.struct(F.col("x").alias("node"), F.col("y").alias("other")), F.struct(F.col("y").alias("node"), F.col("x").alias("other")))).alias("e")).select("e.*").distinct())
    labels = materialize(edges.groupBy("node").agg(F.least("node", F.min("other")).alias("comp")))
    while True:
        met = edges.join(labels.select(F.col("node").alias("other"), "comp"), "other").groupBy("node").agg(F.min("comp").alias("_met"))
        lower = labels.join(met, "node").select("node", F.col("comp").alias("_was"), F.least("comp", "_met").alias("_to"))
        jumped = lower.join(labels.select(F.col("node").alias("_to"), F.col("comp").alias("_far")), "_to", "left")
        moved = materialize(jumped.select("node", "_was", F.least("_to", F.coalesce("_far", "_to")).alias("comp")))
        labels = moved.select("node", "comp")
        if moved.where("comp <> _was").isEmpty():
            return labels


def across(wide: DataFrame, comps: DataFrame, nodes: DataFrame, block: int = 4096, most: int = 8192) -> DataFrame:
    """Pairs (x, y) of members of a wide signature that lie in different components and may be similar.

    Members meet in blocks of a bounded size, about ``most`` pairs at once, where a pair whose sketches differ too much is dropped;
    it differs too much itself.
    """
    members = wide.join(comps, "node", "left").select("sig", "node", "n", F.coalesce("comp", "node").alias("comp"))
    mixed = members.groupBy("sig").agg((F.min("comp") != F.max("comp")).alias("_mixed"), F.count("*").alias("_n")).where("_mixed").select("sig", F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    members = members.join(mixed, "sig").join(nodes.select("node", "sketch"), "node").withColumn("part", F.pmod(F.hash("node"), F.col("_blocks")))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    members = members.withColumn("_other", other).select("sig", F.least("part", "_other").alias("low"), F.greatest("part", "_other").alias("high"), "part", "node", "n", "comp", "sketch")

    def run(group: pa.Table) -> pa.Table:
        node, n, comp, part = (group[c].to_numpy() for c in ("node", "n", "comp", "part"))
        counts = np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(-1, 256).astype(np.int16)
        low, high = group["low"][0].as_py(), group["high"][0].as_py()
        left, right = np.flatnonzero(part == low), np.flatnonzero(part == high)
        xs, ys = [], []
        rows = max(1, most // max(1, len(right)))
        for start in range(0, len(left), rows):  # most signatures have few members, which all meet at once
            one, two = left[start : start + rows, None], right[None, :]
            fits = (comp[one] != comp[two]) & (100 * np.minimum(n[one], n[two]) >= 80 * np.maximum(n[one], n[two]))
            a, b = np.nonzero(fits & (one < two) if low == high else fits)
            i, j = one[a, 0], two[0, b]
            near = 9 * np.abs(counts[i] - counts[j]).sum(axis=1, dtype=np.int32) <= n[i] + n[j]
            xs.append(np.minimum(node[i], node[j])[near])
            ys.append(np.maximum(node[i], node[j])[near])
        whole = lambda v: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64())
        return pa.table({"x": whole(xs), "y": whole(ys)})

    return members.groupBy("sig", "low", "high").applyInArrow(run, "x long, y long").distinct()


def links_within(documents: DataFrame, members: DataFrame, block: int = 512, most_shingles: int = 1_000_000, most_broadcast: int = 1_000_000) -> DataFrame:
    """node, n_links: how many members of its component each member (node, rep, n, comp) is similar to.

    A component is dealt into blocks of about so many members and shingles at most; a node goes to each
    pair of blocks that has its own, so each two members meet in exactly one group.
    """
    blocks = members.groupBy("comp").agg(F.ceil(F.greatest(F.count("*") / block, F.sum("n") / most_shingles)).cast("int").alias("_blocks"))
    placed = materialize(members.join(blocks, "comp").select("node", "rep", "comp", "_blocks", F.pmod(F.hash("node"), F.col("_blocks")).alias("part")))
    needed, places = placed.select("rep").distinct(), placed.drop("rep")
    if placed.count() <= most_broadcast:
        needed, places = F.broadcast(needed), F.broadcast(places)
    picked = documents.select("doc_id", "text").join(needed, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in slices(batches, "text"):
            made = [s for s in (shingles(t) for t in batch["text"].to_pylist()) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array(map(node_of, made), pa.int64()), pa.array([s.tobytes() for s in made], pa.binary())], names=["node", "set"])

    def run(group: pa.Table) -> pa.Table:
        node, at = np.unique(group["node"].to_numpy(), return_index=True)  # repeated rows are one node
        part, held = group["part"].to_numpy()[at], group["set"].take(pa.array(at))
        own = [np.frombuffer(b.as_py(), np.uint64) for b in held]
        n = np.array([len(s) for s in own], np.int64)
        low, high = group["low"][0].as_py(), group["high"][0].as_py()
        left, right = np.flatnonzero(part == low), np.flatnonzero(part == high)
        _, column, holders = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        some = (holders > 1) & (holders < len(own))  # a shingle of one member is shared by no pair, one of all by each
        live = some[column]
        column, owner = (np.cumsum(some) - 1)[column[live]], np.repeat(np.arange(len(own)), n)[live]
        order = np.argsort(column, kind="stable")
        column, owner, width = column[order], owner[order], 4096
        shared = np.full((len(left), len(right)), int((holders == len(own)).sum()), np.int64)
        for start in range(0, int(some.sum()), width):
            a, b = np.searchsorted(column, [start, start + width])
            has = np.zeros((len(own), width), np.float32)
            has[owner[a:b], column[a:b] - start] = 1
            shared += (has[left] @ has[right].T).astype(np.int64)
        links = 100 * shared >= 80 * (n[left][:, None] + n[right][None, :] - shared)
        if low == high:
            np.fill_diagonal(links, False)
            nodes, sums = node[left], links.sum(axis=1)
        else:
            nodes, sums = np.concatenate([node[left], node[right]]), np.concatenate([links.sum(axis=1), links.sum(axis=0)])
        return pa.table({"node": pa.array(nodes, pa.int64()), "n_links": pa.array(sums, pa.int64())})

    met = picked.select("text").mapInArrow(sets, "node long, set binary").join(places, "node").withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    met = met.select("comp", F.least("part", "_other").alias("low"), F.greatest("part", "_other").alias("high"), "part", "node", "set")
    return met.groupBy("comp", "low", "high").applyInArrow(run, "node long, n_links long").groupBy("node").agg(F.sum("n_links").alias("n_links"))


def join(documents: DataFrame, per_bucket: int = 8_000_000, count_links: bool = True, block: int = 512, carry: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links (links of its set with different sets) of every document.

    Without count_links there is no n_links, and the work for it is not done; a column of longs may then be carried.
    """
    stats = materialize(sets_of(documents, carry))
    total = stats.agg(F.sum("n_shingles")).first()[0] or 0
    packed = packed_signatures(documents, *dealing(int(total), per_bucket))
    found = materialize(candidates(packed))
    nodes = stats.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n"))
    pairs = found.where("kind = 0").select("x", "y").distinct()
    links = materialize(verified(documents, nodes, materialize(plausible(pairs, nodes))))
    comps = components(links)
    wide = found.where("kind = 1").select(F.col("x").alias("sig"), F.col("y").alias("node"), "n")
    more = materialize(across(wide, comps, nodes).join(pairs, ["x", "y"], "left_anti"))
    if not more.isEmpty():
        links = materialize(links.unionByName(verified(documents, nodes, more)))
        comps = components(links)
    linked = nodes.join(comps, "node")
    least = linked.groupBy("comp").agg(F.min("rep").alias("component_id"))
    of_node = nodes.join(linked.join(least, "comp").select("node", "component_id"), "node", "left").select("node", F.coalesce("component_id", "rep").alias("component_id"))
    if not count_links:
        return stats.join(of_node, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), *[F.col("carried").alias(carry)] * bool(carry))
    untried = wide.join(comps, "node").groupBy("sig", "comp").agg(F.count("*").alias("_n")).where("_n > 1").select("comp").distinct()
    members = materialize(linked.join(untried, "comp", "left_semi").select("node", "rep", "n", "comp"))
    formed = links.select(F.explode(F.array("x", "y")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    degrees = formed.join(members, "node", "left_anti").unionByName(links_within(documents, members, block))
    of_node = of_node.join(degrees, "node", "left").select("node", "component_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    return stats.join(of_node, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
