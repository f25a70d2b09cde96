"""Media columns: FLAC, mono, 8 bits a sample, in frames of 192 samples.

Many frames are coded and decoded side by side as rows of numpy arrays: predictors, Rice codes and
checksums advance one sample (or byte) of every frame at a time. The encoder takes for each frame
the cheapest of fixed predictors of order 0 to 2 and a quantised linear predictor of order 2. The
decoder finds frames by sync code, number and header checksum, verifies each frame's CRC-16 and the
stream's MD5, undoes Rice codes and predictors, and gives PCM with the offset of each frame's first
sample and byte, so a reader can seek.

Defined cases: a null text counts as empty, whose payload is 192 spaces. Repeated rows are stored
one by one, equal texts to equal bytes; of predictors as cheap the first is taken. Long texts are stored whole, in as many frames as they need. A damaged stream raises ValueError. An empty table gives an
empty result. Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillmark.llm.bytebpe import slices

BLOCK, RATE, PRECISION, SHIFT = 192, 8000, 10, 8
HEAD = bytes([0xFF, 0xF8, 0x10, 0x02])  # sync, 192 samples, mono, 8 bits
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, frames long"


def _crc_table(poly: int, width: int) -> np.ndarray:
    rows, top, mask = [], 1 << (width - 1), (1 << width) - 1
    for x in range(256):
        x <<= width - 8
        for _ in range(8):
            x = (x << 1 ^ poly if x & top else x << 1) & mask
        rows.append(x)
    return np.array(rows, np.uint32)


CRC8, CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)


def _crc(data: np.ndarray, start: np.ndarray, length: np.ndarray, table: np.ndarray, width: int) -> np.ndarray:
    """Checksum of each run of data, all runs a byte at a time."""
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    crc, mask = np.zeros(len(start), np.uint32), np.uint32((1 << width) - 1)
    alive = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), "left")
    for i, n in enumerate(alive):
        c = crc[:n]
        crc[:n] = ((c << np.uint32(8)) & mask) ^ table[(c >> np.uint32(width - 8)) ^ data[start[:n] + i]]
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _coded_numbers(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frame numbers in the extended UTF-8 of the format: bytes [frames, 6] and how many."""
    size = 1 + np.searchsorted([1 << 7, 1 << 11, 1 << 16, 1 << 21, 1 << 26], n, "right")
    out = np.zeros((len(n), 6), np.uint8)
    for s in range(1, 7):
        r = np.flatnonzero(size == s)
        out[r, 0] = n[r] if s == 1 else (n[r] >> (6 * (s - 1))) | (0xFF00 >> s & 0xFF)
        for i in range(1, s):
            out[r, i] = 0x80 | (n[r] >> (6 * (s - 1 - i)) & 0x3F)
    return out, size


def _residuals(x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Residuals of the four predictors, and the quantised coefficients of the last."""
    d1, d2 = np.diff(x, axis=1, prepend=0), np.diff(x, n=2, axis=1, prepend=np.zeros((len(x), 2), x.dtype))
    f = x.astype(np.float64)
    r0, r1, r2 = ((f[:, : BLOCK - lag] * f[:, lag:]).sum(axis=1) for lag in range(3))
    det = r0 * r0 - r1 * r1
    ok = det > 1e-9
    det = np.where(ok, det, 1)
    c = np.stack([np.where(ok, r1 * (r0 - r2) / det, 0), np.where(ok, (r0 * r2 - r1 * r1) / det, 0)], axis=1)
    c = np.clip(np.rint(c * (1 << SHIFT)), -(1 << (PRECISION - 1)), (1 << (PRECISION - 1)) - 1).astype(np.int32)
    lpc = x.copy()
    lpc[:, 2:] -= (c[:, :1] * x[:, 1:-1] + c[:, 1:] * x[:, :-2]) >> SHIFT
    return [x, d1, d2, lpc], c


def encode(payloads: list[bytes]) -> list[bytes]:
    """FLAC streams of payloads, each a positive multiple of 192 bytes long."""
    if not payloads:
        return []
    raw = np.frombuffer(b"".join(payloads), np.uint8)
    x = (raw.astype(np.int32) - 128).reshape(-1, BLOCK)
    counts = np.array([len(p) // BLOCK for p in payloads])
    first = np.cumsum(counts) - counts
    frames = len(x)
    options, coefs = _residuals(x)
    orders = np.array([0, 1, 2, 2])
    extra = np.array([0, 0, 0, 9 + 2 * PRECISION])
    bits, params, folded = [], [], []
    for r, order, more in zip(options, orders, extra, strict=True):
        u = (r << 1) ^ (r >> 31)
        body = u[:, order:]
        k = np.clip(np.log2(np.maximum(body.mean(axis=1) * 0.7, 1)).astype(np.int32), 0, 14)
        bits.append((body >> k[:, None]).sum(axis=1) + (BLOCK - order) * (1 + k) + 8 * order + more)
        params.append(k)
        folded.append(u)
    pick, rows = np.argmin(bits, axis=0), np.arange(frames)
    k, order = np.array(params)[pick, rows].astype(np.int64), orders[pick]
    u = np.empty_like(x)
    for j in range(4):
        u[pick == j] = folded[j][pick == j]
    lpc = pick == 3
    # Fields of a frame: subframe header, warm-up, precision and shift, coefficients, residual header, codes.
    values, widths = np.zeros((frames, 7 + BLOCK), np.int64), np.zeros((frames, 7 + BLOCK), np.int64)
    values[:, 0], widths[:, 0] = np.where(lpc, 0b100001 << 1, (0b001000 | order) << 1), 8
    for j in range(2):
        values[:, 1 + j], widths[:, 1 + j] = x[:, j] & 0xFF, np.where(order > j, 8, 0)
        values[:, 4 + j], widths[:, 4 + j] = coefs[:, j] & ((1 << PRECISION) - 1), np.where(lpc, PRECISION, 0)
    values[:, 3], widths[:, 3] = (PRECISION - 1) << 5 | SHIFT, np.where(lpc, 9, 0)
    values[:, 6], widths[:, 6] = k, 10
    coded = np.arange(BLOCK) >= order[:, None]
    values[:, 7:] = (1 << k[:, None]) | (u & ((1 << k[:, None]) - 1))
    widths[:, 7:] = np.where(coded, (u >> k[:, None]) + 1 + k[:, None], 0)
    values[widths == 0] = 0
    ends = np.cumsum(widths, axis=1)
    body = (ends[:, -1] + 7) // 8
    numbers, nsize = _coded_numbers(np.arange(frames) - np.repeat(first, counts))
    size = 4 + nsize + 1 + body + 2
    at = np.cumsum(size) - size
    out_bits = np.zeros(int(size.sum()) * 8, np.uint8)
    ends += ((at + 5 + nsize) * 8)[:, None]
    flat, where = values.ravel(), ends.ravel()
    for b in range(int(flat.max()).bit_length()):
        out_bits[where[(flat >> b & 1) == 1] - 1 - b] = 1
    out = np.packbits(out_bits)
    for i, byte in enumerate(HEAD):
        out[at + i] = byte
    for i in range(6):
        has = nsize > i
        out[at[has] + 4 + i] = numbers[has, i]
    out[at + 4 + nsize] = _crc(out, at, 4 + nsize, CRC8, 8)
    crc = _crc(out, at, size - 2, CRC16, 16)
    out[at + size - 2], out[at + size - 1] = crc >> 8, crc & 0xFF
    data, signed, made = out.tobytes(), (raw ^ 0x80).tobytes(), []
    for f, n in zip(first.tolist(), counts.tolist(), strict=True):
        own = size[f : f + n]
        info = BLOCK.to_bytes(2, "big") * 2 + int(own.min()).to_bytes(3, "big") + int(own.max()).to_bytes(3, "big")
        info += (RATE << 44 | 0 << 41 | 7 << 36 | n * BLOCK).to_bytes(8, "big") + hashlib.md5(signed[f * BLOCK : (f + n) * BLOCK]).digest()
        made.append(b"fLaC" + bytes([0x80, 0, 0, 34]) + info + data[at[f] : at[f] + int(own.sum())])
    return made


def _frame_starts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of frame headers whose checksum holds: start, number, size of the number."""
    at = np.flatnonzero((data[:-5] == HEAD[0]) & (data[1:-4] == HEAD[1]) & (data[2:-3] == HEAD[2]) & (data[3:-2] == HEAD[3]))
    lead = data[at + 4]
    size = np.where(lead < 0x80, 1, np.searchsorted([0xE0, 0xF0, 0xF8, 0xFC], lead, "right") + 2)
    ok = at + 4 + size < len(data)
    at, lead, size = at[ok], lead[ok].astype(np.int64), size[ok]
    number = np.where(size == 1, lead, lead & (0x7F >> size))
    for i in range(1, 6):
        number = np.where(size > i, number << 6 | (data[np.minimum(at + 4 + i, len(data) - 1)] & 0x3F), number)
    ok = _crc(data, at, 4 + size, CRC8, 8) == data[at + 4 + size]
    return at[ok], number[ok], size[ok]


def decode(streams: list[bytes]) -> list[tuple[bytes, list[int]]]:
    """Each stream's payload, and the byte offset of each of its frames (frame i starts at sample 192 i)."""
    if not streams:
        return []
    data = np.frombuffer(b"".join(streams) + bytes(16), np.uint8)
    lens = np.array([len(s) for s in streams])
    base = np.cumsum(lens) - lens
    totals = []
    for s in streams:
        if s[:4] != b"fLaC" or s[4] & 0x7F or len(s) < 42:
            raise ValueError("not a stream of this form")
        totals.append(int.from_bytes(s[18:26], "big") & ((1 << 36) - 1))
    counts = np.array(totals) // BLOCK
    at, number, nsize = _frame_starts(data)
    owner = np.searchsorted(base, at, "right") - 1
    wanted, keep = 0, []
    last = -1
    for i, (o, n) in enumerate(zip(owner.tolist(), number.tolist(), strict=True)):
        if o != last:
            last, wanted = o, 0
        if n == wanted:
            keep.append(i)
            wanted += 1
    at, nsize, owner = at[keep], nsize[keep], owner[keep]
    if not np.array_equal(np.bincount(owner, minlength=len(streams)), counts):
        raise ValueError("frames are missing")
    end = np.append(at[1:], 0)
    is_last = np.append(owner[1:] != owner[:-1], True)
    end[is_last] = (base + lens)[owner[is_last]]
    stored = data[end - 2].astype(np.uint32) << 8 | data[end - 1]
    if not np.array_equal(_crc(data, at, end - at - 2, CRC16, 16), stored):
        raise ValueError("a frame's checksum doesn't hold")
    words = np.zeros(len(data) - 8, np.uint64)
    for i in range(8):
        words |= data[i : len(data) - 8 + i].astype(np.uint64) << np.uint64(56 - 8 * i)
    pos = (at + 5 + nsize) * 8

    def read(rows: np.ndarray, width: int) -> np.ndarray:
        p = pos[rows]
        value = (words[p >> 3] << (p & 7).astype(np.uint64)) >> np.uint64(64 - width)
        pos[rows] = p + width
        return value.astype(np.int64)

    frames = len(at)
    every, x = np.arange(frames), np.zeros((frames, BLOCK), np.int64)
    kind = read(every, 8) >> 1
    lpc = kind >= 32
    order = np.where(lpc, kind - 31, kind & 7)
    if not np.all(lpc | ((kind >= 8) & (kind <= 12))):
        raise ValueError("a kind of subframe that this encoder doesn't write")
    for j in range(int(order.max(initial=0))):
        rows = np.flatnonzero(order > j)
        x[rows, j] = (read(rows, 8) ^ 0x80) - 0x80
    rows, coefs, shift = np.flatnonzero(lpc), np.zeros((frames, 32), np.int64), np.zeros(frames, np.int64)
    precision = read(rows, 4) + 1
    shift[rows] = read(rows, 5)
    for j in range(int(order[rows].max(initial=0))):
        for p in np.unique(precision):
            some = rows[(precision == p) & (order[rows] > j)]
            coefs[some, j] = (read(some, int(p)) ^ (1 << (int(p) - 1))) - (1 << (int(p) - 1))
    if np.any(read(every, 6)):
        raise ValueError("a residual coding that this encoder doesn't write")
    k = read(every, 4)
    least = np.zeros(1 << 16, np.int64)  # leading zeros of 16 bits
    least[:] = 16 - np.ceil(np.log2(np.arange(1 << 16) + 1)).astype(np.int64)
    residual = np.zeros((frames, BLOCK), np.int64)
    ku = k.astype(np.uint64)
    some = np.flatnonzero(order == 0)
    for i in range(BLOCK):
        if i <= 32:
            some = np.flatnonzero(order <= i)
        p = pos[some]
        zeros = np.zeros(len(some), np.int64)
        more = np.arange(len(some))
        while len(more):  # sixteen bits of the unary part at a time
            w = words[p[more] >> 3] << (p[more] & 7).astype(np.uint64)
            z = least[(w >> np.uint64(48)).astype(np.int64)]
            zeros[more] += z
            p[more] += z
            more = more[z == 16]
        p += 1
        w = words[p >> 3] << (p & 7).astype(np.uint64)
        ks = ku[some]
        low = np.where(ks > 0, w >> (np.uint64(64) - np.maximum(ks, np.uint64(1))), np.uint64(0)).astype(np.int64)
        u = zeros << k[some] | low
        residual[some, i] = (u >> 1) ^ -(u & 1)
        pos[some] = p + k[some]
    if np.any((pos + 7) // 8 != end - 2):
        raise ValueError("a frame doesn't end where the next one starts")
    for o in range(5):
        rows = np.flatnonzero(~lpc & (order == o))
        if len(rows):
            # The differences of each degree at the end of the warm-up start the running sums.
            run = residual[rows, o:]
            starts = [np.diff(x[rows, :o], n=d, axis=1)[:, -1:] for d in range(o)]
            for d in reversed(range(o)):
                run = np.cumsum(run, axis=1) + starts[d]
            x[rows, o:] = run
    for o in np.unique(order[lpc]).tolist():
        rows = np.flatnonzero(lpc & (order == o))
        c, s = coefs[rows, :o], shift[rows]
        own = x[rows]
        for i in range(o, BLOCK):
            own[:, i] = residual[rows, i] + ((own[:, i - o : i][:, ::-1] * c).sum(axis=1) >> s)
        x[rows] = own
    pcm = (x + 128).astype(np.uint8)
    raw, signed = pcm.tobytes(), (pcm ^ 0x80).tobytes()
    starts, out = np.cumsum(counts) - counts, []
    for i, (f, n) in enumerate(zip(starts.tolist(), counts.tolist(), strict=True)):
        a, b = f * BLOCK, (f + n) * BLOCK
        if hashlib.md5(signed[a:b]).digest() != streams[i][26:42]:
            raise ValueError("the stream's digest doesn't hold")
        out.append((raw[a:b], (at[f : f + n] - base[i]).tolist()))
    return out


class _Bits:
    """A reader of single streams, bit by bit."""

    def __init__(self, data: bytes, at: int):
        self.data, self.at = data, at * 8

    def read(self, n: int) -> int:
        end = self.at + n
        if end > 8 * len(self.data):
            raise ValueError("the stream ends within a frame")
        whole = int.from_bytes(self.data[self.at >> 3 : (end + 7) >> 3], "big")
        self.at = end
        return whole >> (-end % 8) & ((1 << n) - 1)

    def signed(self, n: int) -> int:
        x = self.read(n)
        return x - (1 << n) if n and x >> (n - 1) else x

    def unary(self) -> int:
        n = 0
        while not self.read(1):
            n += 1
        return n


def _subframe(bits: _Bits, size: int, depth: int) -> list[int]:
    head = bits.read(8)
    kind, wasted = head >> 1, bits.unary() + 1 if head & 1 else 0
    depth -= wasted
    if head & 0x80 or not (kind in (0, 1) or 8 <= kind <= 12 or kind >= 32):
        raise ValueError("a reserved kind of subframe")
    if kind == 0:
        return [bits.signed(depth) << wasted] * size
    if kind == 1:
        return [bits.signed(depth) << wasted for _ in range(size)]
    order = kind - 31 if kind >= 32 else kind - 8
    x = [bits.signed(depth) for _ in range(order)]
    if kind >= 32:
        precision = bits.read(4) + 1
        shift = bits.signed(5)
        coefs = [bits.signed(precision) for _ in range(order)]
    else:
        shift, coefs = 0, [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]][order]
    method, parts = bits.read(2), 1 << bits.read(4)
    if method > 1 or size % parts or size // parts < order or shift < 0:
        raise ValueError("a reserved residual coding")
    width = 4 + method
    for part in range(parts):
        k = bits.read(width)
        raw = bits.read(5) if k == (1 << width) - 1 else None
        for _ in range(size // parts - (order if part == 0 else 0)):
            if raw is None:
                u = bits.unary() << k | bits.read(k)
                residual = (u >> 1) ^ -(u & 1)
            else:
                residual = bits.signed(raw)
            x.append(residual + (sum(c * x[-1 - j] for j, c in enumerate(coefs)) >> shift))
    return [v << wasted for v in x]


def decode_any(stream: bytes) -> tuple[int, list[int], list[tuple[int, int]]]:
    """Bits a sample, samples, and (sample offset, byte offset) of each frame of any mono stream, whatever encoder wrote it.

    Frames are parsed one after the other, each from where the one before ends, with both checksums and the digest verified.
    """
    if stream[:4] != b"fLaC":
        raise ValueError("not a stream of this form")
    at, last, info = 4, False, None
    while not last:
        last, kind, size = bool(stream[at] & 0x80), stream[at] & 0x7F, int.from_bytes(stream[at + 1 : at + 4], "big")
        info = stream[at + 4 : at + 4 + size] if kind == 0 else info
        at += 4 + size
    if info is None or len(info) < 34:
        raise ValueError("a stream without its description")
    packed = int.from_bytes(info[10:18], "big")
    channels, depth, total = (packed >> 41 & 7) + 1, (packed >> 36 & 31) + 1, packed & ((1 << 36) - 1)
    if channels != 1:
        raise ValueError("more than one channel")
    data, samples, places = np.frombuffer(stream, np.uint8), [], []
    check = lambda a, b, table, width: int(_crc(data, np.array([a]), np.array([b - a]), table, width)[0])
    while at < len(stream) and (not total or len(samples) < total):
        bits, start = _Bits(stream, at), at
        if bits.read(15) != 0x7FFC:
            raise ValueError("no frame where one should start")
        bits.read(1)
        code, rate, _, deep, _ = bits.read(4), bits.read(4), bits.read(4), bits.read(3), bits.read(1)
        lead = bits.read(8)
        bits.read(8 * max(0, 8 - (lead ^ 0xFF).bit_length() - 1))
        size = bits.read(8) + 1 if code == 6 else bits.read(16) + 1 if code == 7 else 192 if code == 1 else 576 << (code - 2) if 2 <= code <= 5 else 256 << (code - 8) if code >= 8 else 0
        bits.read(8 if rate == 12 else 16 if rate in (13, 14) else 0)
        end = bits.at >> 3
        if not size or bits.read(8) != check(start, end, CRC8, 8):
            raise ValueError("a frame's head doesn't hold")
        own = {1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}.get(deep, depth)
        places.append((len(samples), start))
        samples += _subframe(bits, size, own)
        end = bits.at + 7 >> 3
        bits.at = 8 * end
        if bits.read(16) != check(start, end, CRC16, 16):
            raise ValueError("a frame's checksum doesn't hold")
        at = end + 2
    width = (depth + 7) // 8
    if any(info[18:34]) and hashlib.md5(b"".join(v.to_bytes(width, "little", signed=True) for v in samples)).digest() != info[18:34]:
        raise ValueError("the stream's digest doesn't hold")
    return depth, samples, places


def payload_of(text: str | None) -> bytes:
    """A text's UTF-8, filled with spaces up to a positive multiple of a frame."""
    raw = (text or "").encode()
    return raw + b" " * ((-len(raw)) % BLOCK if raw else BLOCK)


def encode_column(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: each text stored as a FLAC stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in slices(batches, "text", 1_000_000):
            texts = batch["text"].to_pylist()
            sizes = [len((t or "").encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(encode([payload_of(t) for t in texts]), pa.binary())], names=["doc_id", "n_bytes", "media"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def pcm_blocks(media: DataFrame) -> DataFrame:
    """doc_id, sample_offset, byte_offset, pcm: one row per frame, in any order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in slices(batches, "media", 1_000_000):
            rows = [(d, i * BLOCK, at, raw[i * BLOCK : (i + 1) * BLOCK]) for d, (raw, ats) in zip(batch["doc_id"].to_pylist(), decode(batch["media"].to_pylist()), strict=True) for i, at in enumerate(ats)]
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary())], names=["doc_id", "sample_offset", "byte_offset", "pcm"])

    return media.select("doc_id", "media").mapInArrow(run, "doc_id long, sample_offset long, byte_offset long, pcm binary")


def _feature(raw: bytes) -> str:
    x = np.frombuffer(raw, np.uint8).astype(np.int64) - 128
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    return f"sum={int(x.sum())};energy={int((x * x).sum())};peak={int(np.abs(x).max())};crossings={crossings}"


def features(media: DataFrame) -> DataFrame:
    """Digests and features of each stored stream, from what the decoder reads back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in slices(batches, "media", 1_000_000):
            streams = batch["media"].to_pylist()
            read = decode(streams)
            raws = [raw for raw, _ in read]
            longs = lambda values: pa.array(list(values), pa.int64())
            sha = lambda values: pa.array([hashlib.sha256(v).hexdigest() for v in values])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_bytes"], longs(map(len, raws)), sha(raws), longs(zlib.crc32(r[-16:]) for r in raws), longs(map(len, streams)), sha(streams), pa.array(list(map(_feature, raws))), longs(len(ats) for _, ats in read)],
                names=[f.split()[0] for f in FEATURES.split(", ")],
            )

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, FEATURES)
