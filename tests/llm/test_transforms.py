"""Fill-in-the-middle, exact deduplication and whitening, against brute force."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmark.llm import exact_dedup, fill_middle, whitening

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, hash string, marked string, size int, row int, digest string, _salt int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "h", "m", 1, 2, "d", 3) for i, t in rows], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fim(doc_id, text, seed=42, percent=50):
    text, u = text or "", UNIT.findall(text or "")
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(u), "plain", None, None, sha(text), sha(text)
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 80 else f"<P>{p}<S>{s}<M>{m}"
    return len(u), "spm" if h[3] % 100 < 80 else "psm", len(p), len(m), sha(out), sha(text)


@pytest.mark.parametrize("percent", [50, 100])
def test_fill_middle_equals_brute_force(spark, percent):
    r = random.Random(5)
    odd = ["", None, " ", "\n\t ", "one", "a  b\n", "<P> x", "x<", "<S", "a <S>b", "\x01\x02a\x02b \x02\x01 b\x01", "\x02", "😀 é x\x0by", "a" * 3000 + " " * 500, "　 wide\xa0", "$0 \\1 $", "w " * 20000]
    rows = [(i, t) for i, t in enumerate(odd * 12)] + [(None, "no id here"), (None, "no id here"), (-5, "less than none"), (3, "again again")]
    rows += [(1000 + i, "".join(r.choice("ab<>PSM \n\x01\x02é😀") for _ in range(r.randint(0, 40)))) for i in range(400)]
    got = fill_middle.digests(fill_middle.transform(documents(spark, rows), percent=percent)).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter((i, *fim(i, t, percent=percent)) for i, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_middle_of_an_empty_table_and_its_parts(spark):
    assert fill_middle.digests(fill_middle.transform(documents(spark, []))).collect() == []
    made = fill_middle.transform(documents(spark, [(i, f"a b c d {i}\n") for i in range(40)]), seed=7, percent=100).collect()
    assert all(r.prefix + r.middle + r.suffix == f"a b c d {r.doc_id}\n" for r in made)
    assert len({(r.prefix, r.form) for r in made}) > 5


def dedup(rows, largest):
    groups = collections.defaultdict(list)
    fold = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    for i, t in rows:
        groups[fold(t)].append(i)
    out = collections.Counter()
    for t, ids in groups.items():
        real = [i for i in ids if i is not None]
        keep = (max if largest else min)(real) if real else None
        for k, i in enumerate(sorted(ids, key=lambda i: i != keep)):
            out[(i, keep, len(ids), k == 0, sha(t))] += 1
    return out


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("most_broadcast", [0, 1_000_000])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup_equals_brute_force(spark, keep, most_broadcast, weak):
    r = random.Random(9)
    rows = [(i, r.choice(["Copy", "copy", "CoPÉ", "copé", "copÉ", "", None, "x y", "İ", "i̇"])) for i in range(300)]
    rows += [(i, "a hot text, THE SAME") for i in range(300, 500)] + [(i, f"alone {i}") for i in range(500, 560)]
    rows += [(7, "repeated row")] * 5 + [(None, "repeated row"), (None, "none has an id"), (None, "none has an id"), (-(2**63), "ends"), (2**63 - 1, "Ends"), (9000, "long " * 40000), (9001, "LONG " * 40000)]
    hash_of = (lambda d: F.substring(d, 1, 0)) if weak else exact_dedup.content_hash
    got = exact_dedup.judge(documents(spark, rows).repartition(5), keep, hash_of=hash_of, most_broadcast=most_broadcast).collect()
    assert collections.Counter((x.doc_id, x.keep_id, x.group_size, x.kept, x.text_sha256) for x in got) == dedup(rows, keep == "largest")


def test_exact_dedup_of_empty_tables_and_bad_parameters(spark):
    assert exact_dedup.judge(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        exact_dedup.judge(documents(spark, []), keep="first")


def test_a_hash_with_two_texts_is_told_from_one_with_copies(spark):
    texts = spark.createDataFrame([(b"a", "x"), (b"a", "x"), (b"b", "x"), (b"b", "y"), (b"c", "z")], "hash binary, text string")
    assert [bytes(r.hash) for r in exact_dedup.differing(texts).collect()] == [b"b"]


def test_limb_products_are_exact():
    r = random.Random(3)
    for bits in (5, 19, 20, 21, 45, 61, 90):
        y = np.array([[r.randint(-(2**bits), 2**bits) for _ in range(6)] for _ in range(50)], object if bits > 61 else np.int64)
        sums = whitening.Places()
        for _ in range(70):
            sums.add(whitening.products(y))
        want = 70 * (y.astype(object).T @ y.astype(object))
        assert sums.values(0, 21) == want[np.triu_indices(6)].tolist()
        assert sum(d * 10 ** (18 * i) for i, d in enumerate(whitening.digits_of(int(want[0, 1])))) == want[0, 1]
    full = np.full((whitening.BLOCK_ROWS, 2), 2**40 - 1)
    assert set(map(int, sum(p.astype(object) << (20 * i) for i, p in enumerate(whitening.products(full))))) == {whitening.BLOCK_ROWS * (2**40 - 1) ** 2}
    with pytest.raises(ValueError):
        whitening.products(np.zeros((whitening.BLOCK_ROWS + 1, 2), np.int64))


def check_whitened(got, rows):
    x = {i: [max(-(2**62), min(2**62, math.floor(64 * np.float64(c)))) + 1_000_000 for c in v] for i, v in rows}
    n, m = len(x), np.array(list(x.values()), object)
    total = m.sum(axis=0)
    y = n * m - total
    v = np.array([[int(c) / n**3 for c in row] for row in y.T @ y])
    assert {r.vec_id: r.deviation for r in got if r.component == 1} == {i: (s if (s := int((d * d).sum())) < 2**63 else None) for i, d in zip(x, y, strict=True)}
    values = np.linalg.eigvalsh(v)[::-1]
    k = max(r.component for r in got)
    w = np.zeros((n, k))
    at = {i: j for j, i in enumerate(x)}
    for r in got:
        w[at[r.vec_id], r.component - 1] = np.nan if r.whitened is None else r.whitened
        assert r.n == n and abs(r.explained - values[r.component - 1] / np.trace(v)) <= 1e-9
    good = ~np.isnan(w[0])
    w = w[:, good]
    assert np.abs(w.T @ w / n - np.eye(w.shape[1])).max() < 1e-9 and got[0].identity_error < 1e-9
    # Each column is a unit vector's projection: undone, it gives an eigenvector of the covariance.
    u = np.linalg.lstsq((y / n).astype(float), w * np.sqrt(values[:k][good]), rcond=None)[0]
    assert np.abs(v @ u - u * values[:k][good]).max() < 1e-6 * values[0]
    return good


def test_whitening_equals_exact_covariance(spark):
    r = np.random.default_rng(2)
    base = r.normal(size=(300, 40)) @ r.normal(size=(40, 40)) * 0.1 + 3
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    bad = [(1000, None), (1001, [1.0] * 39 + [None]), (1002, [math.nan] * 40), (1003, [1.0] * 39 + [math.inf]), (1004, [])]
    df = spark.createDataFrame([(i, v, "l", 1, 2) for i, v in rows + bad], "vec_id long, embedding array<float>, dims string, at int, n int").repartition(7)
    got = whitening.components(df).collect()
    assert len(got) == 300 * 32 and check_whitened(got, rows).all()
    offset = [(i, [c * 1e-2 + 1e9 for c in v[:5]]) for i, v in rows[:60]]  # the spread is far below float64's rounding of squares
    got = whitening.components(spark.createDataFrame(offset, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 60 * 5
    check_whitened(got, offset)


def test_whitening_of_degenerate_tables(spark):
    make = lambda rows: whitening.components(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert make([]) == [] and make([(1, None)]) == []
    one = make([(1, [0.5, -0.5])])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, 0.0, 0.0), (2, 1, 0, None, 0.0, 0.0)]
    flat = [(i, [i * 1.0, i * 2.0, 7.0]) for i in range(20)]  # one dimension of variance
    assert check_whitened(make(flat), flat).tolist() == [True, False, False]
    mixed = make([(i, [i * 1.0, (i * i) % 7 * 1.0]) for i in range(9)] + [(i, [i * 1.0]) for i in range(5)] + [(None, [4.0]), (3, [3.0])])
    assert {(r.n, r.component) for r in mixed} == {(9, 1), (9, 2), (7, 1)} and sum(r.vec_id is None for r in mixed) == 1
    huge = [(i, [s * 1e300, 1.0 * i]) for i, s in enumerate((1, -1, 1, -1, 0))]
    got = make(huge)
    assert all(r.deviation is None for r in got if r.component == 1 and r.vec_id < 4)
    check_whitened(got, huge)
