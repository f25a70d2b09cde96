"""Operators on a session, against brute force, with nulls, empties, repeats and clashing columns."""

import array
import collections
import itertools
import json
import math
import random
import re
import time
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from quillmark.llm import bytebpe, chat_format, common, divergence, flac, html_blocks, katz, langid, packing, partenum, url_graph

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, kept string, rank int, bucket int"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def make_docs(spark, rows=None):
    if rows is None:
        r = random.Random(11)
        en = "the of and to a in that is it for with was on be fox river stone house light".split()
        fr = "de la le et les des en un du une que est pour qui renard pierre maison lumière".split()
        rows = [(i, " ".join(r.choice(en if i % 2 else fr) for _ in range(r.randint(30, 90))), "en" if i % 2 else "fr") for i in range(60)]
        for i in range(60, 80):  # near copies
            near = rows[i - 60][1].split()
            near[len(near) // 2] = "changed"
            rows.append((i, " ".join([*near, *["tail"] * (i % 3)]), rows[i - 60][2]))
        rows += [(80, rows[0][1], "fr"), (80, rows[0][1], "fr"), (81, None, "en"), (82, "", None), (83, "one two", "en"), (84, "One\ttwo", "en"), (85, "123 456", "fr"), (None, rows[3][1], None), (86, "the of and to a in that is " * 3000, "en")]
    return spark.createDataFrame([(*r, "s", 1, "n", "k", 7, 8) for r in rows], DOCS)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_jaccard_join_equals_brute_force(spark):
    df = make_docs(spark)
    got = partenum.join(df, per_bucket=2000).collect()
    rows = rows_of(df)
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := words((t or "").lower())) else set() for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    want = collections.Counter((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows))
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert partenum.join(df.limit(0)).collect() == []


@pytest.mark.parametrize("lengths", [(1, 2), (5,), (6,), (4, 5, 6, 8, 9), ()])
def test_jaccard_join_of_short_texts_alone(spark, lengths):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 3, i % 3 + n)), "en") for i, n in enumerate(n for n in lengths for _ in range(4))]
    rows += [(90, "", "en"), (91, None, None)]
    df = make_docs(spark, rows)
    sets = {d: frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := words(t)) else frozenset() for d, t in rows_of(df)}
    like = lambda a, b: bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)
    least = {d: d for d in sets}
    for _ in sets:
        least = {d: min([least[d], *[least[e] for e in sets if like(sets[d], sets[e])]]) for d in sets}
    want = sorted((d, len(sets[d]), least[d], len({s for s in sets.values() if s != sets[d] and like(s, sets[d])})) for d in sets)
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in partenum.join(df).collect()) == want


def test_wide_signatures_lose_no_component(spark):
    r = random.Random(5)
    base = [f"w{r.randint(0, 500)}" for _ in range(120)]
    rows = []
    for i in range(40):
        own = list(base)
        for _ in range(i % 4):
            own[r.randrange(120)] = f"x{r.randint(0, 9999)}"
        rows.append((i, " ".join(own), "en"))
    for i in range(40, 60):  # share half with the group
        rows.append((i, " ".join(base[:60] + [f"y{i}_{j % (40 + i)}" for j in range(60)]), "en"))
    df = make_docs(spark, rows)
    got = {r.doc_id: r.component_id for r in partenum.join(df, per_bucket=500).collect()}
    sets = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, t in rows_of(df) for w in [words(t)]}
    parent = {d: d for d in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if j < i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert got == {d: find(d) for d in sets}


def test_links_of_large_groups_equal_brute_force(spark):
    r = random.Random(7)
    base = [[f"w{r.randint(0, 5000)}" for _ in range(n)] for n in (100, 150, 60)]
    rows = []
    for i in range(70):  # near copies, all similar
        own = list(base[0])
        own[i] = f"x{i}"
        rows.append((i, " ".join(own), "en"))
    for i in range(70, 110):  # similar to some
        rows.append((i, " ".join([*base[1][(i - 70) // 2 :], *[f"z{j}" for j in range((i - 70) % 7)]]), "en"))
    rows += [(110, " ".join(base[2]), "en"), (111, " ".join([*base[2], "tail"]), "en"), (112, rows[3][1], "fr"), (3, rows[3][1], "en"), (None, rows[5][1] + " end", "en"), (None, rows[6][1] + " other", "en"), (113, None, "en")]
    df = make_docs(spark, rows)
    texts = [t for _, t in rows_of(df)]
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in map(words, texts)]
    links = {a: sum(100 * len(a & b) >= 80 * len(a | b) for b in set(sets) if a and b and a != b) for a in set(sets)}
    want = collections.Counter((d, links[s]) for (d, _), s in zip(rows_of(df), sets, strict=True))
    assert max(links.values()) > 60
    for options in ({}, {"block": 9}):
        assert collections.Counter((x.doc_id, x.n_links) for x in partenum.join(df, per_bucket=2000, **options).collect()) == want


@pytest.mark.parametrize(("order", "options"), [(2, {}), (3, {"most_tokens": 400, "per_bucket": 300}), (4, {"per_bucket": 500})])
def test_katz_equals_brute_force_and_is_normalised(spark, order, options, tmp_path):
    df = make_docs(spark).withColumn("text", F.expr("case when length(text) > 300 then concat(text, ' everywhere') else text end"))  # in nearly every text
    path = str(tmp_path / "model")
    got = katz.score(df, order=order, path=path, **options).collect()
    rows = [(d, [*words((t or "").lower()), None]) for d, t in rows_of(df)]
    mod = lambda d: None if d is None else zlib.crc32(str(d).encode()) % 5
    learn = [w for d, w in rows if d is not None and mod(d) != 1]
    grams = lambda w, n: zip(*[(["<s>", *w] if n > 1 else w)[i:] for i in range(n)], strict=False)
    count = {n: collections.Counter(g for w in learn for g in grams(w, n)) for n in range(1, order + 1)}
    d = {n: katz.discounts([sum(v == r for v in c.values()) for r in range(1, 7)]) for n, c in count.items()}
    total, distinct = sum(count[1].values()), len(count[1])
    unknown = 1 - sum(d[1][min(v, 6)] * v for v in count[1].values()) / total
    after = collections.defaultdict(list)
    for n in range(2, order + 1):
        for g in count[n]:
            after[g[:-1]].append(g[-1])
    memory = {}

    def kept(g):
        c = count[len(g)][g]
        return d[len(g)][min(c, 6)] * c / sum(count[len(g)][(*g[:-1], w)] for w in after[g[:-1]])

    def alpha(h):
        if ("weight", h) not in memory:
            memory["weight", h] = (1 - sum(kept((*h, w)) for w in after[h])) / (1 - sum(p((*h[1:], w)) for w in after[h]))
        return memory["weight", h]

    def p(g):
        if len(g) == 1:
            return d[1][min(count[1][g], 6)] * count[1][g] / total if count[1][g] else unknown
        if g not in memory:
            memory[g] = kept(g) if count[len(g)][g] else (alpha(g[:-1]) if after[g[:-1]] else 1) * p(g[1:])
        return memory[g]

    for h in list(after)[:: len(after) // 7]:
        assert sum(p((*h, w)) for (w,) in count[1]) + p((*h, "never seen")) == pytest.approx(1)
    want = collections.defaultdict(list)
    for i, w in rows:
        led = ["<s>", *w]
        score = sum(math.log10(p(tuple(led[max(0, j - order + 1) : j + 1]) if order > 1 else (led[j],))) for j in range(1, len(led)))
        want[i].append((len(w), sum(count[1][x,] > 0 for x in w), sum(math.log10((count[1][x,] + 0.5) / (total + 0.5 * (distinct + 1))) for x in w), score))
    assert len(got) == len(rows)
    for own in want.values():
        own.sort()
    for r in sorted(got, key=lambda r: (r.n_tokens, r.n_known, r.base_score), reverse=True):
        n, known, base, score = want[r.doc_id].pop()
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, mod(r.doc_id) == 1)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
    stored = spark.read.parquet(path).where("kind in ('ngrams', 'weights')").collect()
    for n in range(1, order + 1):
        assert sum(int(common.unpack(r.body)[1].sum()) for r in stored if (r.kind, r.n) == ("ngrams", n)) == sum(count[n].values())
        assert sorted(round(x, 6) for r in stored if (r.kind, r.n) == ("weights", n) for x in common.unpack(r.body)[1].tolist()) == sorted(round(math.log10(alpha(h)), 6) for h in after if len(h) == n - 1 and after[h])


def test_katz_without_learning_or_rows(spark):
    df = make_docs(spark)
    assert katz.score(df.limit(0)).collect() == []
    unread = katz.score(df.where("doc_id is null")).collect()
    assert [(r.score, r.train_tokens, r.n_known) for r in unread] == [(None, 0, 0)]
    long = spark.createDataFrame([(i, "alpha beta gamma " * 400_000) for i in range(2)], "doc_id long, text string")  # 6.8 MB each
    for r in katz.score(long, most_tokens=300_000).collect():
        assert r.n_tokens == 1_200_001


def test_language_id(spark):
    df = make_docs(spark)
    got = langid.query(df).collect()
    assert len(got) == df.count()
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == ("en" if i % 2 else "fr") and not by[i].rejected for i in range(80))
    for i in (81, 82, 85):
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True)
    assert all(0 <= r.score <= 1 for r in got)
    assert langid.query(df.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.query(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def grams_by_hand(text):
    """Counts of hashed letter n-grams, one character at a time."""
    mask, mix, c = (1 << 64) - 1, 0x9E3779B97F4A7C15, [0]
    for x in (text or "").lower():
        if x.isalpha():
            c.append(ord(x))
        elif c[-1]:
            c.append(0)
    c += [0] if c[-1] else []
    found = collections.Counter()
    put = lambda h: found.update([(((h & mask) ^ ((h & mask) >> 29)) * mix & mask) >> 52])
    for i, x in enumerate(c):
        if x:
            put(x * mix)
        if i:
            put((c[i - 1] << 21 | x) * mix + 1)
        if i > 1 and c[i - 1]:
            put((((c[i - 2] << 42) & mask) ^ (c[i - 1] << 21) ^ x) * mix)
    return found if len(c) > 2 else None


def test_language_id_equals_brute_force(spark):
    df = make_docs(spark)
    learned = [(r.doc_id, r.text, r.lang) for r in df.collect() if r.doc_id is not None and r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    seen = [g for _, t, _ in learned if (g := grams_by_hand(t))]
    often = collections.Counter(f for g in seen for f in g)
    idf, cents, langs = langid.fit(df.where("doc_id is not null").where(~langid.held_out(F.col("doc_id"))))
    assert all(idf[f] == pytest.approx(math.log((1 + len(seen)) / (1 + often[f])) + 1) for f in range(langid.FEATURES))
    unit = lambda v: {f: x / math.sqrt(sum(y * y for y in v.values())) for f, x in v.items()}
    for r in langid.query(df).collect():
        texts = {t for d, t in rows_of(df) if d == r.doc_id}
        want = set()
        for t in texts:
            g = grams_by_hand(t)
            v = unit({f: math.sqrt(n) * idf[f] for f, n in g.items()}) if g else {}
            cos = [sum(x * c[f] for f, x in v.items()) for c in cents.astype(float)]
            want.add((langs[cos.index(max(cos))], round(max(cos), 4), max(cos) < 0.2) if g else ("und", 0.0, True))
        assert any((r.lang_pred, r.rejected) == (w[0], w[2]) and abs(r.score - w[1]) < 2e-4 for w in want)


def test_language_sample_is_bounded_by_rows(spark):
    words_ = ["alpha", "beta", "gamma", "delta"]
    rows = [(1, f"{words_[i % 4]} {words_[i // 4 % 4]} {'x' * (i % 50 + 1)}", "en") for i in range(1000)] + [(1, "same text", "en")] * 300 + [(2, "autre texte", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    _, cents, langs = langid.fit(df, per_language=5, k=50)
    assert len(cents) == 6 and sorted(langs) == ["en"] * 5 + ["fr"]


def test_language_id_learns_every_language(spark):
    r = random.Random(3)
    rows, names = [], [f"l{i:02}" for i in range(60)]
    for i, name in enumerate(names):  # each language has letters of its own
        own = [chr(0x4E00 + 20 * i + j) for j in range(20)]
        rows += [(20 * i + j, " ".join("".join(r.choices(own, k=4)) for _ in range(30)), name) for j in range(8)]
    got = {x.doc_id: x for x in langid.query(make_docs(spark, rows)).collect()}
    assert {x.lang_pred for x in got.values()} == set(names)
    assert all(got[d].lang_pred == name for d, _, name in rows)


def test_packing_holds_every_id_once(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    df = make_docs(spark)
    got = packing.pack(df, path).collect()
    own = tokenizers.Tokenizer.from_file(path)
    want = collections.Counter()
    for d, t in rows_of(df):
        ids, start = array.array("I", [*own.encode(t or "", add_special_tokens=False).ids, 2]).tobytes(), 0
        for n in packing.cuts(len(ids) // 4):
            want[d, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), len(ids) // 4] += 1
            start += n
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096
    assert packing.pack(df.limit(0), path).collect() == []


def test_idle_workers_hold_no_tokenizer(spark):
    """Workers outlive their stage by a minute; what they know of words goes before, and is there for the next task of the same stage."""
    path = public_tokenizers.path("word_bpe_49k.json")

    def held(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(packing._made)])], names=["n"])

    packing.pack(make_docs(spark), path).collect()
    time.sleep(6)
    assert {r.n for r in spark.range(0, 8, 1, 8).mapInArrow(held, "n long").collect()} == {0}
    own = packing.tokenizer_of(path)
    packing.leave(path, 0.3)
    assert packing.tokenizer_of(path) is own
    time.sleep(0.6)
    assert packing.tokenizer_of(path) is own
    packing.leave(path, 0.05)
    time.sleep(0.5)
    assert path not in packing._made


def base_figures(text):
    w = words(text)
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = collections.defaultdict(list)
    for i in range(len(w) - 7):
        windows[tuple(w[i : i + 8])].append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_quality_rules(spark):
    junk = " ".join(f"x{i}%%% | ###" for i in range(80))
    rows = [(r.doc_id, r.text, r.lang) for r in make_docs(spark).collect()]
    rows += [(90, junk, "en"), (91, "a b c d e f g h\n" * 9 + "é 😀\x0b", "en"), (92, "a b c d e f g h a b c d e f g h a b c d e f g h i", "fr")]
    df = make_docs(spark, rows)
    got = divergence.judge(df).collect()
    want = collections.Counter((d, *base_figures(t)) for d, t, _ in rows)
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept is False or not r.base_failed
    kept = {r.doc_id for r in got if r.kept}
    assert 90 not in kept and set(range(80)) <= kept
    carried = divergence.judge(df, carry=True)
    assert carried.columns == df.columns and {r.doc_id for r in carried.collect()} == kept
    assert divergence.judge(df.limit(0)).collect() == []


def test_quality_references_are_learned_for_every_language(spark):
    r = random.Random(3)
    vocabulary = {"zh": "情绪周期 弱转强 竞价 龙头 今天 市场 学习 我们", "hi": "यह एक परीक्षण है और हम इसे देखते हैं", "ar": "هذا اختبار في على من إلى عن كتاب", "el": "ο και το να είναι για με του"}
    rows = [(k, " ".join(r.choice(v.split()) for _ in range(60)), lang) for i, (lang, v) in enumerate(vocabulary.items()) for k in range(100 * i, 100 * i + 40)]
    rows += [(900, " ".join(f"x{i}%%% | ###" for i in range(60)), "zh"), (901, " ".join(f"w{i}" for i in range(60)), "rare"), (902, " ".join(f"w{i}" for i in range(60)), None)]
    df = make_docs(spark, rows)
    got = {x.doc_id: x for x in divergence.judge(df).collect()}
    assert [d for d, x in got.items() if not x.kept] == [900]
    assert got[901].char_distance is got[902].char_distance is None and got[0].char_distance is not None  # no reference, no verdict
    lists = divergence.common_words(df, common=3)
    for lang in vocabulary:
        counts = collections.Counter(w for _, t, x in rows if x == lang for w in words(t))
        assert lists[lang] == [w for w, _ in sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:3]]
    assert set(divergence.common_words(df, most_languages=2)) == {"ar", "zh"} or len(divergence.common_words(df, most_languages=2)) == 2


def test_jensen_shannon_distance(spark):
    p, q = [0.5, 0.5, 0.0], [0.1, 0.2, 0.7]
    kl = lambda a, b: sum(x * math.log2(x / y) for x, y in zip(a, b, strict=True) if x)
    m = [(x + y) / 2 for x, y in zip(p, q, strict=True)]
    got = spark.range(1).select(divergence.js_distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, q)))).first()[0]
    assert got == pytest.approx(math.sqrt((kl(p, m) + kl(q, m)) / 2))


def test_digests_of_media_and_ids(spark):
    df = make_docs(spark)
    media = flac.encode_column(df)
    got = flac.features(media).collect()
    assert len(got) == df.count()
    by = {}
    for r in got:
        assert r.payload_bytes % 192 == 0 and r.payload_bytes >= max(192, r.n_bytes)
        by.setdefault(r.payload_sha256, (r.media_sha256, r.feature))
        assert by[r.payload_sha256] == (r.media_sha256, r.feature)
    blocks = flac.pcm_blocks(media).where("doc_id = 5").orderBy("sample_offset").collect()
    text = df.where("doc_id = 5").first().text
    assert b"".join(bytes(b.pcm) for b in blocks) == flac.payload_of(text)
    assert flac.features(flac.encode_column(df.limit(0))).collect() == []
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    texts = {r.doc_id: bytes(r.decoded) for r in bytebpe.decode(bytebpe.encode(df, path), path).collect()}
    assert all(texts[d] == (t or "").encode() for d, t in rows_of(df))
    assert bytebpe.digests(df, path).count() == df.count()


def test_pages(spark):
    rows = [(1, "http://a.com/en/1?x", '<a href="http://good.org/x">'), (2, "HTTP://U.SPAM.net/de/1", ""), (3, "http://link.org/1#t", '<a href=//u.spam.net/de/1> <a href="http://u.spam.net">'), (4, "http://good.org/a", "<a href='https://ok.org/'>"), (5, "http://ok.org/b", None), (6, None, "x"), (7, "http://example.com/en/77", '<a href="http://good.org/x">'), (8, "nothing", None), (9, "http://xcom/en/", None), (9, "http://xcom/en/", None)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in url_graph.judge(df, url_graph.RULES, threshold=0.2).collect()}
    assert url_graph.judge(df, url_graph.RULES).count() == 10
    assert (got[1].rule, got[2].rule, got[7].rule, got[9].rule) == ("com/en/", "net/de/", "example.com/en/7", None)
    assert (got[2].host, got[2].path, got[6].host, got[8].path) == ("u.spam.net", "/de/1", "", "")
    assert [got[i].verdict for i in range(1, 10)] == ["block", "block", "block", "allow", "allow", "allow", "allow", "allow", "allow"]
    assert url_graph.judge(df.limit(0), url_graph.RULES).collect() == []
    texts = html_blocks.extract(df)
    assert texts.count() == 10 and html_blocks.extract(df.limit(0)).collect() == []


def test_a_fitting_rule_decides_on_odd_urls(spark):
    urls = [a + h + p for a in ("http://", "://", "x\n://", "a://b://", "http:/") for h in ("com", ".com", "Example.COM", "u@example.com", "example.com:80", "\u212a.net", "a.b.org", "xcom", "") for p in ("", "/en/", "/EN/", "/en/77", "/de/8\r\n", "/es/?a://b", "?/en/")]

    def rule_of(url):
        rest = url.split("://", 1)[1] if "://" in url else ""
        host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [r for r, _ in url_graph.RULES if (host == (d := r.split("/")[0]) or host.endswith("." + d)) and path.startswith(r[len(d) :])]
        return max(fits, key=len, default=None)

    got = url_graph.judge(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string"), url_graph.RULES).collect()
    assert {r.page_id: r.rule for r in got} == {i: rule_of(u) for i, u in enumerate(urls)} and len(got) == len(urls)
    assert all(r.verdict == dict(url_graph.RULES).get(r.rule, r.verdict) for r in got)


def test_owners_of_shared_suffixes_and_addresses_do_not_answer_for_each_other(spark):
    rules = [("bad.co.uk/", "block"), ("bad.github.io/", "block"), ("7.0.0.1/", "block"), ("www.bad.example.org/", "block")]
    hosts = [f"{n}.{s}" for s in ("co.uk", "github.io", "0.0.1") for n in ("bad", "good0", "good1")] + ["7.0.0.1", "10.0.0.1", "www.bad.example.org", "shop.bad.example.org", *[f"h{i}.net" for i in range(40)]]
    df = spark.createDataFrame([(i, f"http://{h}/x", None) for i, h in enumerate(hosts)], "page_id long, url string, html string")
    blocked = {r.host for r in url_graph.judge(df, rules).collect() if r.verdict == "block"}
    assert blocked == {"bad.co.uk", "bad.github.io", "7.0.0.1", "www.bad.example.org", "shop.bad.example.org"}


def test_lost_mass_returns_to_seeds(spark):
    links = {"a.net": ["z.net"], "b.org": ["a.net", "c.org"], "d.org": ["b.org"], "c.org": ["d.org", "e.org"], "v.example.com": ["c.org", "u.org"]}
    hosts = [*links, "z.net", "e.org", *[f"h{i}.org" for i in range(8)]]
    path = {"z.net": "de/1", "v.example.com": "en/7", "h0.org": "es/1"}
    df = spark.createDataFrame([(i, f"http://{h}/{path.get(h, 'x')}", " ".join(f"<a href='http://{t}/'>" for t in links.get(h, []))) for i, h in enumerate(hosts)], "page_id long, url string, html string")
    seeds = {"trust": {"v.example.com": 1.0}, "distrust": {"z.net": 0.5, "h0.org": 0.5}}
    joined = [*[(a, b) for a in links for b in links[a]], ("v.example.com", "example.com"), ("example.com", "v.example.com")]  # the last two by domain
    edges = {"trust": joined, "distrust": [(b, a) for a, b in joined]}
    want = {}
    for walk, seed in seeds.items():
        every = {*hosts, "u.org", "example.com"}
        out = collections.Counter(a for a, _ in edges[walk])
        score = dict.fromkeys(every, 0.0) | seed
        for _ in range(300):
            lost = sum(v for h, v in score.items() if not out[h])
            new = {h: (0.15 + 0.85 * lost) * seed.get(h, 0) for h in every}
            for a, b in edges[walk]:
                new[b] += 0.85 * score[a] / out[a]
            score = new
        want[walk] = score
    got = {r.host: r for r in url_graph.judge(df, url_graph.RULES).collect()}
    for h in hosts:
        assert (got[h].trust, got[h].distrust) == pytest.approx((want["trust"][h], want["distrust"][h]), abs=1e-3 / len(hosts))
    assert {h for h in hosts if got[h].verdict == "block"} == {"z.net", "h0.org"} | {h for h in hosts if want["distrust"][h] * len(hosts) > 1 and want["distrust"][h] > want["trust"][h]}
    assert got["a.net"].rule is None and got["a.net"].verdict == "block"


def test_chats(spark):
    rows = [
        (1, 0, "assistant", '{"tool_calls":[{"id":"b","name":"respond","arguments":{"text":{"$ref": "a"}}},{"id":"a","name":"x","arguments":{"q":1.50, "o":{"z":null,"b":[true,2]}}}]}'),
        (1, 1, "tool", '{"tool_call_id":"a","content":"42"}'),
        (1, 2, "user", None),
        (2, 0, "user", "{broken"),
        (2, 1, "assistant", "fine"),
        (2, 1, "assistant", "again"),
        (3, 0, "assistant", '{"tool_calls":[{"id":"p","name":"respond","arguments":"{\\"text\\":[{\\"$ref\\": \\"q\\"}],\\"z\\":1}"},{"id":"q","name":"respond","arguments":{"text":{"$ref":"p"}}}]}'),
        (None, None, "user", "x"),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, level string")
    got = {(r.conv_id, r.call_id): r for r in chat_format.format_chat(df, chat_format.SCHEMAS).collect()}
    assert (got[1, "a"].level, got[1, "b"].level, got[3, "p"].level) == (0, 1, -1)
    assert got[1, "a"].canonical == '{"arguments":{"o":{"b":[true,2],"z":null},"q":1.5},"id":"a","name":"x","result":"42"}'
    assert (got[1, "a"].faults, got[1, "turn-2"].faults, got[3, "p"].faults) == ("unknown tool", "invalid text", "invalid text; unknown argument")
    assert (got[2, "turn-0"].n_results, got[2, "turn-0"].canonical) == (2, '{"arguments":{"text":"{broken"},"id":"turn-0","name":"respond","result":"again"}')
    assert len(got) == 7 and chat_format.format_chat(df.limit(0), chat_format.SCHEMAS).collect() == []


def test_levels_of_long_chains_and_cycles(spark):
    chain = {f"c{i}": [f"c{i - 1}"] if i else [] for i in range(13)} | {"fork": ["c11", "c2"], "p": ["q"], "q": ["p"], "hangs": ["c1", "p"], "self": ["self"], "lost": ["nowhere"]}
    calls = [{"id": c, "name": "x", "arguments": {str(i): {"$ref": n} for i, n in enumerate(needs)}} for c, needs in chain.items()]
    rows = [(v, 0, "assistant", json.dumps({"tool_calls": calls[:: 1 if v else -1]})) for v in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {f"c{i}": i for i in range(13)} | {"fork": 12, "p": -1, "q": -1, "hangs": -1, "self": -1, "lost": 1}
    assert {(r.conv_id, r.call_id): r.level for r in chat_format.format_chat(df, {}).collect()} == {(v, c): n for v in range(2) for c, n in want.items()}


def test_arguments_keep_their_types_and_repeated_keys_are_text(spark):
    schemas = {"t": {"n": ("number", None, True), "o": ("object", None, False), "s": ("string", "a+", False)}}
    made = lambda arguments: '{"tool_calls":[{"id":"1","name":"t","arguments":' + arguments + "}]}"
    texts = [made('{"o":{"b":1,"a":2.50},"n":1}'), made('{"n":"1","s":"b"}'), made('{"s":5,"zz":null}'), made('"text"'), made('{"n":1,"n":2}'), made("null")]
    df = spark.createDataFrame([(i, 0, "assistant", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.faults, r.canonical) for r in chat_format.format_chat(df, schemas).collect()}
    assert got == {
        0: ("", '{"arguments":{"n":1,"o":{"a":2.5,"b":1}},"id":"1","name":"t"}'),
        1: ("invalid n; invalid s", '{"arguments":{"n":"1","s":"b"},"id":"1","name":"t"}'),
        2: ("missing n; invalid s; unknown argument", '{"arguments":{"s":5,"zz":null},"id":"1","name":"t"}'),
        3: ("missing n", '{"arguments":{},"id":"1","name":"t"}'),
        4: ("no call", json.dumps({"id": "turn--1", "result": texts[4]}, separators=(",", ":"))),
        5: ("missing n", '{"arguments":{},"id":"1","name":"t"}'),
    }


def test_equal_numbers_have_one_form_and_content_beside_calls_stays(spark):
    equal = [["1", "1.0", "1e0", "10E-1"], ["100", "1e2", "100.0"], ["10000000", "1e7", "1.0E+7"], ["0", "-0", "-0.0", "-0e0", "0e9"], ["0.00001", "1e-5"], ["-1250000000000000000000", "-1.25e21"], ["0.001234", "1.234e-3"], ["1e300", "1.0e300"], ["12345678901234567890123", "12345678901234567890123.0"]]
    made = lambda n: json.dumps({"content": "thinking 1.0", "tool_calls": [{"id": "1.0", "name": "t", "arguments": "@"}]}).replace('"@"', '{"n":[' + n + '],"s":"a\\\\\\"1.0,1.0E7"}')
    rows = [(i, j, "assistant", made(n)) for i, forms in enumerate(equal) for j, n in enumerate(forms)]
    got = chat_format.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), {}).collect()
    calls = collections.defaultdict(set)
    for r in got:
        if r.name:
            calls[r.conv_id].add(r.canonical)
    assert [len(calls[i]) for i in range(len(equal))] == [1] * len(equal)
    for i in range(8):
        read = json.loads(next(iter(calls[i])))
        assert float(read["arguments"]["n"][0]) == float(equal[i][0]) and read["id"] == "1.0" and read["arguments"]["s"] == 'a\\"1.0,1.0E7'
    assert '"n":[100]' in next(iter(calls[1])) and '"n":[0.00001]' in next(iter(calls[4])) and '"n":[0]' in next(iter(calls[3]))
    beside = [(r.conv_id, r.turn, r.faults, r.canonical) for r in got if not r.name]
    assert sorted(beside) == sorted((c, t, "", '{"content":"thinking 1.0","role":"assistant"}') for c, t, *_ in rows)


def test_every_turn_is_accounted_for(spark):
    rows = [
        (1, 0, "system", "be kind"),
        (1, 1, "user", "hello"),
        (1, 2, "assistant", "b"),
        (1, 2, "assistant", "a"),
        (1, 2, "assistant", "a"),
        (1, 3, "tool", '{"tool_call_id":"gone","content":"42"}'),
        (1, 4, None, "who"),
        (1, 5, "assistant", '{"tool_calls":[]}'),
        (None, 1, "assistant", "no conversation"),
        (2, None, "assistant", "no turn"),
    ]
    got = chat_format.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), chat_format.SCHEMAS).collect()
    want = [
        (1, 0, "turn--1", "no call", 1, '{"id":"turn--1","result":"be kind"}'),
        (1, 1, "turn-1", "", 3, '{"arguments":{"text":"hello"},"id":"turn-1","name":"respond","result":"a"}'),
        (1, 2, "turn-1", "surplus result", 3, '{"id":"turn-1","result":"a"}'),
        (1, 2, "turn-1", "surplus result", 3, '{"id":"turn-1","result":"b"}'),
        (1, 3, "gone", "no call", 1, '{"id":"gone","result":"42"}'),
        (1, 4, None, "neither call nor result", 0, '{"content":"who"}'),
        (1, 5, None, "neither call nor result", 0, '{"content":"{\\"tool_calls\\":[]}","role":"assistant"}'),
        (None, 1, "turn-0", "no call", 1, '{"id":"turn-0","result":"no conversation"}'),
        (2, None, None, "neither call nor result", 0, '{"content":"no turn","role":"assistant"}'),
    ]
    assert collections.Counter((r.conv_id, r.turn, r.call_id, r.faults, r.n_results, r.canonical) for r in got) == collections.Counter(want)


def test_near_duplicates_whatever_the_columns_and_lengths(spark):
    df = make_docs(spark, [(1, "one two", "en"), (2, "One two", "en"), (3, "hello", "en"), (4, None, "en"), (4, None, "en")]).withColumn("_kept", F.lit(1)).withColumn("first", F.lit(2)).withColumn("own", F.lit(3))
    got = corpus_pipeline.near_duplicates(spark, df, "")
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == [1, 3, 4]


def test_near_duplicates_tell_rows_of_one_doc_id_apart(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    got = corpus_pipeline.near_duplicates(spark, make_docs(spark, [(1, a, "en"), (7, a, "en"), (7, b, "en"), (7, b, "en")]), "").collect()
    assert sorted(r.text for r in got) == sorted([a, b])


def test_pipeline_of_tables_without_a_word(spark):
    for rows in ([], [(None, None, None), (1, None, "en"), (2, "", None)]):
        docs = make_docs(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "")
        assert docs.collect() == []


def test_pipeline(spark, tmp_path):
    df = make_docs(spark)
    docs, names = df, df.columns
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality rules", "language ID", "n-gram Jaccard join", "packing"]
    for name in list(stage)[:3]:
        docs = stage[name](spark, docs, "")
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == names
    kept = {r.doc_id for r in docs.collect()}
    assert len(kept) > 40 and kept.isdisjoint({80, 81, 82, 85, None})
    assert {r.doc_id for r in stage["packing"](spark, docs, "").collect()} == kept


def test_signatures_meet_alike_in_ranges(spark):
    """A bucket taken in ranges of few signatures gives the same candidates."""
    packed = partenum.packed_signatures(make_docs(spark), 3).cache()
    met = lambda **options: sorted(tuple(r) for r in partenum.candidates(packed, **options).distinct().collect())
    for few, kinds in ((1, {1}), (3, {0})):
        whole = met(few=few, most=1 << 30)
        assert {r[0] for r in whole} >= kinds and met(few=few, most=40) == whole == met(few=few)
    other = partenum.candidates(partenum.packed_signatures(make_docs(spark), 3, 64 - 4), few=1)  # sorted as one number with the owner
    assert {r.y for r in other.collect()} == {r[2] for r in met(few=1)}


def test_packed_signatures_follow_the_documents(spark):
    """Dealt as for five times as many shingles, the same documents ship about as many bytes, and meet in the same similar pairs."""
    r = random.Random(11)
    texts = [" ".join(f"w{r.randrange(3000)}" for _ in range(400)) for _ in range(300)]
    df = make_docs(spark, [(i, t, "en") for i, t in enumerate([*texts, *(t.rsplit(" ", 3)[0] for t in texts[:40])])])
    packed = {bits: partenum.packed_signatures(df.coalesce(1), buckets, bits).cache() for buckets, bits in map(partenum.dealing, (25_000_000, 125_000_000))}
    small, large = (p.agg(F.sum(F.length("body"))).first()[0] for p in packed.values())
    assert large < 1.13 * small
    near = {tuple(sorted(map(partenum.node_of, map(partenum.shingles, (t, t.rsplit(" ", 3)[0]))))) for t in texts[:40]}
    for p in packed.values():
        assert near <= {(x.x, x.y) for x in partenum.candidates(p).where("kind = 0").collect()}


def test_members_of_wide_signatures_meet_whole(spark):
    """In steps of few pairs or in many blocks, members across components meet in the pairs that brute force finds."""
    r = random.Random(3)
    base = [[r.randrange(4) for _ in range(256)] for _ in range(3)]
    nodes = {}
    for i in range(60):
        counts = list(base[i % 3])
        for _ in range(i % 7):
            counts[r.randrange(256)] += 3 * (i % 5)
        nodes[r.randrange(-(1 << 62), 1 << 62)] = (sum(counts), bytes(counts))
    ids = list(nodes)
    comps = {x: min(ids[i % 4 :: 4]) for i, x in enumerate(ids) if i % 4 < 2}
    wide = {1: ids[:45], 2: ids[20:], 3: ids[:4], 4: [x for x in ids if comps.get(x) == min(ids[::4])]}
    want = set()
    for members in wide.values():
        for x, y in itertools.combinations(sorted(members), 2):
            (n, a), (m, b) = nodes[x], nodes[y]
            if comps.get(x, x) != comps.get(y, y) and 100 * min(n, m) >= 80 * max(n, m) and 9 * sum(abs(c - d) for c, d in zip(a, b, strict=True)) <= n + m:
                want.add((x, y))
    frame = lambda rows, columns: spark.createDataFrame(rows, columns)
    args = frame([(s, x, nodes[x][0]) for s, own in wide.items() for x in own], "sig long, node long, n long"), frame(list(comps.items()), "node long, comp long"), frame([(x, bytearray(s)) for x, (_, s) in nodes.items()], "node long, sketch binary")
    assert len(want) > 50
    for options in ({}, {"most": 1}, {"most": 100, "block": 9}):
        assert {tuple(p) for p in partenum.across(*args, **options).collect()} == want
