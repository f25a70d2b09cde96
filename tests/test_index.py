"""The stored index: postings against scans, versions, writers and readers at once, and changes against rebuilds."""

import json
import random
import re
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmark.operators import batch, corpus, postings, search
from quillmark.sources import index

SCHEMA = "chunk_id string, source_id string, text string, title string, author string, chunk_type string"
RAW = "source_id string, path string, text string, author string"


def chunks_of(spark, n=500, seed=4):
    r = random.Random(seed)
    words = "aa aaa aaaa ab aba abab ananas anan the THE tHe ion tion étion ÉTION Σσς ςσ AI ai x * [ ? %_ 竞价 情绪周期 弱转强 😀😀 e".split()
    text = lambda most: None if r.random() < 0.05 else " ".join(r.choice(words) for _ in range(r.randint(0, most)))
    rows = [(f"c{i:04}", f"s{r.randint(0, 3)}", text(25), text(3), text(1), r.choice(["text", "curated_method", "conflict", None])) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


QUERIES = ["the", "aa", "aaa", "aba", "ananas anan", "É", "étion e", "ΣΣΣ", "AI the 竞价", "* [", "😀", "😀😀", "情绪周期 弱转强", "absent", "absent the", "tion the ab", "x"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    chunks = chunks_of(spark).cache()
    return chunks, index.write(str(tmp_path_factory.mktemp("ix") / "index"), chunks)


KEY = ["chunk_id", "prose_hit", "term_count", "score"]


def keys(df):
    return [tuple(r) for r in df.select(*KEY).collect()]


@pytest.mark.parametrize("query", ["the", "aa", "aaa", "ananas anan", "étion e", "ΣΣΣ", "AI the 竞价", "😀 😀😀", "absent the"])
def test_postings_rank_as_a_scan_does(stored, query):
    chunks, snapshot = stored
    ix = snapshot.index()
    want = keys(search.search(chunks, query, 30))
    assert keys(postings.search(ix, query, 30)) == want
    assert keys(postings.top(ix, query, 30, first=2).rows) == want
    assert sorted(r.chunk_id for r in postings.recall(ix, query).collect()) == sorted(r.chunk_id for r in search.recall(chunks, query).collect())


def test_filters_and_more_columns(stored):
    chunks, snapshot = stored
    for kw in ({"source": "s1"}, {"author": "the"}, {"source": "s2", "author": "x"}, {"source": "none"}):
        want = search.search(chunks, "the ab", 7, **kw).collect()
        for stepwise in (True, False):
            got = search.ordered(index.find(snapshot, "the ab", 7, stepwise=stepwise, **kw)).select(*search.RESULT).collect()
            assert [r[:4] + r[5:] for r in got] == [r[:4] + r[5:] for r in want]
    assert index.find(snapshot, "  ", 5).collect() == []


def broadcasts_chunks(monkeypatch, run):
    """Whether a search sends the chunks of all blocks to each task, by the plans of the joins that name its results."""
    made, named = [], postings._named
    monkeypatch.setattr(postings, "_named", lambda *a: made.append(named(*a)) or made[-1])
    run()
    plans = [d._jdf.queryExecution().sparkPlan().toString() for d in made]
    assert plans and all(" Inner" in p for p in plans)
    return any(re.search(r"BroadcastHashJoin \[block#\d+L\], \[block#\d+L\], Inner", p) for p in plans)


def test_a_search_of_one_source_does_not_broadcast_blocks(stored, monkeypatch):
    assert not broadcasts_chunks(monkeypatch, lambda: index.find(stored[1], "the ab", 7, source="s1"))


def test_a_stepwise_search_shuffles_only_the_blocks_it_looks_at(stored, monkeypatch):
    """Other blocks' chunks are dropped before the join that names the results, as their lists are."""
    made, named = [], postings._named
    monkeypatch.setattr(postings, "_named", lambda *a: made.append(named(*a)) or made[-1])
    found = postings.top(stored[1].index(), "the ab", 7, first=1)
    assert len(made) == 2 and keys(found.rows) == keys(search.search(stored[0], "the ab", 7))
    for d in made:
        plan = d._jdf.queryExecution().sparkPlan().toString()
        assert len(re.findall(r"Join \[block#\d+L\], \[block#\d+L\], LeftSemi", plan)) == 2  # lists and chunks
    assert not broadcasts_chunks(monkeypatch, lambda: index.find(stored[1], "é the en ET", 8))


def test_a_batch_does_not_broadcast_blocks_and_shuffles_what_it_needs_of_them(stored, monkeypatch):
    ix = stored[1].index()
    assert not broadcasts_chunks(monkeypatch, lambda: postings.batch(ix, {"a": "the ab", "b": "é e"}, 5))
    for frame, unread in ((postings.batch(ix, {"a": "the ab"}, 5), ("author", "doc_id")), (postings.recall(ix, "the ab"), ("author", "doc_id", "source_id", "chunk_type"))):
        read = re.findall(r"chunks:array<struct<[^>]*>", frame._jdf.queryExecution().sparkPlan().toString())
        assert read and not any(f"{c}:" in r for c in unread for r in read)


def test_batches_and_counts(stored):
    chunks, snapshot = stored
    queries = {str(i): q for i, q in enumerate(QUERIES)}
    order = lambda df: sorted(map(tuple, df.collect()))
    assert order(postings.batch(snapshot.index(), queries, 5)) == order(batch.batch_search(chunks, queries, 5))
    assert order(postings.batch(snapshot.index(), queries, 2, by_source=True)) == order(batch.batch_search(chunks, queries, 2, by_source=True))
    terms = ["the", "aa", "anan", "ΣΣΣ"]
    got = {(r.term, r.chunk_id): (r.text, r.title, r.author) for r in postings.hits(snapshot.index(), terms).collect()}
    for t in terms:
        (p,) = search.parse(t)
        fold = search.FOLDS[p.kind]
        for r in chunks.select("chunk_id", *[fold(F.coalesce(f, F.lit(""))).alias(f) for f in ("text", "title", "author")]).collect():
            counts = tuple(v.count(p.folded) for v in r[1:])
            assert got.get((t, r.chunk_id), (0, 0, 0)) == counts


def test_a_long_term_reads_its_rarest_grams(spark):
    df = {"abc": 900, "bcd": 5, "cde": 700, "def": 900, "efg": 4, "fgh": 800}
    assert [g for _, g in postings.cover("abcdefgh", df)] == ["abc", "bcd", "efg", "fgh"]  # the ends are needed; two rare ones cost less than the frequent one between them
    df["bcd"], df["def"] = 500, 50
    assert [g for _, g in postings.cover("abcdefgh", df)] == ["abc", "def", "fgh"]
    assert postings.cover("abcx", df) == [] and postings.cover("ab", {"ab": 3}) == [(0, "ab")]
    assert postings.overlaps_itself("anan") and not postings.overlaps_itself("abc")


def test_blocks_below_the_last_result_are_not_read(spark, tmp_path):
    rows = [(f"c{i:05}", "s", "the rest" if i % 3 else "nothing", "t", None, None) for i in range(64 * 40)]
    for i in range(64 * 20, 64 * 20 + 30):
        rows[i] = (f"c{i:05}", "s", "the the étion the", "the", None, None)
    chunks = spark.createDataFrame(rows, SCHEMA)
    ix = index.write(str(tmp_path / "index"), chunks.coalesce(1)).index()
    found = postings.top(ix, "the étion", 10, first=2)
    assert keys(found.rows) == keys(search.search(chunks, "the étion", 10))
    assert found.candidates == 40 and found.evaluated <= 4
    rare = postings.bounds(ix, postings.plan(ix, list(search.parse("étion"))))
    assert rare.count() <= 2  # blocks without a term have no row
    short = postings.counts(ix, postings.plan(ix, list(search.parse("é"))))
    assert short.select("block").distinct().count() <= 2


def raw(spark, texts):
    return spark.createDataFrame([(p.split("/")[0], p, t, "a") for p, t in texts.items()], RAW)


def live(snapshot):
    return sorted((r.chunk_id, r.doc_id, r.text) for r in snapshot.table("chunks").collect())


def rebuilt(spark, texts):
    docs = corpus.documents_of(raw(spark, texts))
    return sorted((r.chunk_id, r.doc_id, r.text) for r in corpus.chunks_of(corpus.parents_of(docs), docs).collect())


def parts(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("part-*")}


def test_an_update_writes_only_what_changed_and_equals_a_rebuild(spark, tmp_path):
    path, texts = str(tmp_path / "index"), {f"s{i % 3}/f{i}": f"Title {i}\nthe body of {i}\n" + "word " * 300 for i in range(30)}
    first, states = index.update(path, raw(spark, texts))
    assert live(first) == rebuilt(spark, texts) and {r.state for r in states.collect()} == {"added"}
    before = parts(tmp_path / "index")
    texts |= {"s1/f4": "Title 4\nanother étion", "s9/new": "new the"}
    del texts["s0/f0"]
    second, states = index.update(path, raw(spark, texts))
    assert {r.path: r.state for r in states.where("state <> 'unchanged'").collect()} == {"s1/f4": "changed", "s9/new": "added", "s0/f0": "removed"}
    after = parts(tmp_path / "index")
    assert all(after[p] == t for p, t in before.items())  # nothing old is written again
    added = spark.read.parquet(*{str(p.parent) for p in after.keys() - before.keys() if "chunks" in str(p)})
    assert {r.path for r in second.table("documents").join(added, "doc_id", "left_semi").collect()} == {"s1/f4", "s9/new"}
    assert live(second) == rebuilt(spark, texts)
    full = index.write(str(tmp_path / "full"), *_built(spark, texts))
    for q in ("the étion", "ti another"):
        assert keys(postings.search(second.index(), q, 50)) == keys(postings.search(full.index(), q, 50)) == keys(postings.top(second.index(), q, 50).rows)
    third, states = index.update(path, raw(spark, texts))
    assert third.version == second.version and {r.state for r in states.collect()} == {"unchanged"}
    packed = index.compact(spark, path)
    assert len(packed.state["segments"]) == 1 and packed.removed() is None and live(packed) == live(second)
    assert sorted(r.path for r in packed.table("documents").collect()) == sorted(texts) and packed.table("parents").count() == second.table("parents").count()
    assert keys(postings.search(packed.index(), "the", 50)) == keys(postings.search(full.index(), "the", 50))


def _built(spark, texts):
    docs = corpus.documents_of(raw(spark, texts))
    parents = corpus.parents_of(docs)
    return corpus.chunks_of(parents, docs), docs.drop("text"), parents


def test_a_reader_keeps_its_version_across_writes(spark, tmp_path):
    path = str(tmp_path / "index")
    reader = index.write(path, chunks_of(spark, 40, 1))
    want, hits = live_ids(reader), keys(postings.search(reader.index(), "the", 40))
    index.write(path, chunks_of(spark, 70, 2))
    index.write(path, chunks_of(spark, 20, 3))
    assert live_ids(reader) == want and keys(postings.search(reader.index(), "the", 40)) == hits
    assert index.open_index(spark, path).version == 2 and live_ids(index.open_index(spark, path, 0)) == want
    gone = index.vacuum(spark, path, keep=2)
    assert [g for g in gone if g.startswith("segments/")] == ["segments/1"] and len(index.versions(spark, path)) == 2
    assert len(live_ids(index.open_index(spark, path))) == 20 and index.vacuum(spark, path, keep=2) == []
    with pytest.raises(FileNotFoundError):
        index.open_index(spark, path, 0)
    with pytest.raises(FileNotFoundError):
        index.open_index(spark, str(tmp_path / "none"))


def live_ids(snapshot):
    return sorted(r.chunk_id for r in snapshot.table("chunks").collect())


def test_one_of_two_writers_wins_and_the_other_knows(spark, tmp_path):
    path = str(tmp_path / "index")
    start = index.write(path, chunks_of(spark, 10), expected=-1)
    index._commit(spark, path, start.state | {"version": 1})
    with pytest.raises(index.Conflict):
        index._commit(spark, path, start.state | {"version": 1})
    with pytest.raises(index.Conflict):
        index.write(path, chunks_of(spark, 5), expected=0)
    assert len(live_ids(index.open_index(spark, path))) == 10
    assert not [p for p in (tmp_path / "index" / "_log").iterdir() if not re.fullmatch(r"\.?\d{20}\.json(\.crc)?", p.name)]


def test_writers_at_once_lose_nothing(spark, tmp_path):
    path, errors = str(tmp_path / "index"), []

    def put(i):
        try:
            index.upsert(path, raw(spark, {f"s/{i}": f"text of {i} the", "s/shared": f"shared by {i}"}))
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=put, args=(i,)) for i in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    snapshot = index.open_index(spark, path)
    texts = sorted(r.text for r in snapshot.table("chunks").collect())
    assert not errors and snapshot.version == 2 and len(snapshot.state["segments"]) == 3
    assert texts[1:] == [f"text of {i} the" for i in range(3)] and texts[0].startswith("shared by ")  # once, by the last
    assert len(keys(postings.search(snapshot.index(), "shared", 9))) == 1


def test_a_segment_that_no_version_names_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "index")
    index.write(path, chunks_of(spark, 10))
    index.write_segment(path, chunks_of(spark, 99))  # a writer that died before its commit
    assert len(live_ids(index.open_index(spark, path))) == 10
    assert json.loads(index.open_index(spark, path).metadata()["rows"])["chunks"] == 10
    assert len(live_ids(index.write(path, chunks_of(spark, 12)))) == 12
    assert index.vacuum(spark, path, keep=1) == ["_log/00000000000000000000.json", "segments/1", "segments/2"]


def test_positions_take_few_bytes_and_no_shuffle(spark, tmp_path):
    r = random.Random(8)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(800)]
    rows = [(f"c{i:04}", "s", " ".join(r.choice(words) for _ in range(400)), "t", "a", "text") for i in range(300)]
    chars, chunks = sum(len(row[2]) for row in rows), spark.createDataFrame(rows, SCHEMA)
    shuffled = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = shuffled()
    snapshot = index.write(str(tmp_path / "index"), chunks)
    assert shuffled() - before < 2 * chars
    assert sum(p.stat().st_size for p in (tmp_path / "index").rglob("postings/bucket=*/part-*")) < 3 * chars
    assert keys(postings.search(snapshot.index(), f"{words[0]} {words[1][:2]}", 300)) == keys(search.search(chunks, f"{words[0]} {words[1][:2]}", 300))


def test_packed_numbers_come_back():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**34 - 1, 2**61, 5, 0, 300], np.int64)
    starts = np.array([0, 4, 5, 9])
    packed = postings._packed(values, starts)
    assert [len(x) for x in packed.to_pylist()] == [5, 2, 18, 3]
    for a, b in ((0, 4), (1, 3), (2, 2)):
        got, n = postings._unpacked(packed.slice(a, b - a))
        ends = [*starts, len(values)]
        assert got.tolist() == values[ends[a] : ends[b]].tolist() and n.tolist() == [ends[i + 1] - ends[i] for i in range(a, b)]
    assert postings._unpacked(postings._packed(values[:0], np.zeros(3, np.int64)))[1].tolist() == [0, 0, 0]


def test_blocks_cut_by_a_task_keep_their_lists(spark):
    chunks = chunks_of(spark, 200, 6).where("text is not null")
    placed = postings.placed(chunks.coalesce(1)).cache()
    terms = {r.chunk_id: (r.block, r.place) for r in placed.collect()}
    small = postings.build(placed, most_chars=150).withColumn("bucket", postings.bucket_of(F.col("gram"))).cache()
    grams = small.groupBy("bucket", "gram").agg(F.sum("n").alias("df"), F.sum("n_blocks").alias("n_blocks"))
    ix = postings.Index(small, grams, postings.blocks_of(placed))
    assert small.groupBy("gram", "unit").count().where("count > 1").count() and len(set(terms.values())) == len(terms)
    for q in ("the ab", "anan x", "étion e"):
        assert keys(postings.search(ix, q, 200)) == keys(search.search(chunks, q, 200)) == keys(postings.top(ix, q, 200, first=1).rows)


def test_a_repeated_title_is_listed_once(spark, tmp_path):
    """As many lists as for one chunk a document, and the same results; runs end with a block's unit, a document and an empty title."""
    r = random.Random(3)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(300)]
    titles = [" ".join(r.choice([*words, "aaaa aaa"]) for _ in range(30)) for _ in range(40)]
    rows = [(f"c{i:04}", "s", words[i % 300] if i % 9 else None, titles[i // 60] if i % 150 else None, titles[i // 700][:20], "text") for i in range(2400)]
    chunks = spark.createDataFrame(rows, SCHEMA)
    snapshot = index.write(str(tmp_path / "index"), chunks)
    lists = snapshot._raw("postings").agg(sum(F.sum(F.octet_length(c)) for c in ("cells", "sizes", "runs", "positions"))).first()[0]
    assert lists < 0.4 * sum(len(row[3] or "") for row in rows)
    for query in ("aa", "aaa", "aaaa", "e", titles[7][:9], f"{words[0]} {words[1][:2]}"):
        assert keys(postings.search(snapshot.index(), query, 3000)) == keys(search.search(chunks, query, 3000))
        assert keys(postings.top(snapshot.index(), query, 25, first=2).rows) == keys(search.search(chunks, query, 25))
    placed = postings.placed(chunks.coalesce(1)).cache()
    df = lambda most: sorted(tuple(x) for x in postings.build(placed, most).groupBy("gram").agg(F.sum("n")).collect())
    brute = {w: sum(w in (row[2] or "") or w in (row[3] or "") or w in row[4] for row in rows) for w in ("e", "aa", "the", "aaa")}
    found = dict(df(1_000_000))
    assert {w: found.get(w, 0) for w in brute} == brute and dict(df(70_000)).keys() == found.keys()
