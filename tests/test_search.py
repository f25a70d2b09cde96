import pytest

from quillmark.operators import analytics, batch, compare, search

SCHEMA = "chunk_id string, source_id string, text string, title string, author string, chunk_type string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[None] * (6 - len(r))) for r in rows], SCHEMA)


@pytest.fixture
def layers(spark):
    return frame(spark, [
        ("c1", "s1", "has apple here", "none", "x", "text"),
        ("c2", "s1", "nothing", "apple apple apple apple", "x", "curated_method"),
        ("c3", "s1", "pear", None, "apple apple", "text"),
        ("c4", "s2", "apple and plums", "t", None, "text"),
        ("c5", "s2", "apple " * 20, "t", None, "text"),
        ("c6", "s2", None, None, None, None),
        ("c7", "s2", "apple", "t", None, "curated_method"),
    ])


def ids(df):
    return [r.chunk_id for r in df.collect()]


def test_layers(layers):
    got = ids(search.search(layers, "apple", 40))
    assert got == ["c5", "c7", "c1", "c4", "c2", "c3"]  # text first, then score: 24, 8, 3, 3, then 11, 4
    assert ids(search.search(layers, "apple plums", 40))[0] == "c4"  # two terms before one, twenty times


def test_limits_are_prefixes_and_partitions_do_not_matter(layers):
    whole = ids(search.search(layers, "apple", 40))
    for n in range(1, 6):
        assert ids(search.search(layers.repartition(n), "apple", n)) == whole[:n]
    assert [r.same for r in analytics.prefix_places(layers, "apple", 2, 5).collect()] == [True, True]


def test_ties_go_by_id(spark):
    rows = [(f"c{i}", "s", "same words", "t", "a", "text") for i in (3, 1, 2, 9, 5)]
    got = search.search(frame(spark, rows).repartition(3), "same", 4).collect()
    assert len({(r.prose_hit, r.term_count, r.score) for r in got}) == 1
    assert [r.chunk_id for r in got] == ["c1", "c2", "c3", "c5"]


def test_short_terms_fold_ascii_only(spark):
    df = frame(spark, [("a", "s", "αα", "AI", "x", "text"), ("b", "s", "AI", "AI", "x", "text"), ("c", "s", "ai", None, None, "text")])
    got = {r.chunk_id: r for r in search.search(df, "AI ΑΑ", 9).collect()}
    assert got["a"].prose_hit == 0 and got["a"].term_count == 1
    assert got["b"].prose_hit == 1 and got["c"].prose_hit == 1


def test_long_terms_fold_by_the_table(spark):
    df = frame(spark, [("a", "s", "ααα", None, None, "text"), ("b", "s", "x", "ΑΑΑ", None, "text"), ("c", "s", "σσσ ςςς", None, None, "text"), ("d", "s", "étion", None, None, "text")])
    assert ids(search.search(df, "ΑΑΑ", 9)) == ["a", "b"]
    assert ids(search.recall(df, "ΣΣΣ")) == ["c"]
    assert ids(search.recall(df, "Étion")) == ["d"]
    assert ids(search.recall(df, "É")) == []


@pytest.mark.parametrize("term", ["*", "?", "**", "[", "%", "_", "a*", "[a]", "\\", "'"])
def test_metacharacters_are_literal(spark, term):
    texts = ["*", "?", "**", "[", "%", "_", "a*b", "[a]", "plain ab", "\\", "it's"]
    df = frame(spark, [(str(i), "s", t, None, None, "text") for i, t in enumerate(texts)])
    assert sorted(ids(search.recall(df, term))) == sorted(str(i) for i, t in enumerate(texts) if term in t)


def test_filters_and_empty_queries(layers):
    assert set(ids(search.recall(layers, "apple", source="s1"))) == {"c1", "c2", "c3"}
    assert ids(search.recall(layers, "apple", author="x")) == ["c1", "c2"]
    assert ids(search.search(layers, "   ", 5)) == []
    assert search.search(layers.limit(0), "apple", 5).collect() == []


def test_batch_equals_single_searches(layers):
    queries = {"a": "apple plums", "b": "pear", "c": "zzz", "d": "x AP"}
    got = batch.batch_search(layers, queries, 5).collect()
    for qid, q in queries.items():
        single = search.search(layers, q, 5).collect()
        assert [(r.chunk_id, r.prose_hit, r.term_count, r.score) for r in sorted((r for r in got if r.qid == qid), key=lambda r: r.position)] == [(r.chunk_id, r.prose_hit, r.term_count, r.score) for r in single]


def test_batch_in_several_passes_and_without_terms(layers):
    queries = {str(i): w for i, w in enumerate(["apple", "pear ap", "le", "PLUMS and", "pp", "e", "zzz"])}
    want = sorted(map(tuple, batch.batch_search(layers, queries, 9).collect()))
    assert sorted(map(tuple, batch.batch_search(layers, queries, 9, per_pass=2).collect())) == want and want
    assert batch.batch_search(layers, {"a": " "}, 9).collect() == []


def test_an_automaton_counts_without_overlaps(spark):
    df = frame(spark, [("c", "s", "aaaaa ababa anan", "aa", None, "text")])
    terms = [("unicode", "aaa"), ("ascii", "aa"), ("unicode", "aba"), ("ascii", "a"), ("unicode", "anan"), ("unicode", "none")]
    got = {terms[r.term][1]: (r.text, r.title, r.author) for r in batch.term_hits(df, terms).collect()}
    assert got == {w: ("aaaaa ababa anan".count(w), "aa".count(w), 0) for w in ("aaa", "aa", "aba", "a", "anan")}


def test_kinds_joined_late_rank_alike_and_no_text_is_shuffled(spark, layers):
    kinds = layers.where("chunk_type is not null").select("chunk_id", "chunk_type")
    plain = layers.drop("chunk_type")
    for q in ("apple", "apple plums", "pe"):
        assert search.search(plain, q, 9, kinds=kinds).collect() == search.search(layers.fillna("text", ["chunk_type"]), q, 9).collect()
    node = search.search(plain, "apple", 9, kinds=kinds)._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().apply(0)
    output = node.children().apply(0).output()  # what meets the kinds, by a shuffle or not
    assert {output.apply(i).name() for i in range(output.size())} == {"chunk_id", "source_id", "title", "author", "prose_hit", "term_count", "_points"}


def test_sources_are_compared_apart(spark, layers):
    got = compare.compare_sources(layers, "apple", 1).collect()
    assert {(r.source_id, r.chunk_id) for r in got} == {("s1", "c1"), ("s2", "c5")}
    sources = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "source_id string")
    found = {r.source_id: (r.found, r.n_hits) for r in compare.evidence(layers, sources, "pear").collect()}
    assert found == {"s1": (True, 1), "s2": (False, 0), "s3": (False, 0)}
    assert compare.expand("the fox") == "the les die fox"


def test_counts(layers):
    assert {r.term: r.hits for r in analytics.recall_counts(layers, ["apple", "zzz"]).collect()} == {"apple": 6, "zzz": 0}
    assert {(r.source_id, r.hits) for r in analytics.hits_by_source(layers, ["apple"]).collect()} == {("s1", 3), ("s2", 3)}
    assert not analytics.set_difference(search.recall(layers, "apple").select("chunk_id"), analytics.substring_union(layers, "apple")).collect()
    assert analytics.precision_at_k(layers, "apple", 4).first().precision == 1.0
    assert analytics.smoke_terms(layers, least=2).collect()[0].gram == "app"
