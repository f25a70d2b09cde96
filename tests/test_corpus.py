import json

from pyspark.sql import functions as F

from quillmark import __main__ as cli
from quillmark.operators import corpus, postings, search, validate
from quillmark.sources import html_chat, registry, sinks
from quillmark.sources import index as stored
from quillmark.streaming import imports

RAW = "source_id string, path string, text string, author string"


def built(spark):
    raw = spark.createDataFrame([("s1", "s1/a", "Title\nfirst\0 line of the text\n\n" + "x" * 1700, "Ann"), ("s2", "s2/b", None, " ")], RAW)
    docs = corpus.documents_of(raw)
    parents = corpus.parents_of(docs)
    return docs, parents, corpus.chunks_of(parents, docs)


def test_build_and_trace(spark):
    docs, parents, chunks = built(spark)
    d = {r.source_id: r for r in docs.collect()}
    assert d["s1"].title == "Title" and "\0" not in d["s1"].text
    assert d["s2"].author == corpus.NO_AUTHOR
    assert [r.text for r in parents.orderBy("ord").collect()][:2] == ["Title", "first line of the text"]
    got = chunks.orderBy("chunk_id").collect()
    assert [len(r.text) for r in got] == [5, 22, 800, 800, 100]
    assert got[1].topics == ["articles"]
    traced = corpus.trace(chunks, parents, docs).collect()
    assert {r.path for r in traced} == {"s1/a"}
    assert validate.all_violations(validate.integrity(chunks), validate.nul_free(chunks, ["text"])).collect() == []


def test_faults_are_found_one_at_a_time(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "source_id string")
    assert validate.id_sets(ids("a"), ids("a"), ids("a")).collect() == []
    assert [r.detail for r in validate.id_sets(ids("a", "b"), ids("a"), ids("a", "b")).collect()] == ["missing in directory"]
    chunks = spark.createDataFrame([("c", "s", "a\0b"), ("c", "s", "x")], "chunk_id string, source_id string, text string")
    assert [r.detail for r in validate.nul_free(chunks, ["text"]).collect()] == ["text=1"]
    assert [r.check for r in validate.integrity(chunks).collect()] == ["integrity"]
    assert validate.fold_version(corpus.index_of(chunks.withColumns({"title": F.lit(None).cast("string"), "author": F.lit("a")}))).collect() == []
    assert [r.detail for r in validate.smoke_length(spark.createDataFrame([("s", "ab"), ("t", "abc")], "source_id string, smoke_query string")).collect()] == ["ab"]


def test_manifest_diff(spark):
    a = spark.createDataFrame([("x", "1"), ("y", "1"), ("z", "1")], "path string, sha256 string")
    b = spark.createDataFrame([("x", "1"), ("y", "2"), ("w", "1")], "path string, sha256 string")
    assert {r.path: r.state for r in validate.manifest_diff(a, b).collect()} == {"x": "unchanged", "y": "changed", "z": "removed", "w": "added"}


def test_registry_and_libraries(spark, tmp_path):
    (tmp_path / "sources.yaml").write_text("sources:\n  - id: s1\n    display_name: 'One'  # first\n    status: approved\n    approved_on: 2024-01-02\n  - id: s2\n    status: draft\n")
    for s in ("s1", "s2"):
        (tmp_path / "lib" / s).mkdir(parents=True)
        (tmp_path / "lib" / s / "documents.jsonl").write_text(json.dumps({"doc_id": f"d-{s}", "source_id": s, "title": "t"}) + "\n")
    sources = registry.registered_sources(spark, str(tmp_path / "sources.yaml"))
    assert {(r.source_id, r.status) for r in sources.collect()} == {("s1", "approved"), ("s2", "draft")}
    docs = registry.libraries(spark, str(tmp_path / "lib"), sources, "documents", registry.DOCUMENTS)
    assert [r.doc_id for r in docs.collect()] == ["d-s1"]
    assert registry.libraries(spark, str(tmp_path / "lib"), sources, "methods", registry.METHODS).collect() == []
    assert {r.source_id for r in registry.directories(spark, str(tmp_path / "lib")).collect()} == {"s1", "s2"}
    manifest = registry.raw_manifest(spark, str(tmp_path / "lib"))
    assert manifest.count() == 2 and registry.preview(manifest, "s1").first().files == 2


def test_index_products_and_runs(spark, tmp_path):
    _, _, chunks = built(spark)
    index = stored.write(str(tmp_path / "index"), chunks)
    assert {r.chunk_id for r in postings.recall(index.index(), "FIRST").collect()} == {r.chunk_id for r in search.recall(chunks, "FIRST").collect()} != set()
    state = sinks.start_run(spark, str(tmp_path / "summary.json"), {"file_count": 1})
    assert json.loads((tmp_path / "summary.json").read_text())["run"]["status"] == "in_progress"
    sinks.write_jsonl(chunks.select("chunk_id", "text"), str(tmp_path / "chunks"))
    assert sum(r.rows for r in sinks.output_hashes(spark, sinks.product(spark, str(tmp_path / "chunks"))).collect()) == 5
    done = sinks.finish_run(spark, str(tmp_path / "summary.json"), state, {"chunks": 5})
    assert json.loads((tmp_path / "summary.json").read_text()) == done and done["run"]["status"] == "success"


def test_imports(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "<p>a&amp;b<script>x</script><p>c  d"), (2, None, None)], "page_id long, url string, html string")
    assert [r.text for r in html_chat.import_html(pages).orderBy("page_id").collect()] == ["a&b\nc d", ""]
    texts = spark.createDataFrame([(r'{"a": "x\u0000y", "b": "\\u0000"}',)], "c string")
    assert texts.select(html_chat.json_nul_count(F.col("c"))).first()[0] == 1
    (tmp_path / "in").mkdir()
    run = lambda: imports.import_stream(spark, str(tmp_path / "in"), str(tmp_path / "idx"), str(tmp_path / "ckpt")).awaitTermination()
    texts = lambda: sorted(r.text for r in imports.imported(spark, str(tmp_path / "idx")).collect())

    def send(name, *rows):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps({"source_id": "s", "path": p, "text": t, "author": "a", "sent_at": at}) for p, t, at in rows))
        run()

    send("a.json", ("p", "Hello there", None), ("q", "Other", None))
    assert texts() == ["Hello there", "Other"]
    send("b.json", ("p", "Hello twice", "2024-01-02T00:00:00"), ("p", "Hello again", "2024-01-03T00:00:00"), ("p", "Hello first", None))
    assert texts() == ["Hello again", "Other"]
    send("c.json", ("p", "", None))  # sent empty: nothing of it stays
    assert texts() == ["Other"]
    index = stored.open_index(spark, str(tmp_path / "idx"))
    assert [r.chunk_id for r in postings.recall(index.index(), "hello").collect()] == []
    before = index.version  # an epoch that is repeated after a crash changes nothing
    batch = spark.createDataFrame([("s", "z", "Late", "a")], "source_id string, path string, text string, author string")
    assert stored.upsert(str(tmp_path / "idx"), batch, mark=("import", index.state["marks"]["import"])).version == before and texts() == ["Other"]


def test_an_index_is_replaced_as_a_whole(spark, tmp_path):
    docs, parents, chunks = built(spark)
    path = str(tmp_path / "index")
    for frame in (chunks.where("ord = 0"), chunks):
        stored.write(path, frame, docs.drop("text"), parents, {"s1": {"attempt_id": "x"}})
    snapshot = stored.open_index(spark, path)
    assert snapshot.table("chunks").count() == chunks.count() and snapshot.version == 1
    meta = snapshot.metadata()
    assert json.loads(meta["rows"]) == {"chunks": 5, "documents": 2, "parents": 3} and json.loads(meta["source_credentials"]) == {"s1": {"attempt_id": "x"}}
    product = str(tmp_path / "product")
    sinks.write_jsonl(chunks.select("chunk_id"), product)
    reader = spark.read.json(sinks.product(spark, product))
    sinks.write_jsonl(chunks.select("chunk_id").limit(2), product)  # one that is reading can end
    assert reader.count() == 5 and spark.read.json(sinks.product(spark, product)).count() == 2
    (tmp_path / "product" / "v-crashed").mkdir()  # a writer that died: CURRENT names the old product
    assert spark.read.json(sinks.product(spark, product)).count() == 2
    sinks.write_jsonl(chunks.select("chunk_id").limit(1), product)
    assert len([p for p in (tmp_path / "product").iterdir() if p.name.startswith("v-")]) == 2


def test_command_line(spark, tmp_path, capsys):
    docs, parents, chunks = built(spark)
    path = str(tmp_path / "index")
    stored.write(path, chunks, docs.drop("text"), parents)
    rows = cli.find(spark, path, "FIRST", 5).collect()
    assert [(r.path, r.parent_ord, r.topics) for r in rows] == [("s1/a", 1, "articles")]
    assert cli.find(spark, path, "FIRST", 5, source="s2").count() == cli.find(spark, path, "FIRST", 5, author="Bob").count() == 0
    cli.main(["query", "first", "--index", path, "--author", "Ann"])
    assert "s1/a#1" in capsys.readouterr().out
