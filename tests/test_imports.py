"""PDF text layers and the walk of parsed JSON."""

import json
import zlib

from pyspark.sql import functions as F

from quillmark.sources import json_walk, library, pdf, sinks

MAP = b"begincmap 1 begincodespacerange <00> <FF> endcodespacerange 2 beginbfchar <01> <4E2D> <02> <D83DDE00> endbfchar 2 beginbfrange <20> <7E> <0020> <80> <81> [<00E9> <00660066>] endbfrange endcmap"


def stream(number, body, extra=b"", deflate=True):
    held = zlib.compress(body) if deflate else body
    how = b"/Filter /FlateDecode " if deflate else b""
    return b"%d 0 obj << %s%s/Length %d >>\nstream\r\n%s\nendstream endobj\n" % (number, how, extra, len(held), held)


def pdf_of(contents, inner=False):
    """A file with a page per content; its page objects in an object stream if ``inner``."""
    n = len(contents)
    kids = b" ".join(b"%d 0 R" % (10 + i) for i in range(n))
    objects = [(1, b"<</Type/Catalog/Pages 2 0 R>>"), (2, b"<</Type/Pages/Count %d/Kids[%s]/Resources<</Font<</F1 3 0 R>>>>>>" % (n, kids)), (3, b"<</Type/Font/ToUnicode 4 0 R>>")]
    objects += [(10 + i, b"<< /Type /Page /Parent 2 0 R /Contents [%d 0 R] >>" % (50 + i)) for i in range(n)]
    out = b"%PDF-1.5\n" + stream(4, MAP) + b"".join(stream(50 + i, c) for i, c in enumerate(contents))
    if not inner:
        return out + b"".join(b"%d 0 obj\n%s\nendobj\n" % o for o in objects) + b"trailer <</Root 1 0 R>>"
    heads, at = [], 0
    for number, body in objects:
        heads.append(b"%d %d" % (number, at))
        at += len(body) + 1
    head = b" ".join(heads) + b" "
    return out + stream(90, head + b" ".join(b for _, b in objects), b"/Type /ObjStm /N %d /First %d " % (len(objects), len(head)))


ONE = rb"BT /F1 9 Tf 1 0 0 1 0 700 Tm (a\(b\)\\ \101) Tj 0 -12 Td [(wo) 20 (rd) -300 (next)] TJ T* <0102 80> Tj <81> ' ET BT 1 0 0 1 0 10 Tm (last\
line) Tj ET"
WANT = "a(b)\\ A\nword next\n中😀é\nff\nlastline"


def test_pages_by_fonts_maps_and_object_streams():
    for inner in (False, True):
        assert pdf.parse(pdf_of([ONE, b"", b"BT /F1 9 Tf (endobj stream) Tj ET"], inner)) == [(1, WANT, None), (2, "", None), (3, "endobj stream", None)]


def test_broken_files_have_faults():
    whole = pdf_of([ONE])
    assert [pdf.parse(c) for c in (None, b"", b"\x00\xff" * 50)] == [[(0, "", "no pages")]] * 3
    assert pdf.parse(whole + b"trailer << /Encrypt 7 0 R >>") == [(0, "", "encrypted")]
    assert pdf.parse(whole.replace(b"/FlateDecode", b"/XxxxxDecode"))[0][2].startswith("broken")
    cycle = b"1 0 obj <</Type/Catalog/Pages 2 0 R>> endobj 2 0 obj <</Type/Pages/Kids[2 0 R]>> endobj"
    assert pdf.parse(cycle) == [(0, "", "no pages")]
    for cut in range(0, len(whole), 7):  # whatever is left, it ends without a crash
        assert pdf.parse(whole[:cut])
    deep = b"1 0 obj " + b"[" * 20000 + b"]" * 20000 + b" endobj"
    assert pdf.parse(deep) == [(0, "", "no pages")]


def test_import_and_cache(spark, tmp_path):
    raw, cache = tmp_path / "s1" / "raw", str(tmp_path / "cache")
    (raw / "sub").mkdir(parents=True)
    (raw / "a.pdf").write_bytes(pdf_of([ONE, b"BT (nul\x00 here) Tj ET"]))
    (raw / "sub" / "b.pdf").write_bytes(pdf_of([ONE, b"BT (nul\x00 here) Tj ET"]))  # a copy
    (raw / "note.txt").write_text("no PDF")
    read = lambda c=None: sorted((r.path.rsplit("/", 1)[1], r.page, r.text) for r in pdf.import_pdf(spark, str(raw), c).collect())
    want = [(f, p, t) for f in ("a.pdf", "b.pdf") for p, t in ((1, WANT), (2, "nul\0 here"))]
    assert read() == want == read(cache)
    assert spark.read.parquet(cache).count() == 2
    (raw / "c.pdf").write_bytes(pdf_of([b"BT (new) Tj ET"], True))
    assert read(cache) == [*want, ("c.pdf", 1, "new")] and spark.read.parquet(cache).count() == 3
    texts = pdf.texts_of(pdf.import_pdf(spark, str(raw), cache), "s1").collect()
    assert len(texts) == 5 and not any("\0" in r.text for r in texts)
    done = library.import_source(spark, str(tmp_path), "s1", library.pdf_texts)
    assert done["run"]["status"] == "success"
    documents = spark.read.json(sinks.product(spark, str(tmp_path / "s1" / "documents.jsonl"))).collect()
    assert len(documents) == 5 and {d.path.rsplit("#", 1)[1] for d in documents} == {"1", "2"}


def leaves(value, path="$"):
    """The same walk, in plain Python."""
    named = lambda k: k if k.isidentifier() and k.isascii() else json.dumps(k, ensure_ascii=False)
    inside = [(f"{path}.{named(k)}", v) for k, v in value.items()] if isinstance(value, dict) else [(f"{path}[{i}]", v) for i, v in enumerate(value)] if isinstance(value, list) else []
    return [x for p, v in inside for x in leaves(v, p)] if inside else [(path, value)]


def test_walk_equals_plain_python(spark):
    deep = []
    for i in range(12):
        deep = [deep, {"k": i}] if i % 2 else {"a b": deep, "[{": "]}\"\\"}
    values = [deep, {"a": {"b": [1, "x\0y\0", {}]}, "c.d": None, "k\0": [[2.5, "\0"]]}, 7, [], "\0", {"": True}]
    rows = [(i, json.dumps(v), "clash") for i, v in enumerate(values)] + [(90, None, ""), (91, "{broken", ""), (0, json.dumps(deep), "")]
    df = spark.createDataFrame(rows, "id long, j string, path string")
    got = sorted((r.id, r.path, json.dumps(json.loads(r.value))) for r in json_walk.leaves(df, "j", ["id"]).collect())
    assert got == sorted((i, p, json.dumps(v)) for i, value in [*enumerate(values), (0, deep)] for p, v in leaves(value))
    nuls = {(r.id, r.path, r.kind, r.position) for r in json_walk.nuls(df, "j", ["id"]).collect()}
    assert nuls == {(1, "$.a.b[1]", "value", 2), (1, "$.a.b[1]", "value", 4), (1, '$."k\\u0000"', "key", 2), (1, '$."k\\u0000"[0][1]', "value", 1), (4, "$", "value", 1)}
    assert json_walk.leaves(df.limit(0), "j", ["id"]).collect() == []
    plan = json_walk.leaves(df, "j", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert df.select(F.max(json_walk.depth_of(F.col("j")))).first()[0] == 13
