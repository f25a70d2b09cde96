import itertools
import sqlite3

import pytest
from pyspark.sql import functions as F

from quillmark.functions.folding import RANGES, fold_ascii, fold_pairs, fold_table, fold_text, fold_unicode, needs_fold
from quillmark.plans.query import parse


def test_table_has_the_known_shape():
    table = fold_table()
    assert len(table) == 1057
    assert len(set(table.values())) == 1035
    assert all(fold_text(c, "unicode") == c for c in table.values())


def test_table_equals_the_tokenizer():
    c = sqlite3.connect(":memory:")
    try:
        c.execute("create virtual table f using fts5(x, tokenize='trigram')")
    except sqlite3.OperationalError:
        pytest.skip("no fts5 here")
    c.execute("create virtual table v using fts5vocab(f, 'instance')")
    for bounds in RANGES.split():
        first, last = (int(x, 16) for x in bounds.split("-"))
        for point in range(first, last + 1):
            c.execute("delete from f")
            c.execute("insert into f values (?)", (chr(point) * 3,))
            got = c.execute("select term from v").fetchall()
            assert not got or got[0][0][0] == fold_table().get(chr(point), chr(point)), hex(point)


def test_spark_folds_as_the_driver(spark):
    words = ["".join(w) for letters in ("Σσς", "Ssſ", "ẞß", "İIiı") for w in itertools.product(letters, repeat=3)] + [fold_pairs()[0]]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", fold_unicode(F.col("w")).alias("u"), fold_ascii(F.col("w")).alias("a")).collect()
    assert len(rows) == 127
    for r in rows:
        assert r.u == fold_text(r.w, "unicode")
        assert r.a == fold_text(r.w, "ascii")


def test_terms_are_deduplicated_under_their_fold():
    assert [t.raw for t in parse("竞价 竞价 情绪")] == ["竞价", "情绪"]
    assert len(parse("ΣΣΣ σσσ ςςς")) == 1
    assert len(parse("AI ai Ai")) == 1
    assert [t.kind for t in parse("αα ΑΑ ααα")] == ["ascii", "ascii", "unicode"]
    assert len(parse("αα ΑΑ")) == 2
    assert parse(" \t") == ()
    assert [t.raw for t in parse("* ? [")] == ["*", "?", "["]


def test_fold_is_skipped_only_where_it_cannot_matter():
    assert not needs_fold("竞价", "ascii")
    assert needs_fold("ai", "ascii")
    assert needs_fold("σσσ", "unicode")
    assert not needs_fold("σσ", "ascii")
