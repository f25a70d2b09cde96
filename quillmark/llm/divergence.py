"""Distribution divergence: quality verdicts from Jensen-Shannon distances to language references.

A document's character-class histogram and its histogram of common words are compared with the reference of its language.
Both are learned from the table: the common words are the ``common`` most frequent ones of all documents of the language, and
the reference is the mean of the histograms, as shares, of its documents with words enough for the base rules, so that
no long text outweighs the others. A language with fewer than ``least_documents`` of them has no
reference, and its documents no verdict beyond the base rules. So too those of languages beyond the ``most_languages`` with
most documents, and those without a language.

Words are counted on each task before they are shuffled, by language and word, and each task hands on only its first words of a
language. All else is one pass of built-in functions over the text, without a shuffle. Word lists and references are
at most ``most_languages`` rows, so collecting the one and broadcasting the other is of proven size.

Defined cases: a null text counts as empty (no words, base_failed). Repeated rows are judged one by
one. A short text's histogram is noisy, so both limits are wider by an allowance over the root of
its number of words. Words as frequent as one another are taken in order of their characters. A distance equal to its limit keeps. Texts of any
length are read whole. An empty table gives an empty result. Extra columns of the input are dropped (or
carried, whatever their names); only doc_id, text and lang are read. Texts with fewer words than ``min_words_common`` are judged by characters
alone, those with fewer than ``min_words_chars`` by the base rules alone.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.common import NOT_SPACE, SPACE, lower_ascii, materialize, words_of
from quillmark.llm.exact_dedup import fold

#: Frequent function words of some languages, which other operators read; no verdict here depends on them.
COMMON_WORDS = {
    "de": ["der", "die", "das", "und", "in", "den", "von", "zu", "mit", "sich", "ist", "nicht", "ein", "für"],
    "en": ["the", "of", "and", "to", "a", "in", "that", "is", "it", "for", "with", "was", "on", "be"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "por", "un", "para"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui"],
}
#: Character classes as regular expressions; the last bin takes the rest.
CLASSES = [r"\p{Ll}", SPACE, r"\p{Lu}", r"\p{Nd}", r"[.,;:!?'\"()\-]", r"\p{Lo}", r"\p{M}"]
SYMBOLS = "#*$%&|<>"
WINDOW, MIN_WORDS = 8, 20


def _sum(c: Column) -> Column:
    return F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words covered by windows that occur twice or more in the text."""
    n = F.col("n_words")
    df = df.withColumn("_h", F.when(n > WINDOW, F.transform("_words", lambda w: F.xxhash64(w))))
    for step in (1, 2, 4):  # a window's hash from those of its halves
        df = df.withColumn("_h", F.zip_with("_h", F.slice("_h", step + 1, F.size("_words")), lambda a, b: F.xxhash64(a, b)))
    df = df.withColumn("_h", F.slice("_h", 1, (n - (WINDOW - 1)).cast("int")))
    df = df.withColumn("_e", F.when(F.size("_h") > F.size(F.array_distinct("_h")), F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda e, j: F.coalesce(F.get(F.col("_e"), j)["h"] == e["h"], F.lit(False))
    df = df.withColumn("_p", F.sort_array(F.transform(F.filter("_e", lambda e, i: same(e, i - 1) | same(e, i + 1)), lambda e: e["i"])))
    gap = F.transform("_p", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_p"), i + 1) - p, F.lit(WINDOW))))
    return df.withColumn("n_repeat_words", F.coalesce(_sum(gap), F.lit(0).cast("long"))).drop("_h", "_e", "_p")


def common_words(documents: DataFrame, common: int = 16, least_documents: int = 20, most_languages: int = 1000) -> dict[str, list[str]]:
    """The most frequent words, A-Z lower-cased, of each language with enough documents, most frequent first."""
    named = documents.where(F.col("lang").isNotNull())
    sizes = named.groupBy("lang").agg(F.count("*").alias("_n")).where(F.col("_n") >= least_documents).orderBy(F.desc("_n"), "lang").limit(most_languages)
    kept = [r.lang for r in sizes.select("lang").collect()]  # at most ``most_languages``
    words = named.where(F.col("lang").isin(kept)).select("lang", F.explode(words_of(fold(F.col("text")))).alias("word"))
    counts = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
    best = counts.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where(F.col("r") <= common)
    found: dict[str, list[str]] = {}
    for r in sorted(best.collect(), key=lambda r: (r.lang, r.r)):  # ``common`` rows a language
        found.setdefault(r.lang, []).append(r.word)
    return found


def _spellings(word: str) -> list[str]:
    """The word as it is, and with a first letter of A-Z as a capital."""
    return [word, word[0].upper() + word[1:]] if "a" <= word[:1] <= "z" else [word]


def document_statistics(documents: DataFrame, lists: dict[str, list[str]], carry: bool = False) -> DataFrame:
    """The base figures and the two histograms of each document; its whole row too, as _row, to carry it."""
    t = F.coalesce(F.col("text"), F.lit(""))
    row = [F.struct(*[documents[c] for c in documents.columns]).alias("_row")] if carry else []
    df = documents.select("doc_id", "lang", t.alias("_t"), words_of(F.col("text")).alias("_words"), *row)
    df = _repeat_words(df.withColumn("n_words", F.size("_words").cast("long")))
    # Each class is taken out of what the classes before it left, so that only the first sees the whole text.
    left, lengths = F.col("_t"), [F.length("_t").cast("long")]
    for i, pattern in enumerate(CLASSES):
        df = df.withColumn(f"_left{i}", F.regexp_replace(left, pattern + "+", ""))
        left = F.col(f"_left{i}")
        lengths.append(F.length(left).cast("long"))
    spaces = CLASSES.index(SPACE)
    df = df.withColumn("_classes", F.array(*[x - y for x, y in zip(lengths, lengths[1:], strict=False)], lengths[-1]))
    df = df.withColumn("_lines", F.filter(F.split("_t", "\n"), lambda x: x.rlike(NOT_SPACE)))
    symbols = F.length(f"_left{spaces}") - F.length(F.translate(f"_left{spaces}", SYMBOLS, ""))
    known = F.col("lang").isin(*lists) if lists else F.lit(False)
    spelled = sorted({x for words in lists.values() for w in words for x in _spellings(w)})
    if lists:
        by_language = F.from_json(F.lit(json.dumps(lists)), F.lit("map<string,array<string>>"))
        df = df.withColumn("_list", F.when(known, F.element_at(by_language, F.col("lang"))))
        df = df.withColumn("_common", F.when(known, F.transform(F.filter("_words", lambda w: w.isin(*spelled)), lower_ascii)))
    else:
        df = df.withColumns({c: F.lit(None).cast("array<string>") for c in ("_list", "_common")})
    df = df.withColumn("_counts", F.transform("_list", lambda w: (F.size("_common") - F.size(F.array_remove("_common", w))).cast("long")))
    return df.select(
        "doc_id",
        *["_row"] * carry,
        F.when(known, F.col("lang")).alias("ref"),
        "n_words",
        (lengths[0] - F.element_at("_classes", spaces + 1)).alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.col("_classes").alias("char_hist"),
        F.concat("_counts", F.array(F.col("n_words") - _sum(F.col("_counts")))).alias("word_hist"),
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def _total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double"))


def _shares(c: Column) -> Column:
    total = _total(c)
    return F.transform(c, lambda x: F.when(total > 0, x.cast("double") / total).otherwise(F.lit(0.0)))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms given as arrays of shares."""
    term = lambda x, m: F.when((x > 0) & (m > 0), x * F.log2(x / m)).otherwise(F.lit(0.0))
    parts = F.zip_with(p, q, lambda x, y: term(x, (x + y) / 2) + term(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2))


def references(stats: DataFrame, common: int = 16, least_documents: int = 20) -> DataFrame:
    """ref, ref_chars and ref_words of each language with enough documents that the base rules may keep."""
    good = stats.where(F.col("ref").isNotNull() & (F.col("n_words") >= MIN_WORDS)).select("ref", _shares(F.col("char_hist")).alias("ref_chars"), _shares(F.col("word_hist")).alias("ref_words"))
    sums = [F.array(*[F.coalesce(F.sum(F.get(F.col(c), F.lit(i))), F.lit(0.0)) for i in range(n)]).alias(c) for c, n in (("ref_chars", len(CLASSES) + 1), ("ref_words", common + 1))]
    return good.groupBy("ref").agg(*sums, F.count("*").alias("_n")).where(F.col("_n") >= least_documents).drop("_n")


def judge(
    documents: DataFrame,
    max_char_distance: float = 0.2,
    max_word_distance: float = 0.25,
    char_allowance: float = 0.6,
    word_allowance: float = 0.6,
    min_words_chars: int = 20,
    min_words_common: int = 50,
    common: int = 16,
    least_documents: int = 20,
    most_languages: int = 1000,
    carry: bool = False,
) -> DataFrame:
    """One row per document: the base figures, both distances (null under their guard), and kept.

    With ``carry`` the result is the kept documents' own columns. Then the figures are computed
    again rather than written beside a second copy of all texts.
    """
    lists = common_words(documents, common, least_documents, most_languages)
    stats = document_statistics(documents, lists)
    stats = materialize(stats.select("ref", "n_words", "char_hist", "word_hist") if carry else stats)
    refs = materialize(references(stats, common, least_documents))
    df = (document_statistics(documents, lists, True) if carry else stats).join(F.broadcast(refs), "ref", "left")
    chars = F.when((F.col("n_words") >= min_words_chars) & (_total(F.col("ref_chars")) > 0), js_distance(_shares(F.col("char_hist")), _shares(F.col("ref_chars"))))
    words = F.when((F.col("n_words") >= min_words_common) & (_total(F.col("ref_words")) > 0), js_distance(_shares(F.col("word_hist")), _shares(F.col("ref_words"))))
    df = df.withColumn("char_distance", chars).withColumn("word_distance", words)
    root = F.sqrt(F.col("n_words"))
    limits = {"char_distance": max_char_distance + char_allowance / root, "word_distance": max_word_distance + word_allowance / root}
    near = reduce(Column.__and__, [F.coalesce(F.col(c) <= limit, F.lit(True)) for c, limit in limits.items()])
    # One condition over both sides of the join: a part over the texts alone would be pushed below
    # the projections, and the optimizer would then write out each figure anew wherever it is named.
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(near)
    if carry:
        return df.where(kept).select("_row.*")
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "char_distance", "word_distance")
