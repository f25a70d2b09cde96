"""Fill-in-the-middle transformation by escaped marker injection.

A delimiter is escaped in the text, so that it occurs nowhere in it; one regexp_replace then puts a
delimiter behind each unit (a word with the white space before it, or white space alone at the end).
Their count is the number of units, and substring_index takes the parts between ranked ones, from
which the delimiters are removed and the escapes undone. Neither the delimiter nor its escape is
white space, so that escaping moves no bound of a unit. Cuts and forms are drawn from a hash of the
seed and doc_id, so a retried task draws the same.

All of it is a projection of built-in functions: no shuffle, no Python, a row at a time, whatever a
source's or a group's share of the rows. Each step is a projection of its own over columns that the
steps after it name more than once, so the optimizer keeps them apart and computes each once.

Defined cases: a null text counts as empty; an empty text, and one that holds a marker, stays plain.
A text of white space alone is one unit. A null doc_id hashes as the seed, a colon and nothing. Repeated rows
get equal results. Equal draws give an empty middle; draws of 0 or of all units give empty outer parts. Texts are
cut whole, whatever their length, up to Spark's limit of a value. An empty table gives an empty result. Other
columns are dropped, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The markers before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
DELIMITER, ESCAPE = "\x01", "\x02"


def _replace(c: Column | str, old: str, new: str) -> Column:
    return F.replace(F.col(c) if isinstance(c, str) else c, F.lit(old), F.lit(new))


def escape(c: Column) -> Column:
    """The text without the delimiter: the escape and the delimiter are each written as the escape and a letter."""
    return _replace(_replace(c, ESCAPE, ESCAPE + "b"), DELIMITER, ESCAPE + "a")


def unescape(c: Column) -> Column:
    """What ``escape`` took, from a part in which delimiters still mark units."""
    return _replace(_replace(_replace(c, DELIMITER, ""), ESCAPE + "a", DELIMITER), ESCAPE + "b", ESCAPE)


def _draw(hashed: Column, k: int) -> Column:
    """The k-th group of eight hex digits as a number."""
    return F.conv(F.substring(hashed, 8 * k - 7, 8), 16, 10).cast("long")


def _from_right(c: Column, count: Column) -> Column:
    """The last ``count`` pieces between delimiters; all, where there are no more."""
    return F.call_function("substring_index", c, F.lit(DELIMITER), -count)


def transform(documents: DataFrame, seed: int = 42, percent: int = 50, percent_spm: int = 80) -> DataFrame:
    """doc_id, n, form, the parts prefix, middle and suffix (null if plain), and output, of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    df = documents.select("doc_id", text.alias("text"), hashed.alias("hashed"), escape(text).alias("escaped"))
    df = df.select("*", F.regexp_replace("escaped", UNIT, "$0" + DELIMITER).alias("marked"))
    df = df.select("doc_id", "text", "hashed", "marked", (F.length("marked") - F.length("escaped")).cast("long").alias("n"))
    one, two = (_draw(F.col("hashed"), k) % (F.col("n") + 1) for k in (1, 2))
    plain = (F.col("text") == "") | F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE)) | (_draw(F.col("hashed"), 3) % 100 >= percent)
    form = F.when(plain, "plain").when(_draw(F.col("hashed"), 4) % 100 < percent_spm, "spm").otherwise("psm")
    df = df.select("doc_id", "text", "marked", "n", F.least(one, two).cast("int").alias("a"), F.greatest(one, two).cast("int").alias("b"), form.alias("form"))
    cut = F.when(F.col("form") != "plain", F.call_function("substring_index", "marked", F.lit(DELIMITER), F.col("b")))
    df = df.select("doc_id", "text", "marked", "n", "a", "b", "form", cut.alias("before"))
    # ``marked`` ends with a delimiter, so one piece more than units, an empty one, lies right of the last.
    suffix = F.when(F.col("form") != "plain", _from_right(F.col("marked"), (F.col("n") + 1 - F.col("b")).cast("int")))
    prefix = F.when(F.col("form") != "plain", F.call_function("substring_index", "marked", F.lit(DELIMITER), F.col("a")))
    middle = F.when(F.col("form") != "plain", _from_right(F.col("before"), F.col("b") - F.col("a")))
    df = df.select("doc_id", "text", "n", "form", unescape(prefix).alias("prefix"), unescape(middle).alias("middle"), unescape(suffix).alias("suffix"))
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    spm = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text"))
    return df.select("doc_id", "n", "form", "prefix", "middle", "suffix", output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text again, from an output and its form alone.

    No part holds a marker, and a marker's first character is in it once, so none begins at a seam.
    """
    between = lambda first, last: F.substring_index(F.substring_index(output, last, 1), first, -1)
    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(transformed: DataFrame) -> DataFrame:
    """doc_id, n, form, lengths of prefix and middle, digests of the output and of the text restored from it."""
    sha = lambda c: F.sha2(c, 256)
    return transformed.select(
        "doc_id", "n", "form", F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"),
        sha(F.col("output")).alias("output_sha256"), sha(restore(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
