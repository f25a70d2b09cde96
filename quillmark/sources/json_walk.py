"""Walk of parsed JSON: a row per leaf, and per NUL, with its path.

One scan without a shuffle: a first pass finds how deep the values nest, then so many explodes, one after the
other, open what is left to open; leaves pass through.

Defined cases: null and broken JSON have no rows. Empty objects and arrays are leaves. A path is as in
``$.a[0]."b c"``: keys that are no plain words are quoted and escaped as JSON has them. Repeated rows are walked each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def depth_of(json: Column) -> Column:
    """How many objects and arrays lie in each other at most, in canonical JSON."""
    marks = F.split(F.regexp_replace(F.regexp_replace(json, _STRING, ""), r"[^\[\]{}]", ""), "")
    step = lambda acc, x: F.struct((acc["now"] + F.when(x.isin("[", "{"), 1).when(x.isin("]", "}"), -1).otherwise(0)).alias("now"), F.greatest(acc["most"], acc["now"] + F.when(x.isin("[", "{"), 1).otherwise(0)).alias("most"))
    return F.aggregate(marks, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step, lambda acc: acc["most"])


def _named(key: Column) -> Column:
    quoted = F.to_json(F.array(key))
    return F.when(key.rlike(r"^[A-Za-z_][A-Za-z0-9_]*\z"), key).otherwise(F.substring(quoted, F.lit(2), F.length(quoted) - 2))


def walk(rows: DataFrame, json: str, keys: list[str]) -> DataFrame:
    """The ``keys`` of each row, with path, kind (value or key), and value: the leaves as variants, the keys that hold a NUL as strings."""
    parsed = rows.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.lit("$").alias("path"), F.lit("value").alias("kind"), F.try_parse_json(json).alias("value")).where("value is not null")
    most = parsed.agg(F.max(depth_of(F.to_json("value")))).first()[0] or 0
    own = [F.col(f"_k{i}") for i in range(len(keys))]
    for _ in range(most):
        held = F.when(F.col("kind") == "value", F.col("value"))
        kind = F.schema_of_variant(held)
        entries = F.transform(F.map_entries(F.try_variant_get(held, "$", "map<string,variant>")), lambda e: F.struct(F.lit(None).cast("int").alias("pos"), e["key"].alias("key"), e["value"].alias("inner")))
        items = F.transform(F.try_variant_get(held, "$", "array<variant>"), lambda x, i: F.struct(i.alias("pos"), F.lit(None).cast("string").alias("key"), x.alias("inner")))
        inside = F.when(kind.startswith("OBJECT"), entries).when(kind.startswith("ARRAY"), items)
        opened = parsed.select(*own, "path", "kind", "value", F.explode_outer(inside).alias("_o")).select(*own, "path", "kind", "value", F.col("_o.pos").alias("_pos"), F.col("_o.key").alias("_key"), F.col("_o.inner").alias("_inner"), F.col("_o").isNotNull().alias("_deeper"))
        deeper = F.col("_deeper")
        inner = F.when(F.col("_key").isNull(), F.concat("path", F.lit("["), F.col("_pos").cast("string"), F.lit("]"))).otherwise(F.concat("path", F.lit("."), _named(F.col("_key"))))
        here = F.struct(F.when(deeper, inner).otherwise(F.col("path")).alias("path"), F.when(deeper, F.lit("value")).otherwise(F.col("kind")).alias("kind"), F.when(deeper, F.col("_inner")).otherwise(F.col("value")).alias("value"))
        key = F.struct(inner.alias("path"), F.lit("key").alias("kind"), F.expr("cast(_key as variant)").alias("value"))
        both = F.when(deeper & F.contains("_key", F.lit("\0")), F.array(here, key)).otherwise(F.array(here))
        parsed = opened.select(*own, F.explode(both).alias("_e")).select(*own, "_e.*")
    return parsed.select(*[c.alias(k) for c, k in zip(own, keys, strict=True)], "path", "kind", "value")


def leaves(rows: DataFrame, json: str, keys: list[str]) -> DataFrame:
    """The ``keys`` of each row, path and value (as JSON) of each leaf."""
    return walk(rows, json, keys).where("kind = 'value'").select(*keys, "path", F.to_json("value").alias("value"))


def nuls(rows: DataFrame, json: str, keys: list[str]) -> DataFrame:
    """A row per NUL: the ``keys``, path, kind (in a value or a key), and position in it from 1."""
    text = F.when(F.schema_of_variant("value") == "STRING", F.try_variant_get("value", "$", "string"))
    found = walk(rows, json, keys).select(*keys, "path", "kind", text.alias("_text")).where(F.contains("_text", F.lit("\0")))
    each = F.sequence(F.lit(1), F.length("_text") - F.length(F.translate("_text", "\0", "")))
    parts = F.split("_text", r"\x00", -1)
    return found.select(*keys, "path", "kind", F.explode(F.transform(each, lambda i: (F.length(F.array_join(F.slice(parts, F.lit(1), i), "\0")) + 1).cast("long"))).alias("position"))
