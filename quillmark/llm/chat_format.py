"""Chat formatting: tool calls and their results, linked, ordered, validated, as canonical JSON.

A turn's text is read as JSON, with its types, where it is an object with ``tool_calls`` (id, name, arguments; the
arguments an object, or a text that is one) or with a ``tool_call_id``. A plain user turn is a call of the tool ``respond`` with the text as its
argument, and the plain turn after it is that call's result, so plain conversations run the same
way. Calls meet results in a hash join on (conversation, identifier); several results of one
identifier are first reduced to one, so no identifier multiplies rows. A result that meets no call,
or is not the one taken, is a row of its own with that fault, and so is a turn that is neither call
nor result, and what a turn of calls says beside them: every turn is in the output, whole. Arguments are held against
schemas of (tool, argument, type, pattern, required). Canonical JSON has its keys sorted at every depth, no white
space, and one form for equal numbers: plain digits without needless zeros, an exponent only where 38 digits don't hold the number. A call whose arguments hold ``{"$ref": id}`` at any depth depends on the call of that id; levels of the dependency graph come from joined sweeps, one a level,
until one settles no call; a call on a cycle, or that depends on one, gets level -1. The order of a conversation is
(level, turn, ordinal). Nothing gathers a conversation into one row or one task.

Defined cases: null text is an empty text; a null conversation or turn keeps its rows, which link
only to results with the same null-free key. Repeated rows stay, each with its own call; among several
results the first by turn, then by text, is taken, n_results says how many there were, and the others
have rows at the call's level. Broken
JSON, and JSON in which an object repeats a key, counts as plain text; arguments that are no object are empty ones. Texts are read whole. An empty table gives an empty result. Extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import materialize

#: A reference as canonical JSON has it; a text that looks like one has its quotes escaped there.
REFERENCE = r'\{"\$ref":"((?:[^"\\]|\\.)*)"\}'
CALLS = "array<struct<id:string,name:string,arguments:variant>>"
#: How the types of JSON values begin in Spark's names for them.
TYPES = {"string": ("STRING",), "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "boolean": ("BOOLEAN",), "object": ("OBJECT",), "array": ("ARRAY",)}
#: The schemas of the registered query, as tool -> {argument: (type, pattern of a text or None, required)}.
SCHEMAS = {"respond": {"text": ("string", r"(?s).*\S.*", True)}}
Schemas = dict[str, dict[str, tuple[str, str | None, bool]]]


def canonical_numbers(json: Column) -> Column:
    """JSON as Spark writes it, with one form for equal numbers; Spark writes 100 and 100.0, 10000000 and 1.0E7. Strings stay as they are."""
    tokens = F.regexp_extract_all(json, F.lit(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|-?[0-9][0-9.E+-]*+|[^"0-9-]++'), 0)

    def plain(t: Column) -> Column:
        found = F.coalesce(*[F.when(t.try_cast(f"decimal(38,{s})").cast("double") == t.cast("double"), t.try_cast(f"decimal(38,{s})").cast("string")) for s in (*range(0, 37, 4), 38)])
        digits = F.when(found.contains("."), F.regexp_replace(found, r"\.?0+\z", "")).otherwise(found)
        return F.when(t.rlike(r"^-?[0-9].*(E|\.0\z)"), F.coalesce(digits, t)).otherwise(t)

    return F.when(json.rlike(r"[0-9](?:\.0(?![0-9])|E-?[0-9])"), F.array_join(F.transform(tokens, plain), "")).otherwise(json)


def _message() -> Column:
    v = F.when(F.col("text").rlike(r"^\s*\{"), F.try_parse_json("text"))
    get = lambda path, kind: F.try_variant_get(v, path, kind)
    return F.struct(get("$.content", "string").alias("content"), get("$.tool_call_id", "string").alias("tool_call_id"), get("$.tool_calls", CALLS).alias("tool_calls"))


def _object(v: Column) -> Column:
    """The arguments as an object: as they are, or read from their text; else empty."""
    whole = F.when(F.schema_of_variant(v) == "STRING", F.try_parse_json(F.try_variant_get(v, "$", "string"))).otherwise(v)
    return F.when(F.schema_of_variant(whole).startswith("OBJECT"), whole).otherwise(F.parse_json(F.lit("{}")))


def turns_of(conversations: DataFrame) -> DataFrame:
    df = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).withColumn("_m", _message())
    df = df.withColumn("_is_call", F.col("_m.tool_calls").isNotNull()).withColumn("_is_result", F.col("_m.tool_call_id").isNotNull())
    plain = F.array(F.struct(F.concat(F.lit("turn-"), F.col("turn").cast("string")).alias("id"), F.lit("respond").alias("name"), F.to_variant_object(F.struct("text")).alias("arguments")))
    calls = F.when(F.col("_is_call"), F.col("_m.tool_calls")).when((F.col("role") == "user") & ~F.col("_is_result"), plain)
    answer = (F.col("role") != "user") & ~F.col("_is_call") & ~F.col("_is_result")
    named = F.when(F.col("_is_result"), F.col("_m.tool_call_id")).when(answer, F.concat(F.lit("turn-"), (F.col("turn") - 1).cast("string")))
    return df.withColumn("_calls", calls).withColumn("_answers", named)


def calls_of(turns: DataFrame) -> DataFrame:
    """One row per call: conv_id, turn, ordinal, call_id, name, arguments (an object)."""
    return turns.select("conv_id", "turn", F.posexplode("_calls").alias("ordinal", "c")).select("conv_id", "turn", "ordinal", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"), _object(F.col("c.arguments")).alias("arguments"))


def results_of(turns: DataFrame) -> DataFrame:
    """One row per different result: conv_id, call_id, r (its turn t and content c), copies."""
    content = F.when(F.col("_is_result"), F.coalesce(F.col("_m.content"), F.lit(""))).otherwise(F.col("text"))
    rows = turns.select("conv_id", F.col("_answers").alias("call_id"), F.struct(F.col("turn").alias("t"), content.alias("c")).alias("r")).where(F.col("call_id").isNotNull())
    return rows.groupBy("conv_id", "call_id", "r").agg(F.count("*").alias("copies"))


def first_of(results: DataFrame) -> DataFrame:
    """One row per identifier: conv_id, call_id, result, result_turn, n_results."""
    return results.groupBy("conv_id", "call_id").agg(F.min("r").alias("_r"), F.sum("copies").alias("n_results")).select("conv_id", "call_id", F.col("_r.c").alias("result"), F.col("_r.t").alias("result_turn"), "n_results")


def unlinked(turns: DataFrame, results: DataFrame, firsts: DataFrame, calls: DataFrame, depth: DataFrame) -> DataFrame:
    """Rows of the results that no call has taken and of the turns that are neither call nor result."""
    key = ["conv_id", "call_id"]
    linked = calls.select(*key).distinct().withColumn("_linked", F.lit(True))
    more = firsts.join(linked, key, "left").where("_linked is null or n_results > 1")
    taken = more.join(depth, key, "left").select(F.col("conv_id").alias("_v"), F.col("call_id").alias("_c"), F.struct(F.col("result_turn").alias("t"), F.col("result").alias("c")).alias("_r"), "n_results", "_linked", "level")
    rest = results.join(taken, F.col("conv_id").eqNullSafe(F.col("_v")) & (F.col("call_id") == F.col("_c")))
    rest = rest.withColumn("_left", F.col("copies") - F.when(F.col("_linked") & F.col("r").eqNullSafe(F.col("_r")), 1).otherwise(0)).where("_left > 0")
    rest = rest.withColumn("_each", F.explode(F.sequence(F.lit(1).cast("long"), "_left")))
    fault = F.when(F.col("_linked"), "surplus result").otherwise("no call")
    row = lambda level, turn, call_id, n, at, fault, *body: ["conv_id", level.alias("level"), turn.alias("turn"), F.lit(0).alias("ordinal"), call_id.alias("call_id"), F.lit(None).cast("string").alias("name"), n.alias("n_results"), at.alias("result_turn"), fault.alias("faults"), F.to_json(F.struct(*body)).alias("canonical")]
    rest = rest.select(*row(F.coalesce("level", F.lit(0)), F.col("r.t"), F.col("call_id"), F.col("n_results"), F.col("r.t"), fault, F.col("call_id").alias("id"), F.col("r.c").alias("result")))
    calling = F.coalesce(F.size("_calls"), F.lit(0)) > 0
    said = F.when(calling, F.when(F.col("_is_call") & ~F.col("_is_result"), F.col("_m.content"))).when(F.col("_answers").isNull(), F.col("text"))
    other = turns.withColumn("_said", said).where("_said is not null")
    return rest.unionByName(other.select(*row(F.lit(0), F.col("turn"), F.lit(None).cast("string"), F.lit(0).cast("long"), F.lit(None).cast(turns.schema["turn"].dataType), F.when(calling, F.lit("")).otherwise(F.lit("neither call nor result")), F.col("_said").alias("content"), F.col("role"))))


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level of every call with a dependency: the longest chain of references below it.

    A sweep drops the references to calls settled by the one before; a call that has none left is settled.
    """
    key = ["conv_id", "call_id"]
    named = F.regexp_extract_all(F.to_json("arguments"), F.lit(REFERENCE), 1)
    needs = F.try_variant_get(F.try_parse_json(F.concat(F.lit('"'), F.col("_a"), F.lit('"'))), "$", "string")
    refs = calls.select(*key, F.explode(named).alias("_a")).select(*key, needs.alias("needs")).where("needs is not null and conv_id is not null and call_id is not null").distinct()
    left = materialize(refs)
    done = left.where("false").select(*key, F.lit(0).alias("level"))
    if left.isEmpty():
        return done
    settled = materialize(left.select("conv_id", F.col("needs").alias("call_id")).distinct().join(left.select(*key).distinct(), key, "left_anti"))
    level = 0
    while not settled.isEmpty():
        level += 1
        before, left = left, materialize(left.join(settled.withColumnRenamed("call_id", "needs"), ["conv_id", "needs"], "left_anti"))
        settled = materialize(before.select(*key).distinct().join(left.select(*key).distinct(), key, "left_anti"))
        done = done.unionByName(settled.withColumn("level", F.lit(level)))
        if level % 8 == 0:
            done = materialize(done)
    return done.unionByName(left.select(*key).distinct().withColumn("level", F.lit(-1)))


def _faults(schemas: Schemas) -> Column:
    """What is wrong with a call's arguments, as an array of texts."""
    found, given = [], F.coalesce(F.map_keys(F.try_variant_get("arguments", "$", "map<string,variant>")), F.array().cast("array<string>"))
    for tool, arguments in schemas.items():
        is_tool = F.col("name") == tool
        for name, (kind, pattern, required) in arguments.items():
            path = f"$['{name}']"
            value = F.try_variant_get("arguments", path, "variant")
            if required:
                found.append(F.when(is_tool & ~F.array_contains(given, name), F.lit(f"missing {name}")))
            of_kind = F.lit(False)
            for start in TYPES[kind]:
                of_kind = of_kind | F.schema_of_variant(value).startswith(start)
            fits = of_kind if pattern is None else of_kind & F.coalesce(F.try_variant_get("arguments", path, "string").rlike(pattern), F.lit(False))
            found.append(F.when(is_tool & F.array_contains(given, name) & ~fits, F.lit(f"invalid {name}")))
        extra = F.size(F.array_except(given, F.array(*map(F.lit, arguments)).cast("array<string>"))) > 0
        found.append(F.when(is_tool & extra, F.lit("unknown argument")))
    found.append(F.when(~F.coalesce(F.col("name").isin(*schemas), F.lit(False)), F.lit("unknown tool")))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def format_chat(conversations: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call: its place, its result, what is wrong with it, and both as canonical JSON.

    So too one per result without a call, per surplus result, per turn that is neither, and per content beside calls.
    """
    turns = turns_of(conversations)
    calls = calls_of(turns)
    results, depth = results_of(turns), levels(calls)
    firsts = first_of(results)
    df = calls.join(firsts, ["conv_id", "call_id"], "left").join(depth, ["conv_id", "call_id"], "left")
    df = df.withColumn("faults", _faults(schemas)).withColumn("level", F.coalesce("level", F.lit(0))).withColumn("n_results", F.coalesce("n_results", F.lit(0).cast("long")))
    body = F.struct("arguments", F.col("call_id").alias("id"), F.col("name"), F.col("result"))
    made = df.select("conv_id", "level", "turn", "ordinal", "call_id", "name", "n_results", "result_turn", F.concat_ws("; ", "faults").alias("faults"), canonical_numbers(F.to_json(body)).alias("canonical"))
    return unlinked(turns, results, firsts, calls, depth).unionByName(made)
