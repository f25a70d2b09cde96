"""The command line.

    python -m quillmark query "<words>" --index <folder>     ranked results of a stored index, with where each was found
    python -m quillmark import <source> --root <library> [--kind pdf]     cuts a source's raw files into its products
    python -m quillmark build --root <library> --registry <file> --index <folder>
    python -m quillmark validate --root <library> --registry <file> --index <folder>     1 if a check fails or didn't run
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.operators import corpus, search
from quillmark.sources import index as stored
from quillmark.sources import library, registry


def find(spark: SparkSession, index: str, words: str, limit: int, source: str | None = None, author: str | None = None) -> DataFrame:
    """Results in order: their place, chunk, topics, and locator (path of the file, number of the paragraph)."""
    snapshot = stored.open_index(spark, index)
    found = stored.find(snapshot, words, limit, source, author, ("title", "parent_id", "text", "topics")).withColumn("topics", F.concat_ws(", ", "topics"))
    return search.ordered(corpus.trace(F.broadcast(found), snapshot.table("parents"), snapshot.table("documents"))).limit(limit)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quillmark")
    commands = parser.add_subparsers(dest="command", required=True)
    query = commands.add_parser("query", help="search a stored index")
    query.add_argument("words")
    query.add_argument("--limit", type=int, default=search.DEFAULT_LIMIT)
    query.add_argument("--source")
    query.add_argument("--author")
    cut = commands.add_parser("import", help="cut a source's raw files")
    cut.add_argument("source")
    cut.add_argument("--kind", choices=["text", "pdf"], default="text")
    for name, command in commands.choices.items():
        if name != "query":
            command.add_argument("--root", required=True)
    for name in ("build", "validate"):
        command = commands.add_parser(name)
        command.add_argument("--root", required=True)
        command.add_argument("--registry", required=True)
        command.add_argument("--index", required=True)
    query.add_argument("--index", required=True)
    asked = parser.parse_args(argv)
    spark = SparkSession.builder.appName("quillmark").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    if asked.command == "query":
        return _query(spark, asked)
    if asked.command == "import":
        print(library.import_source(spark, asked.root, asked.source, library.pdf_texts if asked.kind == "pdf" else library.raw_texts)["run"]["status"])
        return 0
    sources = registry.registered_sources(spark, asked.registry)
    if asked.command == "build":
        print(f"version {library.build(spark, asked.root, sources, asked.index).version}")
        return 0
    made, violations = library.check(spark, asked.root, sources, asked.index)
    rows = made.collect()  # a row a check
    for r in sorted(rows, key=lambda r: r.check):
        print(f"{r.status:8} {r.check} {'' if r.violations is None else r.violations}")
    for v in violations.limit(50).collect():  # the first, to say where to look
        print(f"    {v.check}: {v.source_id} {v.detail}")
    return 0 if all(r.status == "passed" for r in rows) else 1


def _query(spark: SparkSession, asked: argparse.Namespace) -> int:
    rows = find(spark, asked.index, asked.words, asked.limit, asked.source, asked.author).collect()  # at most the limit
    for i, r in enumerate(rows, 1):
        print(f"[{i}] {r.title} | {r.author} | {r.source_id} | {r.topics} | {r.path}#{r.parent_ord} | {r.score:g}")
        print(f"    {r.text[:200]}")
    if not rows:
        print("nothing found")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
