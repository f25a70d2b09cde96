"""Manifests as trees, and the run of all checks over a library on disk, a fault at a time."""

import hashlib
import json
import random
import shutil

import pytest
from pyspark.sql import functions as F

from quillmark import __main__ as cli
from quillmark.operators import merkle, validate
from quillmark.sources import index, library, registry, sinks

FILES = "source_id string, path string, sha256 string, size long"


def brute(files):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    nodes = {}
    for _, p, s, n in files:
        nodes.setdefault(sha(p)[:6], []).append(f"{p}\t{s}\t{n}")
    nodes = {k: sha("\n".join(sorted(v))) for k, v in nodes.items()}
    for n in (4, 2, 0):
        up = {}
        for k, d in nodes.items():
            up.setdefault(k[:n], []).append(f"{k}:{d}")
        nodes = {k: sha("\n".join(sorted(v))) for k, v in up.items()}
    return nodes[""]


def test_a_manifest_tree_is_one_formula_and_finds_changes_by_descending(spark):
    rows = [("s", f"p{i}", f"h{i}", i) for i in range(700)] + [("t", "a", "b", 1)]
    old = spark.createDataFrame(rows, FILES)
    got = {r.source_id: (r.manifest_digest, r.file_count) for r in merkle.digests(old.repartition(5)).collect()}
    assert got == {"s": (brute(rows[:-1]), 700), "t": (brute(rows[-1:]), 1)}
    changed = [*rows[:10], ("s", "p10", "other", 10), *rows[12:], ("s", "new", "n", 0), ("u", "x", "y", 2)]
    new = spark.createDataFrame(changed, FILES)
    trees = merkle.tree(old).cache(), merkle.tree(new).cache()
    for given in ((), trees):
        found = {(r.source_id, r.path): r.state for r in merkle.changes(old, new, *given).collect()}
        assert found == {("s", "p10"): "changed", ("s", "p11"): "removed", ("s", "new"): "added", ("u", "x"): "added"}
    nodes = merkle.differing(*trees)
    per = {r.level: r.n for r in nodes.where("source_id = 's'").groupBy("level").agg(F.count("*").alias("n")).collect()}
    assert per[0] == 1 and all(per[n] <= 3 for n in (2, 4, 6))
    assert merkle.changes(old, old).collect() == [] and merkle.digests(old.limit(0)).collect() == []


TEXTS = {"s1": {"a": "Title one\n" + "the market mood of the day\n" * 5, "b": "Second\nthe market again\nthe market"}, "s2": {"c": "Bonds\n" + "convexity and duration\n" * 6, "d": "More\nconvexity", "e": "Last\nconvexity too"}}


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("clean")
    for s, files in TEXTS.items():
        for name, text in files.items():
            (root / "lib" / s / "raw" / "deep").mkdir(parents=True, exist_ok=True)
            (root / "lib" / s / "raw" / ("deep" if name == "b" else "") / f"{name}.txt").write_text(text)
    (root / "sources.yaml").write_text("sources:\n  - id: s1\n    status: approved\n    smoke_query: market\n  - id: s2\n    status: approved\n  - id: s3\n    status: draft\n")
    for s in TEXTS:
        assert cli.main(["import", s, "--root", str(root / "lib")]) == 0
    (root / "lib" / "s1" / "methods.jsonl").write_text(json.dumps({"method_id": "m", "source_id": "s1", "chunk_id": spark.read.json(sinks.product(spark, str(root / "lib" / "s1" / "chunks.jsonl"))).first().chunk_id}))
    assert cli.main(["build", "--root", str(root / "lib"), "--registry", str(root / "sources.yaml"), "--index", str(root / "index")]) == 0
    return root


def checked(spark, root, only):
    sources = registry.registered_sources(spark, str(root / "sources.yaml"))
    report, violations = library.check(spark, str(root / "lib"), sources, str(root / "index"), only)
    rows = report.collect()
    assert {r.check for r in rows} == set(validate.CHECKS) and {r.check for r in rows if r.status != "not run"} == only
    return {r.check for r in rows if r.status == "failed"}, {(r.check, r.source_id) for r in violations.collect()}


def test_a_clean_library_passes_every_check(spark, clean, capsys):
    assert cli.main(["validate", "--root", str(clean / "lib"), "--registry", str(clean / "sources.yaml"), "--index", str(clean / "index")]) == 0
    out = capsys.readouterr().out
    assert out.count("passed") == len(validate.CHECKS) and "failed" not in out
    kinds = {r.chunk_type for r in index.open_index(spark, str(clean / "index")).table("chunks").collect()}
    assert kinds == {"text", "curated_method"}
    assert cli.main(["query", "market", "--index", str(clean / "index"), "--source", "s1"]) == 0
    assert "s1/raw/a.txt#" in capsys.readouterr().out


def summary(root, source, change):
    path = root / "lib" / source / "summary.json"
    state = json.loads(path.read_text())
    change(state)
    path.write_text(json.dumps(state))
    (path.parent / f".{path.name}.crc").unlink(missing_ok=True)


def product_part(root, source, name):
    folder = root / "lib" / source / f"{name}.jsonl"
    part = next(p for p in (folder / (folder / "CURRENT").read_text()).glob("part-*") if p.stat().st_size)
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    return part


def crashed(root):
    summary(root, "s1", lambda s: s["run"].update(status="in_progress"))


def raw_changed(root):
    (root / "lib" / "s1" / "raw" / "a.txt").write_text("changed")


def product_changed(root):
    part = product_part(root, "s2", "parents")
    part.write_text(part.read_text().replace("convexity", "concavity", 1))


def imported_again(root):
    summary(root, "s2", lambda s: s["run"].update(attempt_id="another"))


def nul_in_a_product(root):
    part = product_part(root, "s2", "parents")
    part.write_text(part.read_text().replace("convexity", "conv\\u0000exity", 1))


def stranger(root):
    (root / "lib" / "s9" / "raw").mkdir(parents=True)
    (root / "lib" / "s9" / "raw" / "x.txt").write_text("x")


def not_indexed(root):
    (root / "sources.yaml").write_text((root / "sources.yaml").read_text().replace("status: draft", "status: approved"))


def short_smoke(root):
    (root / "sources.yaml").write_text((root / "sources.yaml").read_text().replace("smoke_query: market", "smoke_query: of"))


def foreign_smoke(root):
    (root / "sources.yaml").write_text((root / "sources.yaml").read_text().replace("smoke_query: market", "smoke_query: convexity"))


@pytest.mark.parametrize(
    ("fault", "failed"),
    [
        (crashed, {("run_status", "s1"), ("source_credentials", "s1")}),
        (raw_changed, {("manifest_digest", "s1"), ("raw_unchanged", "s1")}),
        (product_changed, {("outputs", "s2")}),
        (imported_again, {("source_credentials", "s2")}),
        (nul_in_a_product, {("outputs", "s2"), ("nul_free", "s2")}),
        (stranger, {("id_sets", "s9")}),
        (short_smoke, {("smoke_length", "s1")}),
        (foreign_smoke, {("source_reachable", "s1")}),
        (not_indexed, {("id_sets", "s3"), ("nonempty", "s3"), ("source_reachable", "s3"), ("run_status", "s3")}),
    ],
)
def test_each_fault_fails_its_checks_and_no_other(spark, clean, tmp_path, fault, failed):
    root = tmp_path / "copy"
    shutil.copytree(clean, root)
    fault(root)
    # The faults' own checks and those that a wrong one would trip first.
    checks, violations = checked(spark, root, {c for c, _ in failed} | {"run_status", "manifest_digest", "source_credentials"})
    assert violations == failed and checks == {c for c, _ in failed}


def test_what_did_not_run_is_not_passed(spark):
    none = spark.createDataFrame([], "check string, source_id string, detail string")
    got = {r.check: (r.violations, r.status) for r in validate.report(none, ["integrity"]).collect()}
    assert got.pop("integrity") == (0, "passed") and set(got.values()) == {(None, "not run")}
    with pytest.raises(ValueError):
        validate.report(none, ["other"])


def test_index_faults_are_found(spark, clean):
    snapshot = index.open_index(spark, str(clean / "index"))
    chunks = snapshot.table("chunks")
    kinds = lambda frame: [(r.source_id, r.detail) for r in frame.collect()]
    assert kinds(validate.row_counts({"chunks": 1}, {"chunks": chunks})) != [] == kinds(validate.row_counts({"chunks": chunks.count()}, {"chunks": chunks}))
    more = chunks.unionByName(chunks.limit(1).withColumns({"chunk_id": F.lit("unseen"), "text": F.lit("the market unseen")}))
    assert [d.split()[0] for _, d in kinds(validate.recall_coverage(snapshot.index(), more, ["market", "zz"]))] == ["market"]
    other = chunks.where("source_id = 's2'")
    smoke = spark.createDataFrame([("s2", "nobody", "con")], "source_id string, author string, gram string")
    assert kinds(validate.author_reachable(snapshot.index(), other, smoke)) == [("s2", "nobody")]
