"""What an update takes besides the listed changes."""

import json

import pytest
from pyspark.sql import functions as F

from symgraph.plans import general, registry

CHANGE = "project_path string, commit_hash string, added array<string>, modified array<string>, deleted array<string>, renamed_exact array<struct<original: string, new: string>>, copied_exact array<struct<original: string, new: string>>"
INCLUDES = [("/p/a.c", "/p/h.h"), ("/p/h.h", "/p/k.h"), ("/q/x.c", "/p/k.h"), ("/p/far.c", "/q/x.c"), ("/p/b.c", "/p/gone.h"), ("/p/alone.c", "/p/other.h"), ("/pp/s.c", "/p/k.h")]
CHANGES = [("/p", "1", None, ["k.h"], None, None, None), ("/p", "2", ["n.c"], None, ["gone.h", "b.c"], None, None), ("/p", "3", None, ["a.c"], ["gone.h"], None, None), ("/q", "4", None, ["k.h", "x.c"], None, None, None)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, json.dumps({"ID": f"{i}", "Definition": {"FileURI": f"file://{a}"}, "IncludeHeaders": [{"Header": f"file://{b}", "References": 1}]})) for i, (a, b) in enumerate(INCLUDES)]
    spark.createDataFrame(docs, "doc_seq long, body string").write.parquet(f"{d}/index_docs.parquet")
    spark.createDataFrame(CHANGES, CHANGE).write.parquet(f"{d}/git_changes.parquet")
    return d


def test_dirty_files_hold_what_a_header_reaches(spark, tables):
    got = sorted((r.commit_hash, r.path) for r in registry.queries()["update_dirty_files"](spark, tables).collect())
    assert got == [("1", "a.c"), ("1", "far.c"), ("1", "h.h"), ("1", "k.h"), ("2", "n.c"), ("3", "a.c"), ("3", "b.c"), ("4", "k.h"), ("4", "x.c")]
    scope = sorted((r.commit_hash, r.path) for r in registry.queries()["update_purge_scope"](spark, tables).collect())
    assert scope == sorted([*got, ("2", "b.c"), ("2", "gone.h"), ("3", "gone.h")])


def test_includes_of_dirty_files_are_purged(spark, tables):
    got = sorted((r.including, r.included) for r in registry.queries()["update_purge_includes"](spark, tables).collect())
    assert got == [("/p/alone.c", "/p/other.h"), ("/pp/s.c", "/p/k.h")]


def test_commits_arrive_in_batches(spark, tmp_path, monkeypatch):
    commits = [("/p", str(i), [f"{i}.c"], None, f"202{4 + i // 2}-0{1 + 6 * (i % 2)}-03") for i in range(4)]
    rows = spark.createDataFrame(commits, "project_path string, commit_hash string, added array<string>, modified array<string>, at string").withColumn("loaded_at", F.to_timestamp("at"))
    rows.write.parquet(f"{tmp_path}/git_changes.parquet")
    take, n = general.increments.commit_ledger, []

    def breaks(changes):
        n.append(1)
        if len(n) == 3:
            raise RuntimeError
        return take(changes)

    monkeypatch.setattr(general.increments, "commit_ledger", breaks)
    with pytest.raises(RuntimeError):
        general.commit_manifest(spark, str(tmp_path))
    manifest = general.commit_manifest(spark, str(tmp_path))
    assert len(n) == 5 and manifest.committed() == ["arrival-2024a", "arrival-2024b", "arrival-2025a", "arrival-2025b"]  # two before the failure, the failed one, and the two left
    assert sorted(r.path for r in manifest.data().collect()) == ["0.c", "1.c", "2.c", "3.c"]
    general.commit_manifest(spark, str(tmp_path))
    assert len(n) == 5
    assert [(r.n_rows, r.n_pending) for r in general.p3_increments(spark, str(tmp_path)).collect()] == [(1, 0)] * 4
