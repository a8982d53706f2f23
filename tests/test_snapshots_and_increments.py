import hashlib
import os
from datetime import datetime as D, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from symgraph.operators import increments as I
from symgraph.operators.snapshots import snapshot_changes
from symgraph.sources.manifest import Manifest

SNAP = "g string, n int, k string, s long, v string, place struct<u: string, l: int>, _k string"


def _changes(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SNAP)
    return sorted(tuple(r) for r in snapshot_changes(df, "g", "n", "k", "s", ["v", "place"]).collect())


def test_typed_changes(spark):
    rows = [("p", 1, "a", 1, "x", None), ("p", 1, "b", 2, None, ("u", 1)), ("p", 1, "c", 3, "", (None, None)), ("p", 3, " A", 1, "x ", None), ("p", 3, "b", 2, "", ("u", 2)), ("p", 3, "c", 3, None, None), ("p", 3, "d", 4, "", None), ("p", 7, "a", 1, "x", None)]
    assert _changes(spark, rows) == [("p", 3, "B", "changed"), ("p", 3, "D", "added"), ("p", 7, "B", "removed"), ("p", 7, "C", "removed"), ("p", 7, "D", "removed")]


def test_repeats_ties_nulls_and_nothing(spark):
    assert _changes(spark, []) == []
    assert _changes(spark, [("p", 1, None, 1, "x", None), (None, 1, "a", 1, "x", None), ("p", None, "a", 1, "x", None), ("p", 2, "a", 1, "y", None)]) == []
    rows = [("p", 1, "a", 1, "x", None)] * 3 + [("p", 2, "a", 1, "old", None), ("p", 2, "A", 9, "x", None), ("p", 2, "a", None, "q", None)]
    assert _changes(spark, rows) == []
    assert _changes(spark, [("p", 1, "a", 1, "x", None), ("p", 1, "z", 1, "x", None), ("p", 2, "z", 1, "x", None), ("p", 3, "a", 1, "x", None), ("p", 3, "z", 1, "x", None)]) == [("p", 2, "A", "removed"), ("p", 3, "A", "added")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("pq"), st.integers(1, 4), st.sampled_from("abc"), st.integers(0, 3), st.sampled_from(["x", "y", "", None])), max_size=40, unique_by=lambda r: r[:4]))
def test_against_brute_force(spark, rows):
    last = {}
    for g, n, k, s, v in sorted(rows, key=lambda r: r[3]):
        last[g, n, k] = v or ""
    want, numbers = set(), {}
    for g, n, _ in last:
        numbers.setdefault(g, set()).add(n)
    for g, ns in numbers.items():
        for a, b in zip(sorted(ns), sorted(ns)[1:]):
            for k in "abc":
                x, y = last.get((g, a, k)), last.get((g, b, k))
                if x != y:
                    want.add((g, b, k.upper(), "added" if x is None else "removed" if y is None else "changed"))
    assert set(_changes(spark, [(g, n, k, s, v, None) for g, n, k, s, v in rows])) == want


T0 = D(2024, 1, 1)
RUN = "run_id long, project_path string, started_at timestamp, finished_at timestamp, status string"
COMMIT = "project_path string, commit_hash string, loaded_at timestamp, added array<string>, modified array<string>, path string"


def day(x):
    return T0 + timedelta(days=x)


def test_each_commit_has_one_run(spark):
    runs = spark.createDataFrame([(1, "p", day(5), day(6), " OK\t"), (1, "p", day(5), day(6), " OK\t"), (2, "p", day(3), None, "ok"), (3, "p", day(4), day(5), "failed"), (4, "p", day(40), day(41), "ok"), (9, "p", day(5), day(6), "ok"), (5, None, day(1), day(1), "ok"), (6, "p", None, day(1), "ok")], RUN)
    commits = spark.createDataFrame([("p", "a", day(9), ["x"], None, "clash"), ("p", "a", day(5), ["x", None, ""], ["x", "y"], None), ("p", "b", day(6), None, [], None), ("p", "c", day(6), ["z"], None, None), ("p", "d", day(41), ["q"], None, None), ("p", "e", None, ["r"], None, None), (None, "f", day(1), ["r"], None, None)], COMMIT)
    ledger = I.commit_ledger(commits)
    assert sorted(map(tuple, I.paths_by_run(ledger, runs).collect())) == [(1, "x"), (1, "y"), (4, "z")]
    claimed = I.claims(ledger, runs)
    assert sorted((r.commit_hash, r.run_id) for r in claimed.collect()) == [("a", 1), ("b", 4), ("c", 4)]
    assert [r.commit_hash for r in I.unclaimed(ledger, claimed).collect()] == ["d"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("pq"), st.integers(0, 60)), max_size=25), st.lists(st.tuples(st.sampled_from("pq"), st.integers(0, 60)), max_size=8), st.integers(1, 30))
def test_as_of_against_brute_force(spark, left, right, block):
    l = spark.createDataFrame([(i, k, day(t)) for i, (k, t) in enumerate(left)], "i long, k string, at timestamp")
    r = spark.createDataFrame([(i, k, day(t)) for i, (k, t) in enumerate(right)], "v long, k string, start timestamp")
    want = {i: min([(t2, j) for j, (k2, t2) in enumerate(right) if k2 == k and t2 >= t], default=(0, None))[1] for i, (k, t) in enumerate(left)}
    assert {x.i: x.v for x in I.first_at_or_after(l, r, "k", "at", "start", "v", block).collect()} == want


def test_manifest_survives_failures(spark, tmp_path):
    source, root = tmp_path / "in", f"file://{tmp_path}/state"
    source.mkdir()

    def put(name, rows):
        spark.createDataFrame([(x,) for x in rows], "x int").coalesce(1).write.parquet(f"file://{tmp_path}/w-{name}")
        (next((tmp_path / f"w-{name}").glob("*.parquet"))).rename(source / name)

    read = lambda files: spark.read.parquet(*files)
    take = lambda batch, process=read: Manifest(spark, root).run(batch, [f"file://{source}"], process, ".parquet")
    values = lambda: sorted(r.x for r in Manifest(spark, root).data().collect())
    assert not take("b0")
    put("a.parquet", [1, 2])
    assert take("b1") and values() == [1, 2]
    assert not take("b1") and not take("b2")
    put("b.parquet", [3])
    (source / "copy.parquet").write_bytes((source / "a.parquet").read_bytes())

    def fail(files):
        read(files).write.parquet(f"{root}/data/b3/half-done")
        raise RuntimeError

    with pytest.raises(RuntimeError):
        take("b3", fail)
    assert values() == [1, 2]
    assert take("b3") and values() == [1, 2, 3] and len(list((tmp_path / "state/data/b3").iterdir())) == 1
    assert not take("b4")
    os.utime(source / "a.parquet", (1, 1))  # touched, and under another name: known by its content
    (source / "z.parquet").write_bytes((source / "b.parquet").read_bytes())
    assert not take("b5")
    manifest = Manifest(spark, root)
    assert manifest.compact("all") and values() == [1, 2, 3] and not take("b6") and manifest.processed().count() == 2
    put("c.parquet", [4])
    assert take("b7") and values() == [1, 2, 3, 4] and not take("b7")


def test_one_of_two_runs_of_a_batch_commits(spark, tmp_path):
    source, root = tmp_path / "in", f"file://{tmp_path}/state"
    spark.createDataFrame([(1,)], "x int").write.parquet(f"file://{source}")

    def meanwhile(files):
        assert Manifest(spark, root).run("b", [f"file://{source}"], lambda f: spark.read.parquet(*f), ".parquet")
        return spark.read.parquet(*files)

    assert not Manifest(spark, root).run("b", [f"file://{source}"], meanwhile, ".parquet")
    assert Manifest(spark, root).data().count() == 1


def test_checksums_do_not_depend_on_parts(tmp_path, monkeypatch):
    from symgraph.sources import manifest

    (tmp_path / "a b").write_bytes(b"x" * 1000)
    monkeypatch.setattr(manifest, "PART_BYTES", 7)
    assert manifest.checksum(f"file://{tmp_path}/a b") == manifest.checksum(f"{tmp_path}/a b") == hashlib.sha256(b"x" * 1000).hexdigest()


def test_stream_takes_every_file_once(spark, tmp_path):
    from symgraph.streaming.commits import stream_changes

    schema = "commit_hash string, added array<string>, modified array<string>, deleted array<string>, renamed_exact array<struct<original: string, new: string>>, copied_exact array<struct<original: string, new: string>>"
    one = lambda rows: spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_path}/in")
    run = lambda: stream_changes(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/check", ["commit_hash"]).awaitTermination()
    one([("1", ["a.c"], None, None, None, None)])
    run()
    one([("2", None, None, None, [("b.txt", "b.c")], None)])
    run()
    run()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r.commit_hash, r.change_type, r.path) for r in got.collect()) == [("1", "added", "a.c"), ("2", "added", "b.c"), ("2", "deleted", "b.txt")]
