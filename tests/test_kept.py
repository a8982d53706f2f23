"""Snapshots that arrive one after the other."""

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from symgraph.operators import snapshots
from symgraph.operators.kept import KeptSnapshots

SCHEMA = "g string, n int, k string, s long, a string, o string"


def _both(spark, path, rows, order, **options):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    want = sorted(tuple(r) for r in snapshots.snapshot_changes(df, "g", "n", "k", "s", ["a"]).collect())
    state, got = KeptSnapshots(spark, f"file://{path}", "g", "n", "k", "s", ["a"], **options), []
    for some in order:
        got += [tuple(r) for r in state.take(df.filter(df.g.isNotNull() & df.n.isin(some))).collect()]
    return want, sorted(got), state, df


def test_deliveries_give_the_changes_of_the_whole_history(spark, tmp_path):
    rows = [("p", 1, "a", 1, "x"), ("p", 1, "b ", 2, None), ("p", 2, "A", 1, "y"), ("p", 2, "a", 0, "x"), ("p", 2, "c", 1, ""), ("p", 3, "c", 1, " "), ("q", 2, "a", 1, "x"), ("q", 3, "z", 1, "x"), (None, 1, "a", 1, "x"), ("p", None, "a", 1, "x"), ("p", 1, None, 1, "x")]
    want, got, state, df = _both(spark, tmp_path, rows, [[1], [2], [3]], range_rows=2)
    assert got == want and len(want) == 6
    assert state.take(df.filter("n = 3")).count() == 0 and state.take(df.filter("n = 1")).count() == 0 and state.take(df.limit(0)).count() == 0


def test_a_failure_leaves_the_version_before(spark, tmp_path, monkeypatch):
    rows = [("p", 1, "a", 1, "x"), ("p", 2, "b", 1, "x")]
    df = spark.createDataFrame([(*r, None) for r in rows], SCHEMA)
    state = KeptSnapshots(spark, f"file://{tmp_path}", "g", "n", "k", "s", ["a"])
    assert state.take(df.filter("n = 1")).count() == 0

    def fail(_):
        raise OSError

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(state, "_name", fail)
        state.take(df.filter("n = 2"))
    assert sorted((r.k, r.change_kind) for r in state.take(df.filter("n = 2")).collect()) == [("A", "removed"), ("B", "added")]


def test_kept_files_are_by_range_and_sorted(spark, tmp_path):
    df = spark.createDataFrame([("p", n, f"{i}", 1, f"{n}", None) for n in (1, 2) for i in range(50)], SCHEMA)
    state = KeptSnapshots(spark, f"file://{tmp_path}", "g", "n", "k", "s", ["a"], range_rows=10)
    state.take(df.filter("n = 1"))
    version = state._state()["version"]
    folders = sorted((tmp_path / version / "kind=kept").iterdir(), key=lambda f: int(f.name.split("=")[1]))
    keys = [pq.read_table(f, columns=["o"])["o"].to_pylist() for folder in folders for f in folder.glob("*.parquet")]
    assert len(folders) >= 4 and [x for k in keys for x in k] == sorted(f"p\x00{i}" for i in range(50))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("pq"), st.integers(1, 3), st.sampled_from("abcde"), st.integers(0, 2), st.sampled_from(["", "x", "y"])), min_size=1, max_size=25))
def test_any_history(spark, tmp_path_factory, rows):
    want, got, *_ = _both(spark, tmp_path_factory.mktemp("kept"), rows, [[1], [2], [3]], range_rows=3)
    assert got == want
