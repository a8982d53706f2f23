from datetime import datetime as D

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from symgraph.operators import orphans as O

T = [D(2024, 1, d) for d in range(1, 20)]
PARENT = "id string, a timestamp, z timestamp, extra string"
CHILD = "row_id long, at timestamp, ref string, other string, key string"


def _cascade(spark, parents, children, hot=None):
    p = O.Parent("p", spark.createDataFrame(parents, PARENT), "id", "a", "z")
    c = O.Child("c", spark.createDataFrame(children, CHILD), F.col("row_id"), "at", {"ref": "p", "other": "p"})
    got = O.orphan_cascade([c], {"p": [p]}, hot)
    return sorted((r.ref_field, r.row_id, r.ref_key) for r in got.collect())


def test_a_life_starts_inclusive_and_ends_exclusive(spark):
    parents = [("a", T[2], T[4], None), (" A\t", T[6], None, None)]
    children = [(i, T[i], "a ", None, "clash") for i in range(1, 8)]
    assert _cascade(spark, parents, children) == [("ref", i, "A") for i in map(str, (1, 4, 5))]


def test_blank_null_zero_are_no_references(spark):
    assert _cascade(spark, [], [(1, T[0], None, "", None), (2, T[0], "0000", " \t", None), (3, T[0], "x", "00", None)]) == [("ref", "3", "X")]


def test_the_earliest_delivery_counts(spark):
    parents = [("a", T[3], None, None)]
    assert _cascade(spark, parents, [(1, T[5], "a", None, None), (1, T[1], "a", None, None), (1, T[5], "a", None, None)]) == [("ref", "1", "A")]
    assert _cascade(spark, parents, [(1, T[5], "a", None, None), (1, None, "b", None, None)]) == []


def test_nulls_and_empty_tables(spark):
    assert _cascade(spark, [(None, T[0], None, None), ("a", None, None, None)], [(None, T[1], "a", "a", None), (1, T[1], "a", None, None), (2, None, "a", None, None)]) == [("ref", "1", "A"), ("ref", "2", "A")]
    assert _cascade(spark, [], []) == []


def test_lives_that_overlap_touch_or_never_hold(spark):
    parents = [("a", T[1], T[3], None), ("a", T[2], T[4], None), ("a", T[4], T[5], None), ("a", T[7], T[6], None), ("a", T[9], T[9], None), ("a", T[12], None, None), ("a", T[13], T[14], None)] * 3
    children = [(i, T[i], "a", None, None) for i in range(18)]
    assert sorted(int(i) for _, i, _ in _cascade(spark, parents, children)) == [0, 5, 6, 7, 8, 9, 10, 11]


def test_salting_changes_nothing(spark):
    parents = [("hot", T[3], None, None), ("b", T[0], T[2], None)]
    children = [(i, T[i % 8], "hot", "b", None) for i in range(200)]
    assert _cascade(spark, parents, children, {"c": ["HOT"]}) == _cascade(spark, parents, children, {"c": []})


def test_hot_keys_come_from_all_rows(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    assert O.hot_keys(df, "k", 0.05) == ["hot"]


def test_orphans_are_inherited_down_a_graph_without_cycle(spark):
    top = O.Parent("top", spark.createDataFrame([("t1",)], "id string"), "id")
    mid_rows = spark.createDataFrame([("m1", "t1"), ("m2", "gone"), ("m3", "gone"), ("m3", "t1")], "id string, top string").withColumn("row", F.concat_ws("|", "id", "top"))
    leaf = spark.createDataFrame([(1, "m1"), (2, "m2"), (3, "none"), (4, "m3")], "row_id long, mid string")
    got = O.orphan_cascade([O.Child("mid", mid_rows, F.col("row"), None, {"top": "top"}), O.Child("leaf", leaf, F.col("row_id"), None, {"mid": "mid"})], {"top": [top], "mid": [O.Parent("mid", mid_rows, "id", row_id=F.col("row"))]})
    assert sorted((r.src_table, r.row_id, r.orphan_kind) for r in got.collect()) == [("leaf", "2", "inherited"), ("leaf", "3", "direct"), ("mid", "m2|gone", "direct"), ("mid", "m3|gone", "direct")]


def test_a_cycle_reaches_its_fixpoint(spark):
    rows = spark.createDataFrame([("1", None), ("2", "1"), ("3", "x"), ("4", "3"), ("5", "4"), ("6", "7"), ("7", "6")], "id string, up string")
    got = O.orphan_cascade([O.Child("n", rows, F.col("id"), None, {"up": "n"})], {"n": [O.Parent("n", rows, "id", row_id=F.col("id"))]})
    assert sorted((r.row_id, r.orphan_kind, r.depth) for r in got.collect()) == [("3", "direct", 0), ("4", "inherited", 1), ("5", "inherited", 2)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 7), st.integers(0, 8), st.integers(0, 8)), min_size=1, max_size=14))
def test_any_graph_against_brute_force(spark, edges):
    """Rows with two references each, keys shared by several rows, cycles."""
    rows = [(f"r{i}", f"k{k}", f"k{a}", f"k{b}") for i, (k, a, b) in enumerate(edges)]
    sick = {}
    changed = True
    while changed:
        changed = False
        for r, _, *refs in rows:
            for field, to in zip("ab", refs):
                held = [x for x, k, *_ in rows if k == to]
                if (r, field) not in sick and all(any((x, f) in sick for f in "ab") for x in held):
                    sick[r, field] = "inherited" if held else "direct"
                    changed = True
    df = spark.createDataFrame(rows, "row string, id string, a string, b string")
    got = O.orphan_cascade([O.Child("n", df, F.col("row"), None, {"a": "n", "b": "n"})], {"n": [O.Parent("n", df, "id", row_id=F.col("row"))]}, {"n": []})
    assert {(r.row_id, r.ref_field): r.orphan_kind for r in got.collect()} == sick


def test_reasons(spark):
    parents = [O.Parent("p", spark.createDataFrame([("a", T[2], T[4], None)], PARENT), "id", "a", "z")]
    c = O.Child("c", spark.createDataFrame([(1, T[1], "a", None, None), (2, T[5], "a", None, None), (3, T[3], "b", None, None)], CHILD), F.col("row_id"), "at", {"ref": "p"})
    got = O.why_missing(O.orphan_cascade([c], {"p": parents}), parents)
    assert {r.row_id: r.reason for r in got.collect()} == {"1": "not_yet", "2": "removed", "3": "never"}
