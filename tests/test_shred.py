import json

from hypothesis import HealthCheck, given, settings, strategies as st

from symgraph.operators.shred import assemble, element_level, shred

SCHEMA = {"id": None, "g": {"x": None}, "a": [{"k": None, "p": {"q": None}, "b": [{"v": None}]}]}


def _shredded(spark, bodies):
    return shred(spark.createDataFrame([(i, b, "clash") for i, b in enumerate(bodies)], "doc long, body string, id string"), "body", ["doc"], SCHEMA)


def test_levels(spark):
    r = _shredded(spark, ['{"id": 7, "a": [{"k": "1", "b": [{"v": 1}, null, {}]}, 5, {"b": []}]}']).head()
    assert (r["a/b/v"].r, r["a/b/v"].d, r["a/b/v"].v) == ([0, 2, 2, 1, 1], [5, 3, 4, 1, 2], ["1", None, None, None, None])
    assert (r["a/k"].r, r["a/k"].d, r["id"].v) == ([0, 1, 1], [3, 1, 2], ["7"])
    assert element_level(SCHEMA, "a") == (1, 1) and element_level(SCHEMA, "a.b") == (2, 3)


def test_bad_bodies_and_other_types(spark):
    bodies = [None, "", "{", "[1]", "null", '{"a": NaN}', '{"a": {"k": true}}', '{"a": "x"}', '{"a": null}', '{"id": {"z": [1, "\\ud800"]}, "g": 3, "a": []}']
    got = _shredded(spark, bodies)
    assert [r.valid for r in got.orderBy("doc").collect()] == [False] * 6 + [True] * 4
    rows = assemble(got, SCHEMA, "a", ["doc"], {"a.k": "k"}, {"id": "id"}).collect()
    assert [(r.doc, r.pos_1, r.k, r.id) for r in rows] == [(6, 0, "true", None)]
    docs = {r.doc: r.id for r in assemble(got, SCHEMA, "", ["doc"], {"id": "id"}).collect()}
    assert docs == {6: None, 7: None, 8: None, 9: '{"z":[1,"?"]}'}


def test_empty_table(spark):
    assert assemble(_shredded(spark, []), SCHEMA, "a", ["doc"], {"a.k": "k"}).count() == 0


leaf = st.one_of(st.none(), st.integers(-5, 5), st.text(max_size=3))
inner = st.one_of(leaf, st.fixed_dictionaries({}, optional={"v": leaf}))
outer = st.one_of(leaf, st.fixed_dictionaries({}, optional={"k": leaf, "p": st.one_of(leaf, st.fixed_dictionaries({}, optional={"q": leaf})), "b": st.one_of(leaf, inner, st.lists(inner, max_size=3))}))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.fixed_dictionaries({}, optional={"id": leaf, "a": st.one_of(outer, st.lists(outer, max_size=4))}), max_size=5))
def test_round_trip_against_brute_force(spark, docs):
    listed = lambda x: x if isinstance(x, list) else [x] if isinstance(x, dict) else []
    text = lambda x: None if x is None else str(x)
    get = lambda x, k: x.get(k) if isinstance(x, dict) else None
    shredded = _shredded(spark, [json.dumps(d) for d in docs])
    a = assemble(shredded, SCHEMA, "a", ["doc"], {"a.k": "k", "a.p.q": "q"}, {"id": "id"})
    want = [(i, j, text(get(x, "k")), text(get(get(x, "p"), "q")), text(d.get("id"))) for i, d in enumerate(docs) for j, x in enumerate(listed(d.get("a")))]
    assert sorted(((r.doc, r.pos_1, r.k, r.q, r.id) for r in a.collect()), key=str) == sorted(want, key=str)
    b = assemble(shredded, SCHEMA, "a.b", ["doc"], {"a.b.v": "v"})
    want = [(i, j, m, text(get(y, "v"))) for i, d in enumerate(docs) for j, x in enumerate(listed(d.get("a"))) for m, y in enumerate(listed(get(x, "b")))]
    assert sorted(((r.doc, r.pos_1, r.pos_2, r.v) for r in b.collect()), key=str) == sorted(want, key=str)
