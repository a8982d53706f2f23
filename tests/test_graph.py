import zlib

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import mini
from symgraph.api import CodeGraph
from symgraph.functions import paths as P
from symgraph.operators import calls, changes, enrich, nodes, store, traverse

KINDS = [{}, {"containers": False}, {"containers": False, "new_kinds": False}]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def built(spark):
    return CodeGraph.build(spark, "/p", mini.version_a(spark), commit="1")


def test_nodes_and_edges(built):
    t = built.tables
    assert rows(t["function"], "id", "file_path") == [("F", "a/x.c"), ("G", "a/x.c"), ("H1", "a/y.c"), ("H2", "b/z.c"), ("P", "a/sp ace+x.c"), ("R", "r.c")]
    assert rows(t["data_structure"], "id") == [("E",), ("T",)]
    assert rows(t["file"], "path") == [("a/sp ace+x.c",), ("a/x.c",), ("a/y.c",), ("b..h/w.h",), ("b/k.h",), ("b/m.h",), ("b/z.c",), ("r.c",)]
    assert rows(t["folder"], "path", "parent_path") == [("a", "/p"), ("b", "/p"), ("b..h", "/p")]
    assert rows(t["calls"], "caller_id", "callee_id") == [("F", "H2"), ("G", "F"), ("G", "G"), ("H2", "F"), ("R", "H1"), ("R", "P")]
    assert rows(t["includes"], "including", "included") == [("a/x.c", "b/k.h"), ("a/y.c", "b..h/w.h"), ("b/k.h", "b/m.h"), ("b/m.h", "b/k.h"), ("b/z.c", "b/m.h")]
    assert ("PROJECT", "/p", "FILE", "r.c") in rows(t["contains"], "src_label", "src", "dst_label", "dst")
    assert {r.id: r.body_location for r in t["function"].collect()}["G"] == [7, 0, 12, 1]
    assert "(FUNCTION)-[CALLS]->(FUNCTION): 6" in built.schema()


@pytest.mark.parametrize("kinds", KINDS[1:])
def test_bodies_and_containers_give_the_same_calls(spark, built, kinds):
    other = CodeGraph.build(spark, "/p", mini.version_a(spark, **kinds))
    assert rows(other.tables["calls"], "caller_id", "callee_id") == rows(built.tables["calls"], "caller_id", "callee_id")


@pytest.mark.parametrize("kinds", KINDS)
def test_update_equals_rebuild(spark, kinds):
    changed = changes.fold(spark.createDataFrame(mini.CHANGES, "change_type string, path string, original string"), [])
    new = mini.version_b(spark, **kinds)
    updated = CodeGraph.build(spark, "/p", mini.version_a(spark, **kinds), commit="1").update(new, changed, "2")
    rebuilt = CodeGraph.build(spark, "/p", new, commit="2")
    for name, df in rebuilt.tables.items():
        assert rows(updated.tables[name], *[F.col(c).cast("string") for c in df.columns]) == rows(df, *[F.col(c).cast("string") for c in df.columns]), name


def test_update_tells_the_format_by_the_whole_index(spark):
    """Containers are there, but none near the changes: plain references beside them must not become calls."""
    sym = [mini.symbol("F", "f", definition=mini.at("/p/a.c", 0)), mini.symbol("Q", "q", definition=mini.at("/p/b.c", 0)), mini.symbol("G", "g", definition=mini.at("/p/c.c", 0)), mini.symbol("H", "h", definition=mini.at("/p/d.c", 0))]
    refs = spark.createDataFrame([(1, "H", "G", 20, mini.at("/p/c.c", 2)), (2, "Q", None, 4, mini.at("/p/a.c", 2)), (3, "F", None, 1, mini.at("/p/a.c", 0))], mini.REF)
    spans = spark.createDataFrame([(f"/p/{x}.c", n, 0, 0, [0, 0, 9, 1], i) for i, (x, n) in enumerate(zip("abcd", "fqgh"))], mini.SPAN)
    x = mini.Inputs(spark.createDataFrame(sym, mini.SYMBOL), refs, spans, spark.createDataFrame([], "including string, included string"))
    graph = CodeGraph.build(spark, "/p", x, commit="1")
    assert rows(graph.tables["calls"], "caller_id", "callee_id") == [("G", "H")]
    again = graph.update(x, spark.createDataFrame([("modified", "a.c")], "change_type string, path string"), "2")
    assert rows(again.tables["calls"], "caller_id", "callee_id") == [("G", "H")]


@pytest.mark.parametrize("kinds", KINDS)
def test_stats_in_any_format(spark, built, kinds):
    got = built.call_stats(mini.version_a(spark, **kinds).refs).head()
    assert (got.n_functions, got.n_with_body, got.n_calls, got.n_recursive) == (6, 6, 7, 1)


def test_update_without_changes_only_stamps(spark, built):
    none = spark.createDataFrame([], "change_type string, path string")
    assert built.update(mini.version_a(spark), none, "9").tables["project"].head().commit_hash == "9"


def test_save_and_load(spark, built, tmp_path):
    built.save(f"file://{tmp_path}")
    again = CodeGraph.load(spark, f"file://{tmp_path}")
    assert again.root == "/p" and rows(again.tables["calls"], "caller_id", "callee_id") == rows(built.tables["calls"], "caller_id", "callee_id")


def test_enrichment_rolls_up(spark, built):
    sources = spark.createDataFrame([(p, "".join(f"line {i}\n" for i in range(20))) for p in ("a/x.c", "a/y.c", "b/z.c", "r.c")], "path string, text string")
    echo = lambda prompts: [f"about {zlib.crc32(p.encode())}" for p in prompts]
    done = built.enrich(sources, echo)
    t = done.tables
    assert {r.id for r in t["function"].filter("code_summary is not null").collect()} == {"F", "G", "H1", "H2", "R"}
    assert t["file"].filter("summary is not null").count() == 4 and rows(t["folder"].filter("summary is not null"), "path") == [("a",), ("b",)]
    assert t["project"].head().summary.startswith("about") and len(t["project"].head().summary_embedding) == 384
    q = t["function"].filter("id = 'F'").select("id", "summary_embedding")
    assert done.search(q, k=2).count() == 2
    assert rows(done.impact(spark.createDataFrame([("b/m.h",)], "path string")), "node") == [("a/x.c",), ("b/k.h",), ("b/m.h",), ("b/z.c",)]

    # Again for one function: R calls it, so R hears another code summary; their files, the folder above and the project follow, nothing else.
    shorter = sources.withColumn("text", F.when(F.col("path") == "a/y.c", F.lit("other\ntext\n")).otherwise(F.col("text")))
    again = done.enrich(shorter, echo, only=spark.createDataFrame([("H1",)], "id string"), changed=spark.createDataFrame([("deleted", "b/none.c")], "change_type string, path string"))
    differs = lambda kind, key: {r[0] for r in again.tables[kind].select(key, "summary").exceptAll(t[kind].select(key, "summary")).collect()}
    assert differs("function", "id") == {"H1", "R"} and differs("file", "path") == {"a/y.c", "r.c"} and differs("folder", "path") == {"a"} and differs("project", "path") == {"/p"}
    assert again.tables["function"].filter("summary is not null and summary_embedding is null").count() == 0


def test_failures_are_kept_and_retries_help(spark, built):
    sources = spark.createDataFrame([("a/x.c", "x\n" * 20), ("r.c", "r\n" * 20)], "path string, text string")

    def no_files(prompts):
        if any(p.startswith("The file") for p in prompts):
            raise OSError("away")
        return ["said"] * len(prompts)

    done = built.enrich(sources, no_files)
    assert {(r.label, r.error) for r in done.failures.collect()} == {("file", "OSError: away")} and done.tables["file"].filter("summary is not null").count() == 0
    asked = []

    def third_time(batch):
        asked.append(1)
        if len(asked) < 3:
            raise OSError
        return batch

    assert enrich.patient(third_time, 3, 0)(["x"]) == ["x"] and len(asked) == 3
    with pytest.raises(ZeroDivisionError):
        enrich.patient(lambda b: 1 / 0, 2, 0)(["x"])


def test_http_plugin():
    import http.server
    import json
    import threading

    class Echo(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            said = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            self.send_response(200), self.end_headers()
            self.wfile.write(json.dumps({"out": [{"text": said["in"].upper()}]}).encode())

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Echo)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    ask = enrich.http_plugin(f"http://127.0.0.1:{server.server_port}/", lambda x: {"in": x}, lambda r: r["out"][0]["text"], timeout=5)
    assert ask(["a", "b"]) == ["A", "B"]
    server.shutdown()


def test_shortcuts_change_nothing(spark, monkeypatch):
    edges = spark.createDataFrame([(f"{c}{i}", f"{c}{i + 1}") for c in "abc" for i in range(20)] + [("a0", "a19"), ("b19", "b3")], "x string, y string")
    seeds = spark.createDataFrame([(f"{c}{i}",) for c in "abc" for i in (5, 20, 30)], "s string")
    got = []
    for shortcuts, many in ((32, 0), (2, 0), (32, 10)):
        monkeypatch.setattr(traverse, "SHORTCUTS", shortcuts), monkeypatch.setattr(traverse, "MANY_SEEDS", many)
        got.append(rows(traverse.reach(edges, seeds, "x", "y"), "seed", "node"))
    assert got[0] == got[1] == got[2] and len(got[0]) > 70
    together = traverse.reach(edges, seeds.selectExpr("substr(s, 1, 1) as l", "s"), "x", "y", label="l")
    assert rows(together, "seed", "node") == sorted({(a[0], b) for a, b in got[0]})


def test_context_is_what_the_neighbours_do(spark):
    f = spark.createDataFrame([("a", "does a"), ("b", None), ("c", ""), ("d", "does d"), ("e", "does d")], "id string, code_summary string")
    c = spark.createDataFrame([("a", "d"), ("b", "d"), ("c", "d"), ("d", "d"), ("a", "e"), ("a", "zz")], "caller_id string, callee_id string")
    got = {r.id: (r.callers, r.callees) for r in traverse.call_context(f, c).collect()}
    assert got == {"a": ([], ["does d"]), "b": ([], ["does d"]), "c": ([], ["does d"]), "d": (["does a", "does d"], ["does d"]), "e": (["does a"], [])}
    prompt = enrich.context_prompts(f.filter("id = 'a'"), traverse.call_context(f, c, f.filter("id = 'a'"))).head().prompt
    assert "called by: none" in prompt and "It calls: does d\n" in prompt


def test_failed_summaries_keep_the_old_value(spark):
    nodes_ = spark.createDataFrame([("a", "old", [1.0]), ("b", "same", [1.0])], "id string, summary string, summary_embedding array<float>")

    def flaky(prompts):
        raise RuntimeError

    prompts = spark.createDataFrame([("a", "x")], "id string, prompt string")
    assert [tuple(r) for r in enrich.summarize(prompts, ["id"], flaky).collect()] == [("a", None, "RuntimeError: ")]
    assert [r.error for r in enrich.summarize(prompts, ["id"], lambda x: [""]).collect()] == ["empty answer"]
    new = spark.createDataFrame([("a", "new"), ("b", "same")], "id string, new_summary string")
    got = {r.id: (r.summary, r.summary_embedding) for r in enrich.apply_summaries(nodes_, new, ["id"]).collect()}
    assert got == {"a": ("new", None), "b": ("same", [1.0])}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), max_size=12), st.sets(st.integers(0, 6), max_size=2))
def test_reach_against_search(spark, edges, seeds):
    want = set()
    for s in seeds:
        seen, front = set(), {a for a, b in edges if b == s}
        while front:
            seen |= front
            front = {a for a, b in edges if b in front} - seen
        want |= {(s, x) for x in seen}
    got = traverse.reach(spark.createDataFrame(edges, "a int, b int"), spark.createDataFrame([(s,) for s in seeds], "s int"), "a", "b")
    assert {tuple(r) for r in got.collect()} == want


def test_enclosing_body_ends_and_first_match(spark):
    bodies = spark.createDataFrame([("o", "x.c", 1, 4, 200, 0, "o"), ("i", "x.c", 50, 0, 60, 9, "i"), ("s", "x.c", 1, 4, 3, 0, "s")], "id string, file string, start_line int, start_column int, end_line int, end_column int, seq string")
    sites = spark.createDataFrame([(1, "x.c", 1, 4), (2, "x.c", 1, 3), (3, "x.c", 200, 0), (4, "x.c", 200, 1), (5, "x.c", 55, 0), (6, "y.c", 55, 0), (7, None, 1, 4), (8, "x.c", None, 4)], "site_id int, file string, line int, column int")
    assert sorted((r.site_id, r.id) for r in calls.enclosing_bodies(sites, bodies).collect()) == [(1, "o"), (1, "s"), (3, "o"), (5, "i"), (5, "o")]
    assert sorted((r.site_id, r.id) for r in calls.first_enclosing_body(sites, bodies).collect()) == [(1, "o"), (3, "o"), (5, "o")]


def test_overlay_keeps_and_removes(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "z")], "id string, n int, a_n string")
    new = spark.createDataFrame([("a", None, ["a_n"]), ("c", 5, None), (None, 7, None)], "id string, n int, gone array<string>")
    assert sorted(map(tuple, store.overlay(old, new, ["id"], "gone").collect()), key=str) == sorted([("a", 1, None), ("b", 2, "y"), ("c", 5, None), (None, 7, "z")], key=str)
    with pytest.raises(ValueError):
        store.check_unique(old.unionByName(old), "id")


def test_raw_diff(spark):
    raw = "\x00".join([":1 1 a b M", "m.c", ":1 1 a b R100", "o.txt", "n.c", ":1 1 a b C100", "s.c", "t.c", ":1 1 a b R090", "u.c", "w.c", ":1 1 a b T", "t", ":0 1 a b A", "x y.h", ":1 0 a b D", "d.c", ""])
    got = changes.classify(changes.parse_raw_diff(spark.createDataFrame([(raw,), (None,), ("",)], "raw string"), "raw", []))
    assert [(r.change_type, r.path, r.original) for r in got.orderBy("seq").collect()] == [("modified", "m.c", None), ("renamed_exact", "n.c", "o.txt"), ("copied_exact", "t.c", "s.c"), ("added", "x y.h", None), ("deleted", "d.c", None)]
    assert rows(changes.fold(got, []), "change_type", "path") == [("added", "n.c"), ("added", "t.c"), ("added", "x y.h"), ("deleted", "d.c"), ("deleted", "o.txt"), ("modified", "m.c")]


def test_paths(spark):
    df = spark.createDataFrame([("file:///p/a%20b/c+d.c",), ("file://host/p/x.c?q#f",), ("http://h/p",), (None,), ("file:///p/50%",)], "u string")
    assert [r[0] for r in df.select(P.uri_path("u")).collect()] == ["/p/a b/c+d.c", "/p/x.c", "http://h/p", None, "/p/50%"]
    df = spark.createDataFrame([("/p/a/b.c",), ("/p2/a.c",), ("/p",), (None,)], "p string")
    assert [tuple(r) for r in df.select(P.in_project("p", F.lit("/p")), P.relative("p", F.lit("/p")), P.basename("p"), P.parent("p")).collect()] == [(True, "a/b.c", "b.c", "/p/a"), (False, "/p2/a.c", "a.c", "/p2"), (True, "", "p", ""), (None, None, None, None)]
    assert spark.range(1).select(P.ancestors(F.lit("a/b/c.c")), P.ancestors(F.lit("c.c"))).head()[:] == (["a", "a/b"], [])


def test_last_wins(spark):
    df = spark.createDataFrame([(1, "a", "x"), (3, "a", None), (2, "a", "y"), (1, None, "n")], "seq int, k string, _row string")
    assert rows(nodes.last_wins(df, ["k"], ["seq"]).na.fill("~"), "seq", "k") == [(1, "~"), (3, "a")]


def test_cosine_topk_against_brute_force(spark, data):
    import numpy as np

    e = spark.read.parquet(f"{data}/embeddings.parquet")
    got = enrich.cosine_topk(e.filter("vec_id % 100 = 0"), e, "vec_id", "embedding", 64, 3).collect()
    all_ = e.toPandas()
    x = np.stack(all_["embedding"]).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for q in all_.index[all_["vec_id"] % 100 == 0]:
        s = np.round(x @ x[q], 6)
        s[q] = -9
        assert [r.id for r in sorted((r for r in got if r.query_id == all_["vec_id"][q]), key=lambda r: r["rank"])] == [int(all_["vec_id"][i]) for i in np.lexsort((all_["vec_id"], -s))[:3]]
