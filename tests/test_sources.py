import json
import subprocess

import pytest

from symgraph.operators import store
from symgraph.sources import code, git, markers

INDEX = """--- !Symbol
ID: 00000000000000E1
Name: f
Scope: ''
SymInfo:
\tKind: Function
\tLang: C
Definition:
  FileURI: 'file:///p/a.c'
  Start: {Line: 1, Column: 4}
  End: {Line: 1, Column: 5}
Unknown: [1, 2]
...
--- !Refs
ID: 00000000000000E1
References:
  - Kind: 20
    Location:
      FileURI: 'file:///p/a.c'
      Start: {Line: 9, Column: 2}
      End: {Line: 9, Column: 3}
    Container: {ID: 0000000000000012}
  - Kind: 4
...
--- !Relations
Subject: {ID: 00000000000000E1}
Predicate: 0
Object: {ID: 0000000000000012}
...
--- !Symbol
ID: [broken
...
--- !Symbol
ID: 00000000000000E1
Name: f2
SymInfo: {Kind: Function, Lang: C}
...
"""


def test_index_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    from symgraph.sources.index_yaml import read_index, symbols_and_refs

    (tmp_path / "index.yaml").write_text(INDEX)
    docs = read_index(spark, f"file://{tmp_path}/index.yaml")
    assert [r.error is None for r in docs.orderBy("doc_seq").collect()] == [True, True, True, False, True]
    symbols, refs = symbols_and_refs(docs.filter("error is null").select("doc_seq", "body"))
    assert [(r.id, r.name, r.kind, r.scope) for r in symbols.collect()] == [("00000000000000E1", "f2", "Function", "")]
    assert [(r.symbol_id, r.container_id, r.kind, r.location.start_line) for r in refs.collect()] == [("00000000000000E1", "0000000000000012", 20, 9)]


SOURCE = """#include "k.h"
#include <stdio.h>
/* int no(void) { } */
struct s { int x; };
static int a[] = { 1, 2 };
static const char *
pointer_result(int (*cb)(int), const char *s)
{
    if (s) { return "}"; }
    return s; // }
}
#define M(x) do { x; } while (0)
extern "C" {
int two(void) { return '{'; }
}
int declared(void);
"""


def test_scanner(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.c").write_text(SOURCE)
    (tmp_path / "d" / "bad.h").write_bytes(b"\xff int f(void) {")
    (tmp_path / "d" / "no.txt").write_text("int f(void) { }")
    spans, includes = code.extract(code.read_tree(spark, f"file://{tmp_path}"))
    got = {(r.name, r.line, r.column, tuple(r.body)) for r in spans.collect() if r.file.endswith("x.c")}
    assert got == {("pointer_result", 6, 0, (5, 0, 10, 0)), ("two", 13, 4, (13, 0, 13, 28))}
    assert [(r.including, r.included) for r in includes.collect()] == [(f"{tmp_path}/d/x.c", f"{tmp_path}/d/k.h")]


def test_header_languages(spark):
    rows = [("/a/x.h", "class C {};"), ("/a/x.c", ""), ("/b/y.h", "int f(void);"), ("/b/y.CPP", ""), ("/c/p.h", "// class\n#define class x\nint f(int a, int b); char *s = \"std::x\";"), ("/c/q.h", "namespace n { }"), ("/c/r.h", None), ("/c/s.h", "void f(int &x);"), ("/c/t.h", "int m = a & b;")]
    got = {r.path: r.language for r in code.header_languages(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got == {"/a/x.h": "C", "/b/y.h": "C++", "/c/p.h": "C", "/c/q.h": "C++", "/c/r.h": "C", "/c/s.h": "C++", "/c/t.h": "C"}


def test_a_failing_extractor_drops_only_its_file(spark):
    def fail(path, text):
        if path == "/b.c":
            raise ValueError
        return code.scan_c(path, text)

    spans, _ = code.extract(spark.createDataFrame([("/a.c", "int f(void) { }"), ("/b.c", "x"), ("/c.c", None)], "path string, text string"), fail)
    assert [r.name for r in spans.collect()] == ["f"]


def test_compile_commands(spark, tmp_path):
    entries = [{"file": "a.c", "directory": "/p", "arguments": ["cc", "-c", "-Ix", "-o", "a.o", "-MMD", "-DX", "/p/a.c"]}, {"file": "/p/a.c", "directory": "/p", "command": "cc -DLATER a.c"}, {"file": "/p/b.c", "directory": "/p", "command": " gcc  -DB b.c "}]
    (tmp_path / "compile_commands.json").write_text(json.dumps(entries, indent=1))
    got = {r.file: r.arguments for r in code.read_compile_commands(spark, f"file://{tmp_path}/compile_commands.json").collect()}
    assert got == {"/p/a.c": ["-Ix", "-DX"], "/p/b.c": ["-DB"]}


def test_git(spark, tmp_path):
    run = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=t", "-c", "user.email=t@t", *a], check=True, capture_output=True)
    run("init", "-q")
    (tmp_path / "a.c").write_text("int f(void) { return 1; }\n")
    (tmp_path / "gone.h").write_text("int g;\n")
    (tmp_path / "old.txt").write_text("moved text\n")
    run("add", "."), run("commit", "-qm", "1")
    first = git.head(str(tmp_path))
    (tmp_path / "a.c").write_text("int f(void) { return 2; }\n")
    (tmp_path / "gone.h").unlink()
    (tmp_path / "old.txt").rename(tmp_path / "new.c")
    run("add", "-A"), run("commit", "-qm", "2")
    got = git.source_changes(spark, str(tmp_path), first)
    assert sorted(map(tuple, got.collect())) == [("added", "new.c"), ("deleted", "gone.h"), ("deleted", "old.txt"), ("modified", "a.c")]
    assert git.repository(str(tmp_path)) and git.is_clean(str(tmp_path))
    with pytest.raises(ValueError):
        git.repository("/")


def test_markers(spark):
    df = spark.createDataFrame([(1, "--- !A\nx\n--- !A\n--- !B\n--- !A"), (2, None), (3, "")], "d int, t string")
    assert sorted(map(tuple, markers.marker_lines(df, "d", "t", "--- !").collect())) == [("--- !A", 1), ("--- !B", 1)]
    assert sorted(map(tuple, markers.marker_runs(df, "d", "t", "--- !").collect())) == [(1, 1, "--- !A", 2), (1, 2, "--- !B", 1), (1, 3, "--- !A", 1)]


def test_script(spark):
    out = store.run_script(spark, "// a comment\nselect 1 as x;\n\nselect nothing from nowhere;\n-- more\nselect 2 as x")
    assert [(df.head().x if df else None, e is None) for _, df, e in out] == [(1, True), (None, False), (2, True)]


def test_includes_by_compile_commands(spark):
    sources = spark.createDataFrame([
        ("/p/src/a.c", '#include "own.h"\n#include <lib/x.h>\n#include <stdio.h>\n#include "gone.h"\n#include "../up.h"\n'),
        ("/p/src/own.h", "#include <lib/x.h>\n"), ("/p/up.h", ""), ("/p/inc/lib/x.h", ""), ("/p/inc2/lib/x.h", ""), ("/p/other/b.c", "#include <lib/x.h>\n"),
    ], "path string, text string")
    commands = spark.createDataFrame([("/p/src/a.c", "/p", ["-Iinc", "-DX", "-isystem", "/p/inc2"]), ("/p/other/b.c", "/p/other", ["-DX", "-I", "../inc2"])], "file string, directory string, arguments array<string>")
    _, includes = code.extract(sources, commands=commands)
    assert sorted(map(tuple, includes.collect())) == [
        ("/p/other/b.c", "/p/inc2/lib/x.h"), ("/p/src/a.c", "/p/inc/lib/x.h"), ("/p/src/a.c", "/p/src/gone.h"), ("/p/src/a.c", "/p/src/own.h"), ("/p/src/a.c", "/p/up.h"), ("/p/src/own.h", "/p/inc/lib/x.h"),
    ]


def test_commands_are_split_as_a_shell_does(spark, tmp_path):
    db = [{"file": "a.c", "directory": "/p", "command": "cc -c -DNAME='\"a b\"' -I 'my inc' -o a.o a.c"}, {"file": "/p/b.c", "directory": "/p", "command": "cc 'broken b.c"}]
    (tmp_path / "db.json").write_text(json.dumps(db))
    got = {r.file: r.arguments for r in code.read_compile_commands(spark, f"file://{tmp_path}/db.json").collect()}
    assert got["/p/a.c"] == ['-DNAME="a b"', "-I", "my inc"]


def test_diff_records_are_read_in_parts():
    import io

    raw = b":1 2 a b A\0x\ny\0:1 2 a b R100\0old\0new\0:1 2 a b M\0z\0"
    want = [("A", "x\ny", None), ("R100", "new", "old"), ("M", "z", None)]
    assert all(list(git._records(io.BytesIO(raw), size)) == want for size in (1, 3, 1000))


def test_files_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.c").write_bytes(b"x\xff")
    names = spark.createDataFrame([(f"{tmp_path}/a.c",), (f"{tmp_path}/none.c",), (f"{tmp_path}/a.c",)], "path string")
    assert [tuple(r) for r in code.read_files(names).collect()] == [(f"{tmp_path}/a.c", "x�")]


def test_edges_as_a_script(spark):
    script = store.edge_script(spark.createDataFrame([("a'b", None)], "caller_id string, callee_id string"), "calls")
    assert script.head()[0] == "INSERT INTO calls (caller_id, callee_id) VALUES ('a''b', NULL);"
