import json
import subprocess

import pytest

from symgraph.__main__ import main
from symgraph.operators import render

pytest.importorskip("yaml")


def _doc(i, name, path, line):
    return f"--- !Symbol\nID: {i}\nName: {name}\nScope: ''\nSymInfo: {{Kind: Function, Lang: C}}\nDefinition:\n  FileURI: 'file://{path}'\n  Start: {{Line: {line}, Column: 4}}\n  End: {{Line: {line}, Column: 5}}\n...\n"


def _refs(callee, caller, path, line):
    return f"--- !Refs\nID: {callee}\nReferences:\n  - Kind: 20\n    Location:\n      FileURI: 'file://{path}'\n      Start: {{Line: {line}, Column: 2}}\n      End: {{Line: {line}, Column: 3}}\n    Container: {{ID: {caller}}}\n...\n"


def test_build_update_and_ask(spark, tmp_path, capsys):
    root, a, b = tmp_path / "p", "A" * 16, "B" * 16
    (root / "inc").mkdir(parents=True)
    git = lambda *x: subprocess.run(["git", "-C", str(root), "-c", "user.name=t", "-c", "user.email=t@t", *x], check=True, capture_output=True)
    git("init", "-q")
    (root / "inc" / "k.h").write_text("int f(void);\n")
    (root / "x.c").write_text('#include "inc/k.h"\nint f(void) {\n  return 1;\n}\n')
    (root / "y.c").write_text('#include "inc/k.h"\nint g(void) {\n  f();\n}\n')
    git("add", "."), git("commit", "-qm", "1")
    index = tmp_path / "index.yaml"
    index.write_text(_doc(a, "f", f"{root}/x.c", 1) + _doc(b, "g", f"{root}/y.c", 1) + _refs(a, b, f"{root}/y.c", 2))
    g1, g2, g3 = (f"file://{tmp_path}/g{i}" for i in (1, 2, 3))
    main(["build", f"file://{index}", str(root), g1, "--cache", f"file://{tmp_path}/cache", "--enrich"], spark)
    assert [tuple(r) for r in spark.read.parquet(f"{g1}/calls").collect()] == [(b, a)]
    assert spark.read.parquet(f"{g1}/function").filter("summary is not null and body_location is not null").count() == 2
    main(["impact", g1, "inc/k.h"], spark)
    assert "x.c, y.c" in capsys.readouterr().out

    (root / "y.c").unlink()
    git("add", "-A"), git("commit", "-qm", "2")
    index.write_text(_doc(a, "f", f"{root}/x.c", 1))
    main(["update", f"file://{index}", str(root), g1, "--to", g2], spark)
    assert spark.read.parquet(f"{g2}/calls").count() == 0 and [r.path for r in spark.read.parquet(f"{g2}/file").orderBy("path").collect()] == ["inc/k.h", "x.c"]
    assert spark.read.parquet(f"{g2}/function").filter("summary is not null").count() == 1
    main(["delete-property", g2, "summary", g3, "--label", "function"], spark)
    assert spark.read.parquet(f"{g3}/function").filter("summary is not null").count() == 0
    (tmp_path / "s.sql").write_text("// names\nselect name as only_name from function;\nselect x from nowhere")
    main(["script", g3, str(tmp_path / "s.sql")], spark)
    main(["schema", g3], spark), main(["spans", str(root)], spark), main(["markers", str(index), "--count-repeats"], spark), main(["stats", f"file://{index}", str(root)], spark)
    out = capsys.readouterr().out
    assert "only_name" in out and "(FILE)-[DEFINES]->(FUNCTION): 1" in out and "--- !Symbol" in out
    with pytest.raises(SystemExit):
        main(["update", f"file://{index}", "/elsewhere", g1, "--to", g2], spark)


def test_drawing_escapes_labels(spark):
    tree = spark.createDataFrame([("a", None, 'say "x"\n \\ y'), ("b", "a", "z" * 60)], "k string, up string, label string")
    assert sorted(r.line for r in render.dot_lines(tree, "k", "up", "label").collect()) == ['  "a" -> "b";', '  "a" [label="say \\"x\\" \\\\ y"];', '  "b" [label="zzzzzzzzzzzzzzz ... zzzzzzzzzzzzzzz"];']


def test_topk_in_many_blocks(spark):
    from symgraph.operators import enrich

    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)] + [(100, None), (101, [1.0]), (102, [float("nan"), 1.0, 1.0]), (5, [5.0, 1.0, 2.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    one = enrich.cosine_topk(df.filter("id < 20"), df, "id", "v", 3, 4)
    many = enrich.cosine_topk(df.filter("id < 20"), df, "id", "v", 3, 4, query_bytes=200)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect())) and one.count() == 80
    assert enrich.cosine_topk(df.limit(0), df, "id", "v", 3, 4).count() == 0


def test_further_commands(spark, tmp_path, capsys):
    root, a, b = tmp_path / "p", "A" * 16, "B" * 16
    (root / "inc").mkdir(parents=True)
    (root / "inc" / "k.h").write_text("int f(void);\n")
    (root / "x.c").write_text('#include "inc/k.h"\nint f(void) {\n  return 1;\n}\n'), (root / "y.c").write_text("#include <k.h>\nint g(void) {\n  f();\n}\n")
    git = lambda *x: subprocess.run(["git", "-C", str(root), "-c", "user.name=t", "-c", "user.email=t@t", *x], check=True, capture_output=True)
    git("init", "-q"), git("add", "."), git("commit", "-qm", "1")
    git("mv", "y.c", "z.c"), git("commit", "-qm", "2")
    index, commands, g1 = tmp_path / "index.yaml", tmp_path / "db.json", f"file://{tmp_path}/g1"
    index.write_text(_doc(a, "f", f"{root}/x.c", 1) + _doc(b, "g", f"{root}/z.c", 1) + _refs(a, b, f"{root}/z.c", 2))
    commands.write_text(json.dumps([{"file": f"{root}/z.c", "directory": str(root), "command": "cc -c -Iinc z.c"}]))
    main(["diff", str(root), "HEAD~1"], spark), main(["headers", str(root)], spark), main(["outline", f"file://{root}/x.c"], spark)
    main(["impact", f"file://{commands}", "inc/k.h", "k.h", "--root", str(root)], spark), main(["spans", str(root), "--json"], spark)
    out = capsys.readouterr().out
    assert "renamed_exact: 1\n  y.c -> z.c" in out and "added: 0" in out and f"{root}/x.c, {root}/z.c" in out and '"functions":[{' in out
    assert f"{root}/k.h is included nowhere; of the same name: {root}/inc/k.h" in out and 'label="int f ("' in out
    main(["calls", f"file://{index}", str(root), f"file://{tmp_path}/edges"], spark), main(["nodes", f"file://{index}", str(root), f"file://{tmp_path}/nodes"], spark)
    main(["calls", f"file://{index}", str(root), f"file://{tmp_path}/script", "--script"], spark)
    assert [tuple(r) for r in spark.read.parquet(f"file://{tmp_path}/edges").collect()] == [(b, a)] and spark.read.parquet(f"file://{tmp_path}/nodes/function").count() == 2
    assert spark.read.text(f"file://{tmp_path}/script").head()[0] == f"INSERT INTO calls (caller_id, callee_id) VALUES ('{b}', '{a}');"
    main(["build", f"file://{index}", str(root), g1, "--enrich", "--compile-commands", f"file://{commands}"], spark)
    assert spark.read.parquet(f"{g1}/includes").count() == 2
    main(["schema", g1, "--json"], spark), main(["vectors", g1, "write"], spark), main(["vectors", g1, "show"], spark), main(["--memory", "schema", g1], spark)
    out = capsys.readouterr().out
    assert '"key": "path"' in out and "size=" in out and spark.read.parquet(f"{g1}/vectors-function").count() == 2
    main(["vectors", g1, "drop"], spark)
    assert not (tmp_path / "g1/vectors-function").exists()


def test_update_reads_and_asks_only_what_changed(spark, tmp_path, capsys):
    root, a, b = tmp_path / "p", "A" * 16, "B" * 16
    root.mkdir()
    git = lambda *x: subprocess.run(["git", "-C", str(root), "-c", "user.name=t", "-c", "user.email=t@t", *x], check=True, capture_output=True)
    git("init", "-q")
    (root / "x.c").write_text("int f(void) {\n  return 1;\n}\n"), (root / "y.c").write_text("int g(void) {\n  return 2;\n}\n")
    git("add", "."), git("commit", "-qm", "1")
    index = tmp_path / "index.yaml"
    index.write_text(_doc(a, "f", f"{root}/x.c", 0) + _doc(b, "g", f"{root}/y.c", 0) + _refs(a, b, f"{root}/y.c", 1))
    g1, g2, g3 = (f"file://{tmp_path}/g{i}" for i in (1, 2, 3))
    main(["build", f"file://{index}", str(root), g1, "--enrich"], spark)
    main(["update", f"file://{index}", str(root), g1, "--to", g2], spark)
    assert "already at" in capsys.readouterr().out and spark.read.parquet(f"{g2}/function").count() == 2
    (root / "x.c").write_text("int f(void) {\n  return 3;\n}\n")
    git("add", "."), git("commit", "-qm", "2")
    (root / "y.c").write_text("not looked at {\n")  # a clean file, whatever the tree holds now
    main(["update", f"file://{index}", str(root), g1, "--to", g3, "--enrich"], spark)
    got = {r.id: (r.body_location, r.code_summary is not None) for r in spark.read.parquet(f"{g3}/function").collect()}
    assert got == {a: ([0, 0, 2, 0], True), b: ([0, 0, 2, 0], True)}
    assert [tuple(r) for r in spark.read.parquet(f"{g3}/calls").collect()] == [(b, a)]
    main(["delete-property", g3, "commit_hash", g2], spark)
    with pytest.raises(SystemExit, match="--old"):
        main(["update", f"file://{index}", str(root), g2, "--to", g3], spark)
