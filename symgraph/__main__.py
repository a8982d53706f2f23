"""Command line: python -m symgraph COMMAND ..."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from symgraph.api import CodeGraph, Inputs
from symgraph.functions import paths as P
from symgraph.operators import calls, enrich, render, store, traverse
from symgraph.session import cut, ship
from symgraph.sources import code, git, markers


def _index(spark: SparkSession, index: str, cache: str | None) -> tuple[DataFrame, DataFrame]:
    from symgraph.sources.index_yaml import cached_index, read_index, symbols_and_refs

    docs = cached_index(spark, index, cache) if cache else read_index(spark, index)
    return symbols_and_refs(docs.filter("body is not null").select("doc_seq", "body"))


def _plugin(name: str | None, default: Callable) -> Callable:
    """The function that MODULE:FUNCTION names."""
    if not name:
        return default
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _extracted(spark: SparkSession, root: str, commands: str | None, sources: DataFrame | None = None, cache: str | None = None, extractor: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(spans, includes) of the given sources, or of the whole tree; includes are looked for in the whole tree.

    What the whole tree of a commit holds is kept below cache, if there is one and the tree is clean.
    """
    commit = _commit(root) if cache and sources is None else None
    at = f"{cache}-sources/{extractor or 'scan'}/{commit}" if commit else None
    if at and _exists(spark, f"{at}/includes/_SUCCESS"):
        return spark.read.schema(code.SPANS).parquet(f"{at}/spans"), spark.read.schema("including string, included string").parquet(f"{at}/includes")
    known = code.read_tree(spark, root)
    parsed = code.read_compile_commands(spark, commands) if commands else None
    spans, includes = code.extract(known if sources is None else sources, _plugin(extractor, code.scan_c), parsed, known.select("path"))
    if not at:
        return spans, includes
    spans.write.mode("overwrite").parquet(f"{at}/spans"), includes.write.mode("overwrite").parquet(f"{at}/includes")
    return _extracted(spark, root, commands, None, cache, extractor)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _inputs(spark: SparkSession, a: argparse.Namespace, sources: DataFrame | None = None) -> Inputs:
    return Inputs(*_index(spark, a.index, a.cache), *_extracted(spark, a.root, a.compile_commands, sources, a.cache, a.extractor))


def _functions(spark: SparkSession, a: argparse.Namespace) -> tuple[CodeGraph, Inputs]:
    """A graph of functions alone, as far as calls need it."""
    x = _inputs(spark, a)
    return CodeGraph(spark, a.root.rstrip("/")).with_functions(x), x


def _show(df: DataFrame, to: str | None) -> None:
    if to:
        df.write.mode("overwrite").parquet(to)
    else:
        df.show(100, truncate=False)


def _sources(spark: SparkSession, root: str) -> DataFrame:
    return code.read_tree(spark, root).select(P.relative("path", F.lit(root)).alias("path"), "text")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("symgraph", description="Builds, updates and asks a code graph.")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, about: str, *positional: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name, help=about)
        for x in positional:
            c.add_argument(x)
        return c

    def scanned(c: argparse.ArgumentParser) -> argparse.ArgumentParser:
        c.add_argument("--cache", help="folder of the parsed index")
        c.add_argument("--compile-commands", help="compilation database, for the folders in which includes are looked for")
        c.add_argument("--extractor", help="MODULE:FUNCTION that takes (path, text) and gives bodies and includes, in place of the built-in scanner")
        return c

    def enriched(c: argparse.ArgumentParser) -> argparse.ArgumentParser:
        c.add_argument("--summarizer", help="MODULE:FUNCTION from a list of prompts to a list of texts, in place of the built-in stand-in")
        c.add_argument("--embedder", help="MODULE:FUNCTION from a list of texts to a list of vectors")
        return c

    c = enriched(scanned(add("build", "build the graph of a project from its index and sources", "index", "root", "graph")))
    c.add_argument("--enrich", action="store_true", help="summaries and embeddings too")
    c.add_argument("--keep-orphans", action="store_true")
    c.add_argument("--name")
    c = enriched(scanned(add("update", "bring a graph up to a commit", "index", "root", "graph")))
    c.add_argument("--enrich", action="store_true", help="new summaries for what the changes touch")
    c.add_argument("--old", help="commit of the graph, if it holds none")
    c.add_argument("--new", default="HEAD")
    c.add_argument("--to", help="folder of the updated graph; it must differ from the old one", required=True)
    enriched(add("enrich", "summaries and embeddings of a graph", "graph", "root", "to"))
    c = add("schema", "print labels, properties and edge types", "graph")
    c.add_argument("--json", action="store_true")
    c = add("impact", "sources that depend on headers, of a graph or (with --root) of a source tree", "graph")
    c.add_argument("headers", nargs="+")
    c.add_argument("--root", help="the first argument is a compilation database ('-': none) of this source tree")
    c.add_argument("--out")
    scanned(add("nodes", "symbols of an index as nodes, without calls", "index", "root", "to"))
    c = scanned(add("calls", "the call graph of an index alone", "index", "root", "to"))
    c.add_argument("--script", action="store_true", help="write statements in place of a table")
    scanned(add("stats", "statistics of the call graph", "index", "root"))
    c = add("spans", "function bodies and includes of a source tree", "root")
    c.add_argument("--json", action="store_true", help="one document per file")
    c.add_argument("--compile-commands")
    c.add_argument("--out")
    c = add("diff", "changed files between two commits, in five lists", "root", "old")
    c.add_argument("--new", default="HEAD")
    add("headers", "whether headers are C or C++", "root")
    c = add("markers", "distinct lines that start with a marker", "file")
    c.add_argument("--marker", default="--- !")
    c.add_argument("--count-repeats", action="store_true")
    c = add("script", "run SQL statements over a graph's tables", "graph", "file")
    c.add_argument("--stop-on-error", action="store_true")
    c = add("delete-property", "set a property of a label, or of all labels, to null", "graph", "property", "to")
    c.add_argument("--label")
    c = add("vectors", "write, show or drop the vector index of a label: its usable vectors, unit length", "graph", "action")
    c.add_argument("--label", default="function")
    c = add("outline", "braces, brackets and names of a C file as a drawing", "file")
    c.add_argument("--out")
    p.add_argument("--memory", action="store_true", help="print where the driver's Python holds memory at the end")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    if spark is None:
        spark = SparkSession.builder.appName("symgraph").getOrCreate()
        ship(spark)
    if not a.memory:
        return _run(a, spark)
    import tracemalloc

    tracemalloc.start()
    try:
        _run(a, spark)
    finally:
        for line in tracemalloc.take_snapshot().statistics("lineno")[:10]:
            print(line)
        tracemalloc.stop()


def _run(a: argparse.Namespace, spark: SparkSession) -> None:
    if a.command == "build":
        graph = CodeGraph.build(spark, a.root, _inputs(spark, a), a.name, _commit(a.root), a.keep_orphans)
        (graph.enrich(_sources(spark, a.root), **_enrichers(a)) if a.enrich else graph).save(a.graph)
    elif a.command == "update":
        _update(a, spark)
    elif a.command == "enrich":
        CodeGraph.load(spark, a.graph).enrich(_sources(spark, a.root), **_enrichers(a)).save(a.to)
    elif a.command == "schema":
        graph = CodeGraph.load(spark, a.graph)
        print(graph.schema_json() if a.json else graph.schema())
    elif a.command == "impact":
        _impact(a, spark)
    elif a.command == "nodes":
        graph, _ = _functions(spark, a)
        graph.tables["function"].write.mode("overwrite").parquet(f"{a.to}/function")
        graph.tables["data_structure"].write.mode("overwrite").parquet(f"{a.to}/data_structure")
    elif a.command == "calls":
        graph, x = _functions(spark, a)
        edges = calls.call_edges(graph.call_sites(x.refs))
        (store.edge_script(edges, "calls").write.mode("overwrite").text(a.to) if a.script else edges.write.mode("overwrite").parquet(a.to))
    elif a.command == "stats":
        graph, x = _functions(spark, a)
        _show(graph.call_stats(x.refs), None)
    elif a.command == "spans":
        spans, includes = _extracted(spark, a.root, a.compile_commands)
        _show(code.by_file(spans, includes) if a.json else spans, a.out)
    elif a.command == "diff":
        for kind, items in git.changed_lists(spark, a.root, a.old, a.new).items():
            print(f"{kind}: {len(items)}", *(f"  {x['original']} -> {x['new']}" if isinstance(x, dict) else f"  {x}" for x in items), sep="\n")
    elif a.command == "headers":
        _show(code.header_languages(code.read_tree(spark, a.root)), None)
    elif a.command == "markers":
        lines = spark.read.text(a.file, wholetext=True).selectExpr("input_file_name() as file", "value as text")
        find = markers.marker_runs if a.count_repeats else markers.marker_lines
        _show(find(lines, "file", "text", a.marker), None)
    elif a.command == "script":
        graph = CodeGraph.load(spark, a.graph)
        for name, df in graph.tables.items():
            df.createOrReplaceTempView(name)
        with open(a.file) as f:
            for statement, df, error in store.run_script(spark, f.read(), a.stop_on_error):
                print(statement)
                print(error) if error else df.show(truncate=False)
    elif a.command == "delete-property":
        graph = CodeGraph.load(spark, a.graph)
        labels = [a.label] if a.label else [x for x, df in graph.tables.items() if a.property in df.columns]
        _show(store.property_count({x: graph.tables[x] for x in labels}, a.property), None)
        graph.tables |= {x: store.drop_property(graph.tables[x], a.property) for x in labels}
        graph.save(a.to)
    elif a.command == "vectors":
        graph = CodeGraph.load(spark, a.graph)
        {"write": graph.write_vectors, "drop": graph.drop_vectors, "show": lambda g, x: _show(graph.vectors(g, x), None)}[a.action](a.graph, a.label)
    elif a.command == "outline":
        _show(render.outline(spark.read.text(a.file, wholetext=True).select("value")), a.out)


def _enrichers(a: argparse.Namespace) -> dict[str, Callable]:
    return {"summarizer": _plugin(a.summarizer, enrich.constant_summaries), "embedder": _plugin(a.embedder, enrich.hashed_embeddings)}


def _update(a: argparse.Namespace, spark: SparkSession) -> None:
    """Reads only what the changes touch; a commit that the graph is at already changes nothing."""
    graph = CodeGraph.load(spark, a.graph)
    if graph.root != a.root.rstrip("/"):
        raise SystemExit(f"the graph is that of {graph.root}")
    old = a.old or graph.tables["project"].head().commit_hash
    if not old:
        raise SystemExit("the graph holds no commit; name the one it was built from with --old")
    new = git._git(a.root, "rev-parse", a.new).strip()
    if git._git(a.root, "rev-parse", old).strip() == new:
        print("already at", new)
        return graph.save(a.to)
    changed = cut(git.source_changes(spark, a.root, old, new), "changes")
    dirty = cut(graph.dirty_files(changed), "dirty")
    sources = cut(code.read_files(dirty.select(P.joined(F.lit(graph.root), "path").alias("path"))), "sources")
    graph = graph.update(_inputs(spark, a, sources), changed, new)
    if a.enrich:
        relative = sources.select(P.relative("path", F.lit(graph.root)).alias("path"), "text")
        graph = graph.enrich(relative, **_enrichers(a), only=graph.functions_in(dirty), changed=changed)
    graph.save(a.to)


def _impact(a: argparse.Namespace, spark: SparkSession) -> None:
    headers = spark.createDataFrame([(h,) for h in a.headers], "path string")
    if a.root:
        _, edges = _extracted(spark, a.root, None if a.graph == "-" else a.graph)
        headers = headers.select(code.normal_path(F.when(F.col("path").startswith("/"), F.col("path")).otherwise(P.joined(F.lit(a.root.rstrip("/")), "path"))).alias("path"))
    else:
        edges = CodeGraph.load(spark, a.graph).tables["includes"]
    edges = cut(edges, "includes")
    _show(traverse.impacted_sources(edges, headers, "including", "included"), a.out)
    for r in traverse.similar_headers(edges, headers).toLocalIterator():
        print(f"{r.seed} is included nowhere; of the same name: {', '.join(r.similar) or 'none'}")


def _commit(root: str) -> str | None:
    """The commit of a clean working tree; a tree with changes has none, so nothing is taken for up to date by mistake."""
    try:
        return git.head(root) if git.is_clean(root) else None
    except Exception:  # noqa: BLE001
        return None


if __name__ == "__main__":
    main()
