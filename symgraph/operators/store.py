"""Keyed maintenance of node and edge tables: overlay, purge, prune, properties, schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from symgraph.functions import paths as P


def overlay(old: DataFrame, new: DataFrame, keys: list[str], nulls: str | None = None) -> DataFrame:
    """Upsert: rows of new are merged into old by key; a null in new keeps the old value.

    nulls: a column of new with the names of properties to set to null (removal). Keys are
    compared null-safe. Columns of either side survive; new columns come last.
    """
    rest = [c for c in [*old.columns, *[c for c in new.columns if c not in old.columns]] if c not in keys and c != nulls]
    a = old.select(*[F.col(c).alias(f"a_{c}") for c in old.columns], F.lit(True).alias("_in_a"))
    b = new.select(*[F.col(c).alias(f"b_{c}") for c in new.columns], F.lit(True).alias("_in_b"))
    both = a.join(b, reduce(lambda x, y: x & y, [F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in keys]), "full_outer")
    out = [F.when(F.col("_in_b"), F.col(f"b_{k}")).otherwise(F.col(f"a_{k}")).alias(k) for k in keys]
    for c in rest:
        sides = [F.col(f"{s}_{c}") for s, df in (("b", new), ("a", old)) if c in df.columns]
        value = F.coalesce(*sides)
        if nulls:
            value = F.when(~F.coalesce(F.array_contains(f"b_{nulls}", c), F.lit(False)), value)
        out.append(value.alias(c))
    return both.select(*out)


def write_counts(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """(n_created, n_matched): what an overlay of new would do, per distinct key."""
    k = new.select(*keys).distinct()
    matched = k.join(old.select(*keys).distinct().withColumn("_m", F.lit(1)), keys, "left")
    return matched.agg(F.count_if(F.col("_m").isNull()).alias("n_created"), F.count("_m").alias("n_matched"))


def without_keys(df: DataFrame, gone: DataFrame, column: str, key: str) -> DataFrame:
    return df.join(gone.select(F.col(key).alias(column)).distinct(), column, "left_anti").select(*df.columns)


def purge_symbols(nodes: DataFrame, defines: DataFrame, edges: dict[str, tuple[DataFrame, list[str]]], files: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Remove the symbols that the given files define, with every edge at either end.

    nodes: id; defines: file_path, id; files: path; edges: name -> (table, its id columns).
    """
    gone = defines.join(files.select(F.col("path").alias("file_path")).distinct(), "file_path", "left_semi").select("id").distinct()
    cut_edges = {name: reduce(lambda d, c: without_keys(d, gone, c, "id"), columns, df) for name, (df, columns) in edges.items()}
    return without_keys(nodes, gone, "id", "id"), without_keys(defines, gone, "id", "id"), cut_edges


def purge_counts(tables: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(what, n_before, n_after) of what a purge or a prune leaves of each table: name -> (before, after)."""
    one = lambda name, df, column: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), F.lit(column).alias("at"), "n")
    every = reduce(DataFrame.unionByName, [one(name, df, at) for name, pair in tables.items() for df, at in zip(pair, ("before", "after"))])
    of = lambda at: F.sum(F.when(F.col("at") == at, F.col("n")))
    return every.groupBy("what").agg(of("before").alias("n_before"), of("after").alias("n_after"))


def purge_includes(includes: DataFrame, files: DataFrame) -> DataFrame:
    return without_keys(includes, files, "including", "path")


def prune_folders(folders: DataFrame, files: DataFrame) -> DataFrame:
    """Folders that still hold a file somewhere below; no iteration."""
    held = files.select(F.explode(P.ancestors("path")).alias("path")).distinct()
    return folders.join(held, "path", "left_semi")


def disconnected(nodes: DataFrame, key: str, edges: list[DataFrame]) -> DataFrame:
    """Nodes at no end of any edge (edges: two columns each)."""
    ends = None
    for e in edges:
        for c in e.columns[:2]:
            one = e.select(F.col(c).alias(key))
            ends = one if ends is None else ends.unionByName(one)
    return nodes.join(ends.distinct(), key, "left_anti")


def property_count(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """(label, n): how many nodes of each label have the property; labels without it count 0."""
    parts = [df.agg(F.count(name).alias("n")).select(F.lit(label).alias("label"), "n") if name in df.columns else df.sparkSession.range(1).select(F.lit(label).alias("label"), F.lit(0).cast("bigint").alias("n")) for label, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def drop_property(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.lit(None).cast(df.schema[name].dataType))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of keys that break uniqueness."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """df, or an error if a key repeats; for use before a write."""
    worst = duplicate_keys(df, key).limit(1).collect()
    if worst:
        raise ValueError(f"{key} {worst[0][0]!r} occurs {worst[0]['n']} times")
    return df


def edge_types(edges: dict[str, tuple[DataFrame, str | None, str | None]], fixed: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """(src_label, edge, dst_label, n): which labels each edge type joins. edges: name -> (table, source label column, target label column)."""
    fixed, parts = fixed or {}, []
    for name, (df, src, dst) in edges.items():
        a = F.col(src) if src else F.lit(fixed[name][0])
        b = F.col(dst) if dst else F.lit(fixed[name][1])
        parts.append(df.groupBy(a.alias("src_label"), b.alias("dst_label")).agg(F.count("*").alias("n")).select("src_label", F.lit(name).alias("edge"), "dst_label", "n"))
    return reduce(DataFrame.unionByName, parts)


def property_types(tables: dict[str, DataFrame]) -> list[tuple[str, str, str]]:
    """(label, property, type) of every node table, sorted."""
    return sorted((label, f.name, f.dataType.simpleString()) for label, df in tables.items() for f in df.schema.fields)


def schema_text(tables: dict[str, DataFrame], edges: DataFrame) -> str:
    """The graph's schema for a reader: properties by label, edge types with counts."""
    lines = []
    for label in sorted(tables):
        lines.append(f"{label}: " + ", ".join(f"{n} {t}" for of, n, t in property_types(tables) if of == label))
    lines += [f"({r.src_label})-[{r.edge}]->({r.dst_label}): {r.n}" for r in edges.orderBy("src_label", "edge", "dst_label").collect()]  # one row per edge type
    return "\n".join(lines)


def edge_script(edges: DataFrame, table: str) -> DataFrame:
    """(value): an INSERT statement per edge, for ``run_script`` or another engine; quotes are doubled."""
    text = lambda c: F.concat(F.lit("'"), F.replace(F.col(c).cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    values = F.concat_ws(", ", *[F.coalesce(text(c), F.lit("NULL")) for c in edges.columns])
    return edges.select(F.concat(F.lit(f"INSERT INTO {table} ({', '.join(edges.columns)}) VALUES ("), values, F.lit(");")).alias("value"))


def run_script(spark, text: str, stop_on_error: bool = False) -> list[tuple[str, DataFrame | None, str | None]]:
    """Run a script of SQL statements split at ';', without blank and comment lines ('//' or '--'). Failures are kept beside their statement and the run goes on."""
    body = "\n".join(x for x in text.splitlines() if x.strip() and not x.strip().startswith(("//", "--")))
    out = []
    for statement in filter(None, (s.strip() for s in body.split(";"))):
        try:
            out.append((statement, spark.sql(statement), None))
        except Exception as e:  # noqa: BLE001
            if stop_on_error:
                raise
            out.append((statement, None, str(e)))
    return out


def schema_of(kind: str) -> T.StructType:
    """The columns of a stored table of the graph."""
    return T.StructType.fromDDL(STORED[kind])


STORED = {
    "project": "path string, name string, commit_hash string, summary string, summary_embedding array<float>",
    "folder": "path string, name string, parent_path string, summary string, summary_embedding array<float>",
    "file": "path string, name string, parent_path string, summary string, summary_embedding array<float>",
    "function": "id string, name string, kind string, scope string, language string, has_definition boolean, path string, name_location array<int>, signature string, return_type string, body_location array<int>, file_path string, code_summary string, summary string, summary_embedding array<float>",
    "data_structure": "id string, name string, kind string, scope string, language string, has_definition boolean, path string, name_location array<int>, file_path string",
    "contains": "src_label string, src string, dst_label string, dst string",
    "defines": "file_path string, dst_label string, id string",
    "includes": "including string, included string",
    "calls": "caller_id string, callee_id string",
}
