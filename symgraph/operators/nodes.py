"""Nodes and structural edges of the code graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from symgraph.functions import paths as P

FUNCTION_KINDS = ("Function",)
STRUCTURE_KINDS = ("Struct", "Class", "Union", "Enum")


def last_wins(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key, the one greatest by ``order`` and then by all its columns. Null keys form a group of their own."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    top = F.max(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*df.columns).alias("_row")))
    return df.groupBy(*[df[k].alias(f"_k{i}") for i, k in enumerate(keys)]).agg(top.alias("_top")).select("_top._row.*")


def symbol_rows(symbols: DataFrame) -> DataFrame:
    """Symbols as property rows: the primary place is the definition, else the declaration.

    Symbols without id or kind, and symbols whose primary place is outside their project, are
    left out; a symbol without any place stays, without a path. file_path is set only if the
    definition lies in the project. Expects project_path beside the symbol fields.
    """
    place = F.coalesce("definition", "canonical_declaration")
    rows = symbols.filter("id is not null and id <> '' and kind is not null and kind <> ''").withColumns({"_place": place, "_at": P.uri_path(place["file_uri"]), "_def": P.uri_path(F.col("definition.file_uri"))})
    rows = rows.filter(F.col("_place").isNull() | P.in_project("_at", "project_path"))
    inside = F.coalesce(P.in_project("_def", "project_path"), F.lit(False))
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return rows.select(
        "project_path", "id", "name", "kind", blank("scope").alias("scope"), blank("lang").alias("language"), F.col("definition").isNotNull().alias("has_definition"),
        P.relative("_at", "project_path").alias("path"), F.when(F.col("_place").isNotNull(), F.array("_place.start_line", "_place.start_column")).alias("name_location"),
        blank("signature").alias("signature"), blank("return_type").alias("return_type"), F.when(inside, P.relative("_def", "project_path")).alias("file_path"),
    )


def functions(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("kind").isin(*FUNCTION_KINDS))


def structures(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("kind").isin(*STRUCTURE_KINDS)).drop("signature", "return_type")


def kind_histogram(symbols: DataFrame) -> DataFrame:
    return symbols.groupBy("kind").agg(F.count("*").alias("n"))


def file_nodes(symbols: DataFrame, includes: DataFrame | None = None) -> DataFrame:
    """(project_path, path, name, parent_path): files of definitions and declarations in the project, and of both ends of include pairs.

    A file at the root level has the project as its parent.
    """
    each = symbols.select("project_path", F.explode(F.array("definition.file_uri", "canonical_declaration.file_uri")).alias("uri")).filter(F.col("uri").startswith("file:"))
    found = each.select("project_path", P.uri_path("uri").alias("_abs"))
    if includes is not None:
        found = found.unionByName(includes.select("project_path", F.explode(F.array("including", "included")).alias("_abs")))
    inside = found.filter(P.in_project("_abs", "project_path") & (F.col("_abs") != F.col("project_path")))
    return inside.select("project_path", P.relative("_abs", "project_path").alias("path")).distinct().select("project_path", "path", P.basename("path").alias("name"), _parent_node())


def folder_nodes(files: DataFrame) -> DataFrame:
    """(project_path, path, name, parent_path) of all folders above the files, without recursion."""
    return files.select("project_path", F.explode(P.ancestors("path")).alias("path")).distinct().select("project_path", "path", P.basename("path").alias("name"), _parent_node())


def _parent_node() -> Column:
    up = P.parent("path")
    return F.when(up == "", F.col("project_path")).otherwise(up).alias("parent_path")


def contains_edges(files: DataFrame, folders: DataFrame) -> DataFrame:
    """(project_path, src_label, src, dst_label, dst): each folder and file below its folder, or its project."""
    edge = lambda df, label: df.select("project_path", F.when(F.col("parent_path") == F.col("project_path"), "PROJECT").otherwise("FOLDER").alias("src_label"), F.col("parent_path").alias("src"), F.lit(label).alias("dst_label"), F.col("path").alias("dst"))
    return edge(folders, "FOLDER").unionByName(edge(files, "FILE"))


def defines_edges(rows: DataFrame, files: DataFrame) -> DataFrame:
    """(project_path, file_path, dst_label, id): symbols with a definition in a known file."""
    label = F.when(F.col("kind").isin(*FUNCTION_KINDS), "FUNCTION").when(F.col("kind").isin(*STRUCTURE_KINDS), "DATA_STRUCTURE")
    known = files.select("project_path", F.col("path").alias("file_path"))
    return rows.filter("file_path is not null").select("project_path", "file_path", label.alias("dst_label"), "id").filter("dst_label is not null").join(known, ["project_path", "file_path"], "left_semi").distinct()


def pair_edges(pairs: DataFrame, nodes: DataFrame, src: str, dst: str, key: str) -> DataFrame:
    """Distinct pairs of which both ends are nodes."""
    a, b = nodes.select(F.col(key).alias(src)).distinct(), nodes.select(F.col(key).alias(dst)).distinct()
    return pairs.select(src, dst).distinct().join(a, src, "left_semi").join(b, dst, "left_semi").select(src, dst)


def grouped_includes(includes: DataFrame) -> DataFrame:
    """(including, n, included): per including file its included files, sorted."""
    return includes.select("including", "included").distinct().groupBy("including").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("included")).alias("included"))


def definitions_by_file(defines: DataFrame) -> DataFrame:
    return defines.groupBy("project_path").agg(F.countDistinct("file_path").alias("n_files"), F.count("*").alias("n_defined")).withColumn("mean_defined", F.round(F.col("n_defined") / F.col("n_files"), 6))


def header_language(files: DataFrame) -> DataFrame:
    """(project_path, folder, language) of headers by their siblings: C++ if the folder holds C++ sources, else C if it holds C sources, else unknown."""
    ends = lambda *s: F.bool_or(P.has_suffix("path", s))
    per = files.withColumn("folder", P.parent("path")).groupBy("project_path", "folder").agg(ends(".cpp", ".cc", ".cxx").alias("cpp"), ends(".c").alias("c"), F.count_if(P.has_suffix("path", (".h",))).alias("n_headers"))
    return per.filter("n_headers > 0").select("project_path", "folder", "n_headers", F.when(F.col("cpp"), "C++").when(F.col("c"), "C").otherwise("unknown").alias("language"))
