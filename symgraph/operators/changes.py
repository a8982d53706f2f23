"""Source changes between commits: parsing, classes, renames folded, what has to be rebuilt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from symgraph.functions import paths as P


def parse_raw_diff(diffs: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """(keep, seq, status, path, original) from NUL-separated raw diff records.

    A record is a header that starts with ':' and ends in the status, then one path, or two
    if the status is a rename or a copy. Other fields than these are passed over.
    """
    fields = F.filter(F.split(column, "\x00"), lambda x: x != "")
    each = diffs.select(*keep, F.posexplode(F.transform(fields, lambda x, i: F.struct(x.alias("head"), F.get(fields, i + 1).alias("one"), F.get(fields, i + 2).alias("two")))).alias("seq", "r")).filter(F.col("r.head").startswith(":"))
    status = F.element_at(F.split("r.head", " "), -1)
    two = F.substring(status, 1, 1).isin("R", "C")
    return each.select(*keep, "seq", status.alias("status"), F.when(two, F.col("r.two")).otherwise(F.col("r.one")).alias("path"), F.when(two, F.col("r.one")).alias("original"))


def classify(records: DataFrame) -> DataFrame:
    """records with change_type: added, modified, deleted, renamed_exact, copied_exact; others are left out."""
    kind = F.when(F.col("status") == "A", "added").when(F.col("status") == "M", "modified").when(F.col("status") == "D", "deleted").when(F.col("status") == "R100", "renamed_exact").when(F.col("status") == "C100", "copied_exact")
    return records.withColumn("change_type", kind).filter("change_type is not null")


def listed_changes(changes: DataFrame, keep: list[str]) -> DataFrame:
    """(keep, change_type, path, original) from rows that hold a list per type; null and '' paths are left out, repeats once."""

    def items(name: str, pairs: bool) -> Column:
        kind = "array<struct<original: string, new: string>>" if pairs else "array<string>"
        entry = (lambda x: F.struct(F.lit(name).alias("change_type"), x["new"].alias("path"), x["original"].alias("original"))) if pairs else (lambda x: F.struct(F.lit(name).alias("change_type"), x.alias("path"), F.lit(None).cast("string").alias("original")))
        return F.transform(F.coalesce(F.col(name).cast(kind), F.array().cast(kind)), entry)

    every = F.concat(items("added", False), items("modified", False), items("deleted", False), items("renamed_exact", True), items("copied_exact", True))
    rows = changes.select(*keep, F.explode(every).alias("c")).select(*keep, "c.*")
    return rows.filter("path is not null and path <> '' and (change_type not in ('renamed_exact', 'copied_exact') or (original is not null and original <> ''))").distinct()


def fold(changes: DataFrame, keep: list[str], suffixes: tuple[str, ...] | None = P.TRACKED_SUFFIXES) -> DataFrame:
    """(keep, change_type, path): a rename is a deletion and an addition, a copy an addition.

    Only source files count; of a rename or copy both sides are kept if either is one. A path
    that a rename explains is not reported by itself a second time.
    """
    is_source = (lambda c: P.has_suffix(c, suffixes)) if suffixes else (lambda c: F.lit(True))
    pairs = changes.filter(F.col("change_type").isin("renamed_exact", "copied_exact")).filter(is_source("path") | is_source("original"))
    single = changes.filter(~F.col("change_type").isin("renamed_exact", "copied_exact") & is_source("path")).select(*keep, "change_type", "path")
    explained = pairs.filter("change_type = 'renamed_exact'")
    explained = explained.select(*keep, F.explode(F.array("path", "original")).alias("path")).distinct()
    single = single.join(explained, [*keep, "path"], "left_anti")
    new = pairs.select(*keep, F.lit("added").alias("change_type"), "path")
    old = pairs.filter("change_type = 'renamed_exact'").select(*keep, F.lit("deleted").alias("change_type"), F.col("original").alias("path"))
    return single.unionByName(new).unionByName(old).select(*keep, "change_type", "path").distinct()


def changed_headers(folded: DataFrame) -> DataFrame:
    """Headers that others may depend on: modified or deleted ones."""
    return folded.filter(F.col("change_type").isin("modified", "deleted") & P.has_suffix("path", (".h",)))


def dirty_files(folded: DataFrame, keep: list[str], impacted: DataFrame | None = None) -> DataFrame:
    """(keep, path) to rebuild: added, modified and impacted files that are not deleted."""
    dirty = folded.filter(F.col("change_type").isin("added", "modified")).select(*keep, "path")
    if impacted is not None:
        dirty = dirty.unionByName(impacted.select(*keep, "path"))
    return dirty.distinct().join(folded.filter("change_type = 'deleted'").select(*keep, "path").distinct(), [*keep, "path"], "left_anti")


def purge_scope(folded: DataFrame, keep: list[str], dirty: DataFrame) -> DataFrame:
    """(keep, path) whose symbols go: dirty and deleted files."""
    return dirty.select(*keep, "path").unionByName(folded.filter("change_type = 'deleted'").select(*keep, "path")).distinct()


def dirty_symbols(symbols: DataFrame, dirty: DataFrame, path: str = "path") -> DataFrame:
    """Symbols whose definition lies in a dirty file (absolute paths)."""
    at = dirty.select(F.col(path).alias("_at")).distinct()
    return symbols.withColumn("_at", P.uri_path(F.col("definition.file_uri"))).join(at, "_at", "left_semi").drop("_at")
