"""The tables of the domain as graph inputs: ids compared, deliveries brought together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from symgraph.functions import paths as P
from symgraph.functions.text import plain, symbol_key
from symgraph.operators import nodes, shred
from symgraph.schema import INDEX_SCHEMA
from symgraph.session import table

_TEXT = ["name", "kind", "lang", "scope", "signature", "return_type"]


def symbols(spark: SparkSession, d: str, which: str | None = None, columns: tuple[str, ...] | None = None) -> DataFrame:
    """One row per symbol id: the latest load wins. which: only loads that are 'ended' or 'current'.

    columns: the only ones that are read besides the id and the times. Loads of one time are told
    apart by the texts in order, so texts are to be asked for from the first on.
    """
    wanted = columns or ("project_path", *_TEXT, "canonical_declaration", "definition")
    texts = [c for c in _TEXT if c in wanted]
    rows = table(spark, d, "symbols").select(symbol_key("id").alias("id"), *[plain(c).alias(c) if c in _TEXT else c for c in wanted], "loaded_at", "removed_at")
    if which:
        rows = rows.filter(F.col("removed_at").isNotNull() if which == "ended" else F.col("removed_at").isNull())
    order = ["loaded_at", F.coalesce("removed_at", F.lit("9999-01-01").cast("timestamp_ntz")), *texts]
    return nodes.last_wins(rows, ["id"], order)


def functions(spark: SparkSession, d: str) -> DataFrame:
    """(id, name) of functions."""
    return symbols(spark, d, columns=("name", "kind")).filter("kind = 'Function'").select("id", "name")


def refs(spark: SparkSession, d: str, place: bool = False) -> DataFrame:
    """One row per reference: the earliest load counts. place: with the location."""
    columns = ["loaded_at", "symbol_id", "container_id", "kind", *(["location"] if place else [])]
    rows = table(spark, d, "refs").select("ref_id", "loaded_at", symbol_key("symbol_id").alias("symbol_id"), F.coalesce(symbol_key("container_id"), F.lit("")).alias("container_id"), *columns[3:])
    return rows.groupBy("ref_id").agg(F.min(F.struct(*columns)).alias("m")).select("ref_id", "m.*")


def call_sites(spark: SparkSession, d: str) -> DataFrame:
    """(site_id, file, line, column) of call relations."""
    rows = table(spark, d, "call_relations").groupBy("call_id").agg(F.min(F.struct("loaded_at", "call_location")).alias("m"))
    at = F.col("m.call_location")
    return rows.filter(at.isNotNull()).select(F.col("call_id").alias("site_id"), P.uri_path(at["file_uri"]).alias("file"), at["start_line"].alias("line"), at["start_column"].alias("column"))


def function_nodes(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The given columns of function nodes, once per node; rows repeat exactly, so what tells them apart is the id."""
    return table(spark, d, "function_nodes").select(*dict.fromkeys(["id", *columns])).distinct()


def bodies(spark: SparkSession, d: str) -> DataFrame:
    """Function bodies with their file: (id, file, start_line, start_column, end_line, end_column, seq)."""
    f = function_nodes(spark, d, "body_location").filter("size(body_location) = 4").select(symbol_key("id").alias("id"), "body_location")
    where = symbols(spark, d).filter("definition is not null").select("id", P.uri_path(F.col("definition.file_uri")).alias("file"))
    b = lambda i: F.get("body_location", i)
    return f.join(where, "id").select("id", "file", b(0).alias("start_line"), b(1).alias("start_column"), b(2).alias("end_line"), b(3).alias("end_column"), F.col("id").alias("seq"))


def includes(spark: SparkSession, d: str) -> DataFrame:
    """(including, included), absolute paths: the file that defines a symbol and the headers named with it."""
    paths = ["Definition.FileURI", "IncludeHeaders.Header"]
    shredded = shred.shred(table(spark, d, "index_docs"), "body", ["doc_seq"], INDEX_SCHEMA, paths)
    pairs = shred.assemble(shredded, INDEX_SCHEMA, "IncludeHeaders", ["doc_seq"], {paths[1]: "header"}, {paths[0]: "file"})
    return pairs.filter("header is not null and file is not null").select(P.uri_path("file").alias("including"), P.uri_path("header").alias("included")).distinct()


def headers(includes: DataFrame) -> DataFrame:
    """(path): all included headers."""
    return includes.filter(F.col("included").endswith(".h")).select(F.col("included").alias("path")).distinct()


def documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text")
