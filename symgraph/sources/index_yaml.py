"""The compiler's symbol index in YAML: one document per row, in parallel, as JSON bodies.

Input splits are cut at document marks, so one large file is read by many tasks. Tags are
passed over, tabs count as two spaces. A document that does not parse becomes a row with an
error instead of failing the scan. The bodies have the form that ``operators.shred`` takes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from symgraph.operators.nodes import last_wins
from symgraph.operators.shred import assemble, shred
from symgraph.schema import INDEX_SCHEMA, place_columns
from symgraph.session import cut

MARK = "\n--- "


def _load(text: str):
    import yaml

    class Loader(getattr(yaml, "CSafeLoader", yaml.SafeLoader)):
        """Plain values whatever the tag; numbers stay numbers, ids stay text."""

    def plain(loader, _suffix, node):
        if isinstance(node, yaml.MappingNode):
            return loader.construct_mapping(node, deep=True)
        if isinstance(node, yaml.SequenceNode):
            return loader.construct_sequence(node, deep=True)
        return loader.construct_scalar(node)

    Loader.add_multi_constructor("!", plain)
    # An id such as 00000000000000E1 must not be taken for a number.
    Loader.yaml_implicit_resolvers = {k: [(t, r) for t, r in v if t == "tag:yaml.org,2002:null" or t == "tag:yaml.org,2002:bool"] for k, v in Loader.yaml_implicit_resolvers.items()}
    return yaml.load(text, Loader)  # noqa: S506


def _numbers(x, key: str = ""):
    """Whole numbers where the index has numbers: kinds, flags, lines, columns, counts."""
    if isinstance(x, dict):
        return {k: _numbers(v, k) for k, v in x.items()}
    if isinstance(x, list):
        return [_numbers(v, key) for v in x]
    if isinstance(x, str) and key in ("Kind", "Flags", "Line", "Column", "References", "Predicate") and x.lstrip("-").isdigit():
        return int(x)
    return x


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_seq, body, error) of every document, in file order."""
    raw = spark.read.option("lineSep", MARK).text(path).withColumn("doc_seq", F.monotonically_increasing_id())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for seq, text in zip(frame["doc_seq"], frame["value"]):
                text = text.removeprefix("--- ").replace("\t", "  ").strip()
                text = text.removesuffix("...").rstrip() if text.endswith("\n...") else text
                if not text or text == "...":
                    continue
                head, _, rest = text.partition("\n")
                try:
                    got = _load(rest if head.startswith("!") else text)
                    out.append((seq, json.dumps(_numbers(got)) if isinstance(got, dict) else None, None if isinstance(got, dict) else "no mapping"))
                except Exception as e:  # noqa: BLE001
                    out.append((seq, None, str(e)[:500]))
            yield pd.DataFrame(out, columns=["doc_seq", "body", "error"])

    return raw.select("doc_seq", "value").mapInPandas(run, "doc_seq long, body string, error string")


def cached_index(spark: SparkSession, path: str, cache: str) -> DataFrame:
    """The documents of an index from a parquet copy that is at least as new as the index, else read anew and copied."""
    jvm = spark.sparkContext._jvm

    def modified(p: str) -> int:
        at = jvm.org.apache.hadoop.fs.Path(p)
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return fs.getFileStatus(at).getModificationTime() if fs.exists(at) else -1

    if modified(f"{cache}/_SUCCESS") < modified(path):
        read_index(spark, path).write.mode("overwrite").parquet(cache)
    return spark.read.schema("doc_seq long, body string, error string").parquet(cache)


def symbols_and_refs(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed symbols (last document of an id wins) and references from index documents (doc_seq, body).

    A document with an ID and a SymInfo is a symbol, one with an ID and References holds
    references; anything else is passed over.
    """
    text = {"ID": "id", "Name": "name", "Scope": "scope", "SymInfo.Kind": "kind", "SymInfo.Lang": "lang", "Signature": "signature", "ReturnType": "return_type", "Type": "type"}
    places = place_columns("CanonicalDeclaration", "c") | place_columns("Definition", "d")
    each = {"References.Kind": "kind", "References.Container.ID": "container_id"} | place_columns("References.Location", "l")
    parts = cut(shred(docs, "body", ["doc_seq"], INDEX_SCHEMA, [*text, *places, *each]), "index")

    def place(p: str):
        fields = [F.col(f"{p}_{x}").cast("int").alias(x) for x in ("start_line", "start_column", "end_line", "end_column")]
        return F.when(F.col(f"{p}_file_uri").isNotNull(), F.struct(F.col(f"{p}_file_uri").alias("file_uri"), *fields))

    rows = assemble(parts, INDEX_SCHEMA, "", ["doc_seq"], text | places, {}, {"SymInfo.Kind": "level"}).filter("level >= 1 and id is not null")
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    symbols = rows.select("doc_seq", "id", "name", blank("kind"), blank("lang"), blank("scope"), blank("signature"), blank("return_type"), blank("type"), place("c").alias("canonical_declaration"), place("d").alias("definition"))
    refs = assemble(parts, INDEX_SCHEMA, "References", ["doc_seq"], each, {"ID": "symbol_id"}).filter("symbol_id is not null")
    refs = refs.select(F.struct("doc_seq", "pos_1").alias("ref_id"), "symbol_id", "container_id", F.expr("try_cast(kind as int)").alias("kind"), place("l").alias("location")).filter("kind is not null and location is not null")
    return last_wins(symbols, ["id"], ["doc_seq"]).drop("doc_seq"), refs
