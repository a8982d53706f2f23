"""Queries on texts and vectors, and their SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from symgraph.functions.text import symbol_key
from symgraph.llm import forest, packing, tokens, visual
from symgraph.session import cut, table

DIMS = 384


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "function_nodes").select(symbol_key("id").alias("id"), "summary_embedding")
    return forest.similar_pairs(nodes, "id", "summary_embedding", DIMS, exact=True)


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_column(table(spark, d, "documents").select("doc_id", "text"), ["doc_id"], "text")


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return p6_ids(spark, d).select(F.col("doc_id").alias("item_id"), F.size("ids").alias("size"))


def _packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_sizes(spark, d), table(spark, d, "token_budgets"))


def p7_pack(spark: SparkSession, d: str) -> DataFrame:
    """(budget_id, doc_id, part_no, token_from, n_tokens, bin_id)."""
    return _packed(spark, d).withColumnRenamed("item_id", "doc_id")


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(_packed(spark, d), table(spark, d, "token_budgets"))


def p7_check(spark: SparkSession, d: str) -> DataFrame:
    """Whether every token of every document is in one bin, and no bin overfull."""
    sizes, budgets = cut(_sizes(spark, d), "sizes"), table(spark, d, "token_budgets")
    return packing.check(packing.pack(sizes, budgets), sizes, budgets)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return visual.same_look_pairs(table(spark, d, "documents"), "doc_id", "text")


def p8_forms(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, form): the one form of every text."""
    return visual.one_form(table(spark, d, "documents"), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p5_found, p6_ids, p7_pack, p7_fill, p7_check, p8_found, p8_forms)}
ORACLE: dict[str, str] = {
    "p7_check": "select budget_id, (select count(*) from documents) as n_items, 0::bigint as n_overfull, 0::bigint as n_lost, 0::bigint as n_twice from token_budgets",
}
