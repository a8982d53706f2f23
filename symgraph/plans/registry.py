"""All queries of the core and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from symgraph.plans import general, graph, graph_sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return graph.QUERIES | general.QUERIES


def oracle_sql() -> dict[str, str]:
    return graph_sql.ORACLE | general.ORACLE
