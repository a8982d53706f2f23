"""Lines of texts that start with a marker: distinct ones, and runs of equal ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def lines(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_col, line_no, line), 0-based. Null texts have no lines."""
    return texts.filter(F.col(text_col).isNotNull()).select(id_col, F.posexplode(F.split(text_col, "\n")).alias("line_no", "line"))


def marker_lines(texts: DataFrame, id_col: str, text_col: str, marker: str) -> DataFrame:
    """(line, n_texts): distinct lines that start with the marker."""
    return lines(texts, id_col, text_col).filter(F.col("line").startswith(marker)).groupBy("line").agg(F.count_distinct(id_col).alias("n_texts"))


def marker_runs(texts: DataFrame, id_col: str, text_col: str, marker: str) -> DataFrame:
    """(id_col, run_no, line, n): runs of equal marker lines that follow one another within a text, other lines apart."""
    marked = lines(texts, id_col, text_col).filter(F.col("line").startswith(marker))
    along = W.partitionBy(id_col).orderBy("line_no")
    new = F.when(F.col("line").eqNullSafe(F.lag("line").over(along)), 0).otherwise(1)
    numbered = marked.withColumn("_new", new).withColumn("run_no", F.sum("_new").over(along))
    return numbered.groupBy(id_col, "run_no", "line").agg(F.count("*").alias("n"))
