"""Tables as text for a reader: graph drawings and grouped listings."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from symgraph.functions import paths as P
from symgraph.functions.text import blanked


def dot_lines(tree: DataFrame, key: str, parent: str, label: str) -> DataFrame:
    """(line) of a graph drawing: a node per row, and an edge from its parent where it has one. Long labels are shortened."""
    quoted = lambda c: F.concat(F.lit('"'), P.dot_label(c), F.lit('"'))
    node = F.concat(F.lit("  "), quoted(key), F.lit(" [label="), F.concat(F.lit('"'), P.dot_label(P.shortened(label)), F.lit('"')), F.lit("];"))
    edge = F.when(F.col(parent).isNotNull(), F.concat(F.lit("  "), quoted(parent), F.lit(" -> "), quoted(key), F.lit(";")))
    return tree.select(F.explode(F.array_compact(F.array(node, edge))).alias("line"))


# The brackets of C.
_TOKENS = r"[{}()\[\];]|[A-Za-z_]\w*"


def outline(texts: DataFrame) -> DataFrame:
    """(line) of a drawing of the nesting of each text (value): a node per bracket, with the words before it as its label, below the bracket around it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lines = []
            for text in frame["value"]:
                stack, words, n = [0], [], 0
                lines.append('  0 [label="file"];')
                for m in re.finditer(_TOKENS, blanked(text or "")):
                    x = m.group()
                    if x in "{([":
                        n += 1
                        lines += [f'  {n} [label="{" ".join([*words[-3:], x])}"];', f"  {stack[-1]} -> {n};"]
                        stack.append(n)
                        words = []
                    elif x in "})]":
                        stack = stack[:-1] or [0]
                        words = words if x == ")" else []
                    else:
                        words = [] if x == ";" else [*words, x]
            yield pd.DataFrame({"line": lines})

    return texts.select("value").mapInPandas(run, "line string")


def span_listing(spans: DataFrame) -> DataFrame:
    """(file, n, functions): per file its functions as 'name first-last', by place. spans: file, name, line, column, body."""
    first = F.struct("line", "column", "name", F.get("body", 0).alias("a"), F.get("body", 2).alias("b"))
    per = spans.distinct().groupBy("file").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(first)).alias("all"))
    text = F.transform("all", lambda x: F.concat(x["name"], F.lit(" "), x["a"].cast("string"), F.lit("-"), x["b"].cast("string")))
    return per.select("file", "n", F.concat_ws("; ", text).alias("functions"))
