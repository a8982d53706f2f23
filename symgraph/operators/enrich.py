"""Summaries rolled up the hierarchy, embeddings and similarity search.

Every level is one job: prompts are built with joins and aggregates, then one pass calls the
plug-in per batch. A plug-in that answers '' or nothing has failed for that row, which then
keeps its old value.
"""

from __future__ import annotations

import hashlib
import json
import time
import urllib.request
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from symgraph.functions import paths as P
from symgraph.session import cut

Summarizer = Callable[[list[str]], list[str]]
Embedder = Callable[[list[str]], list[list[float]]]

FUNCTION_PROMPT = "Say in one or two sentences what this C function does.\n\n%s"
CONTEXT_PROMPT = "The function does this: %s\nIt is called by: %s\nIt calls: %s\nSay what part it plays."
FILE_PROMPT = "The file %s holds functions that do this: %s\nSay what the file is for."
FOLDER_PROMPT = "The folder %s holds: %s\nSay what the folder is for."
PROJECT_PROMPT = "The project %s holds: %s\nSay what the project is for."


def constant_summaries(prompts: list[str]) -> list[str]:
    """The summarizer for tests and dry runs."""
    return ["This code does its part."] * len(prompts)


def hashed_embeddings(texts: list[str], dims: int = 384) -> list[list[float]]:
    """A deterministic embedder without a model: unit vectors seeded by the text's digest."""
    out = []
    for t in texts:
        v = np.random.default_rng(int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "big")).standard_normal(dims)
        out.append((v / np.linalg.norm(v)).astype(np.float32).tolist())
    return out


def _usable(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def needs_code_summary(functions: DataFrame) -> DataFrame:
    return functions.filter(~_usable("code_summary") & F.col("body_location").isNotNull())


def needs_summary(functions: DataFrame) -> DataFrame:
    return functions.filter(_usable("code_summary") & ~_usable("summary"))


def needs_embedding(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(label, key, summary) of nodes with a summary and no embedding; tables: label -> (nodes, key column)."""
    parts = [df.filter(_usable("summary") & F.col("summary_embedding").isNull()).select(F.lit(label).alias("label"), F.col(key).alias("key"), "summary") for label, (df, key) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_lines(text: Column | str, first: Column, last: Column) -> Column:
    """The whole lines first..last (0-based, inclusive) of a text, with their line ends."""
    lines = F.split(F.col(text) if isinstance(text, str) else text, "(?<=\n)")
    return F.concat_ws("", F.slice(lines, first + 1, F.greatest(last - first + 1, F.lit(0))))


def function_prompts(functions: DataFrame, sources: DataFrame) -> DataFrame:
    """(id, prompt) from the source lines of each body; functions without readable source are left out. sources: path, text."""
    body = F.col("body_location")
    at = functions.filter(F.size("body_location") == 4).join(sources.withColumnRenamed("path", "file_path"), "file_path")
    code = source_lines("text", F.get(body, 0), F.get(body, 2))
    return at.select("id", code.alias("code")).filter("code <> ''").select("id", F.format_string(FUNCTION_PROMPT, "code").alias("prompt"))


def listed(c: Column, separator: str = ", ") -> Column:
    """Joined text of an array, 'none' if it is empty."""
    return F.coalesce(F.nullif(F.concat_ws(separator, c), F.lit("")), F.lit("none"))


def context_prompts(functions: DataFrame, context: DataFrame) -> DataFrame:
    """(id, prompt) from a function's code summary and those of the functions around it (context: as of ``traverse.call_context``)."""
    return functions.join(context, "id").select("id", F.format_string(CONTEXT_PROMPT, "code_summary", listed(F.col("callers")), listed(F.col("callees"))).alias("prompt"))


def _rolled(children: DataFrame, key: list[str], of: Column, template: str, name: Column) -> DataFrame:
    return children.groupBy(*key).agg(F.array_sort(F.collect_list(of)).alias("_all")).select(*key, F.format_string(template, name, F.concat_ws("; ", "_all")).alias("prompt"))


def file_prompts(functions: DataFrame, keep: list[str]) -> DataFrame:
    """(keep, file_path, prompt) per file with summarised functions, sorted, repeats kept."""
    return _rolled(functions.filter(_usable("summary") & F.col("file_path").isNotNull()), [*keep, "file_path"], F.col("summary"), FILE_PROMPT, P.basename("file_path"))


def folder_prompts(children: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(keep, parent_path, prompt) from summarised children, files and folders: (keep, label, name, summary, parent_path)."""
    return _rolled(children.filter(_usable("summary")), [*(keep or []), "parent_path"], _said(), FOLDER_PROMPT, P.basename("parent_path"))


def project_prompts(children: DataFrame, key: str, name: Column) -> DataFrame:
    """(key, prompt) of each project from its summarised files and folders at the top: (key, label, name, summary)."""
    return _rolled(children.filter(_usable("summary")), [key], _said(), PROJECT_PROMPT, name)


def _said() -> Column:
    return F.format_string("%s %s: %s", "label", "name", "summary")


def summarize(prompts: DataFrame, key: list[str], summarizer: Summarizer, batch: int = 64) -> DataFrame:
    """(key, new_summary, error): one pass over the prompts, batch by batch.

    A row without an answer has no new_summary and says why: the plug-in's error, or that the answer was empty.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part, error = frame.iloc[start : start + batch], None
                try:
                    answers = list(summarizer(part["prompt"].tolist()))
                    if len(answers) != len(part):
                        raise ValueError(f"{len(answers)} answers to {len(part)} prompts")
                except Exception as e:  # noqa: BLE001
                    answers, error = [None] * len(part), f"{type(e).__name__}: {e}"[:500]
                yield part[key].assign(new_summary=[x or None for x in answers], error=[error if error else None if x else "empty answer" for x in answers])

    kinds = ", ".join(f"`{k}` {prompts.schema[k].dataType.simpleString()}" for k in key)
    return prompts.select(*key, "prompt").mapInPandas(run, f"{kinds}, new_summary string, error string")


def patient(plugin: Callable[[list], list], attempts: int = 4, wait: float = 1.0) -> Callable[[list], list]:
    """A plug-in that is asked again after an error, each time after twice the wait."""

    def ask(batch: list) -> list:
        for n in range(attempts):
            try:
                return plugin(batch)
            except Exception:  # noqa: BLE001
                if n + 1 == attempts:
                    raise
                time.sleep(wait * 2**n)
        return []

    return ask


def http_plugin(url: str, body: Callable[[object], dict], answer: Callable[[dict], object], headers: dict[str, str] | None = None, timeout: float = 300) -> Callable[[list], list]:
    """A summarizer or embedder behind an HTTP service: one POST of ``body(item)`` as JSON per item, ``answer`` takes the result out of the reply."""

    def ask(batch: list) -> list:
        out = []
        for item in batch:
            request = urllib.request.Request(url, json.dumps(body(item)).encode(), {"Content-Type": "application/json"} | (headers or {}))  # noqa: S310
            with urllib.request.urlopen(request, timeout=timeout) as reply:  # noqa: S310
                out.append(answer(json.load(reply)))
        return out

    return ask


def apply_summaries(nodes: DataFrame, summaries: DataFrame, key: list[str], column: str = "summary", only_if_changed: bool = True) -> DataFrame:
    """nodes with new summaries; where one is set (by default only if it differs) the embedding is cleared."""
    joined = nodes.join(summaries, key, "left")
    new = F.col("new_summary").isNotNull()
    if only_if_changed:
        new = new & ~F.col("new_summary").eqNullSafe(F.col(column))
    out = joined.withColumn("_new", new)
    if "summary_embedding" in nodes.columns and column == "summary":
        out = out.withColumn("summary_embedding", F.when(~F.col("_new"), F.col("summary_embedding")))
    return out.withColumn(column, F.when(F.col("_new"), F.col("new_summary")).otherwise(F.col(column))).select(*nodes.columns)


def embed(needed: DataFrame, embedder: Embedder, batch: int = 256) -> DataFrame:
    """(label, key, embedding); empty vectors are left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                yield part[["label", "key"]].assign(embedding=embedder(part["summary"].tolist()))

    return needed.mapInPandas(run, "label string, key string, embedding array<float>").filter("size(embedding) > 0")


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


#: Bytes of queries that are held at a time by the driver and each task.
QUERY_BYTES = 64 << 20


def cosine_topk(queries: DataFrame, vectors: DataFrame, id_col: str, vector_col: str, dims: int, k: int, slice_rows: int = 512, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, id, score, rank): exact search of a stated query set in all vectors.

    Queries go in blocks of at most ``query_bytes``, whatever their number, against each batch
    of vectors as matrix products; each batch keeps k per query, so what is shuffled is small,
    and the best of the batches win. More than one block means one pass over the vectors per
    block, each written before the next. A query id counts once and is not its own result;
    vectors that are null, of another length, or hold a null take no part; ties go to the
    smaller id.
    """
    usable = F.col(id_col).isNotNull() & (F.size(vector_col) == dims) & ~F.exists(vector_col, lambda x: x.isNull() | F.isnan(x))
    asked = queries.filter(usable).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).dropDuplicates(["id"])
    kept = vectors.filter(usable).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    n_blocks = max(1, -(-asked.count() * dims * 8 // query_bytes))
    found = None
    for block in range(n_blocks):
        part = asked if n_blocks == 1 else asked.filter(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == block)
        one = _search_block(part.toArrow(), kept, dims, k, slice_rows)
        one = one if n_blocks == 1 else cut(one, "topk")
        found = one if found is None else found.unionByName(one)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _search_block(asked: pa.Table, kept: DataFrame, dims: int, k: int, slice_rows: int) -> DataFrame:
    q_ids = asked["id"].to_numpy()
    q = _unit_rows(asked["v"].to_pylist(), dims)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x, ids = _unit_rows(frame["v"].tolist(), dims), frame["id"].to_numpy()
            for start in range(0, len(q), slice_rows):
                scores = np.round(q[start : start + slice_rows] @ x.T, 6)
                own = q_ids[start : start + slice_rows]
                scores[own[:, None] == ids[None, :]] = -9
                order = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)[:, :k]
                best = np.take_along_axis(scores, order, 1)
                out = pd.DataFrame({"query_id": np.repeat(own, order.shape[1]), "id": ids[order].ravel(), "score": best.ravel()})
                yield out[out["score"] > -9]

    kind = kept.schema["id"].dataType.simpleString()
    return kept.mapInPandas(run, f"query_id {kind}, id {kind}, score double")


def _unit_rows(lists: list, dims: int) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in lists]).reshape(-1, dims)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
