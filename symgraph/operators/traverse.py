"""Graph traversal: transitive impact, neighbourhoods, degrees."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from symgraph.functions import paths as P
from symgraph.session import shared_dir


#: Shortcuts double while they are at most this many times the edges, and only if the seeds' neighbours are at least that share of the edges.
SHORTCUTS, MANY_SEEDS = 8, 1 / 16


def reach(edges: DataFrame, seeds: DataFrame, src: str, dst: str, max_rounds: int = 1000, label: str | None = None) -> DataFrame:
    """(seed, node): nodes from which a path of one edge or more leads to a seed; a seed on a cycle reaches itself.

    label: a column of seeds that stands for the seed in the result, so that what many seeds of one
    label reach is found and kept once; the seed itself is then the other column.

    Semi-naive rounds: only pairs that are new meet the edges again. Where many seeds ask, edges
    are first joined with themselves into shortcuts of up to 2, 4, 8 ... edges, so that a round
    passes several edges; when these no longer grow, one join with the seeds is all that is left.
    Each round is one job that writes its pairs and counts them on the way, so
    lineage and plans stay flat and lost executors do not restart the loop. Null ends and seeds
    take no part.
    """
    spark, root = edges.sparkSession, shared_dir(edges.sparkSession, "reach")
    pairs = edges.select(F.col(dst).alias("to"), F.col(src).alias("node")).dropna().distinct()
    at = next(c for c in seeds.columns if c != label)
    start = seeds.select(F.col(label or at).alias("seed"), F.col(at).alias("at")).dropna().distinct()

    def write(df: DataFrame, name: str) -> tuple[DataFrame, int]:
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}"), seen.get["n"]

    hop = lambda near, at, step: near.join(step.select(F.col("to").alias("_to"), F.col("node").alias("_node")), F.col(at) == F.col("_to"))
    onward = lambda near, at, step: hop(near, at, step).select("seed", F.col("_node").alias("node"))
    back, n_edges = write(pairs, "edges")
    new, n_new = write(onward(start, "at", back).distinct(), "0")
    step, n_step, complete, level = back, n_edges, False, 0
    while n_new >= MANY_SEEDS * n_edges and 0 < n_step <= SHORTCUTS * n_edges and not complete:
        level += 1
        wider = step.unionByName(hop(step, "node", step).select("to", F.col("_node").alias("node"))).distinct()
        before = n_step
        step, n_step = write(wider, f"step-{level}")
        complete = n_step == before
    if complete:
        return onward(start, "at", step).distinct()
    for no in range(1, max_rounds + 1):
        found = spark.read.schema(new.schema).parquet(*[f"{root}/{r}" for r in range(no)])  # one scan, however many rounds
        if not n_new:
            return found
        one = onward(new, "node", step).distinct()
        both = one.unionByName(onward(one, "node", step)).distinct() if not level else one
        new, n_new = write(both.join(found, ["seed", "node"], "left_anti").select("seed", "node"), str(no))
    raise RuntimeError(f"no fixpoint after {max_rounds} rounds")


def impact(edges: DataFrame, seeds: DataFrame, src: str, dst: str, with_seed: bool = True) -> DataFrame:
    got = reach(edges, seeds, src, dst)
    return got if with_seed else got.filter("seed <> node")


def impacted_sources(edges: DataFrame, seeds: DataFrame, src: str, dst: str, suffixes: tuple[str, ...] = P.SOURCE_SUFFIXES) -> DataFrame:
    """(seed, sources): sorted source files per seed; a seed that reaches nothing has an empty list."""
    hit = impact(edges, seeds, src, dst, with_seed=False).filter(P.has_suffix("node", suffixes))
    lists = hit.groupBy("seed").agg(F.array_sort(F.collect_list("node")).alias("sources"))
    all_seeds = seeds.select(F.col(seeds.columns[0]).alias("seed")).distinct()
    return all_seeds.join(lists, "seed", "left").select("seed", F.coalesce("sources", F.array().cast("array<string>")).alias("sources"))


def similar_headers(edges: DataFrame, seeds: DataFrame, dst: str = "included") -> DataFrame:
    """(seed, similar): for seeds that nothing includes, the included files of the same name, sorted."""
    included = edges.select(F.col(dst).alias("path")).distinct()
    lost = seeds.select(F.col(seeds.columns[0]).alias("seed")).distinct().join(included.withColumnRenamed("path", "seed"), "seed", "left_anti")
    named = included.select(P.basename("path").alias("_name"), "path")
    near = lost.withColumn("_name", P.basename("seed")).join(named, "_name", "left").groupBy("seed").agg(F.array_sort(F.collect_list("path")).alias("similar"))
    return near


def neighbours(seeds: DataFrame, calls: DataFrame) -> DataFrame:
    """(id): the seeds and everything one call away, in either direction."""
    s = seeds.select("id").distinct()
    forth = calls.join(s, calls["caller_id"] == s["id"], "left_semi").select(F.col("callee_id").alias("id"))
    back = calls.join(s, calls["callee_id"] == s["id"], "left_semi").select(F.col("caller_id").alias("id"))
    return s.unionByName(forth).unionByName(back).distinct()


def call_context(functions: DataFrame, calls: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """(id, callers, callees): the sorted distinct code summaries of the functions that call each function and that it calls.

    functions: id, code_summary. Neighbours without one, or with an empty one, add nothing; the lists
    are empty where there are none; the two sides are never multiplied. only: (id) of functions asked for.
    """
    asked = (functions if only is None else only).select("id").distinct()
    said = functions.filter("code_summary is not null and code_summary <> ''").select("id", "code_summary")
    one = lambda of, by: calls.join(asked.withColumnRenamed("id", of), of, "left_semi").join(said.withColumnRenamed("id", by), by).groupBy(F.col(of).alias("id")).agg(F.array_sort(F.collect_set("code_summary")).alias(by))
    none = F.array().cast("array<string>")
    both = asked.join(one("callee_id", "caller_id"), "id", "left").join(one("caller_id", "callee_id"), "id", "left")
    return both.select("id", F.coalesce("caller_id", none).alias("callers"), F.coalesce("callee_id", none).alias("callees"))


def subset_one_hop(seeds: DataFrame, refs: DataFrame) -> DataFrame:
    """(id): the seeds, the containers of references to them, and the symbols referred to from within them."""
    s = seeds.select("id").distinct()
    containers = refs.join(s, refs["symbol_id"] == s["id"], "left_semi").select(F.col("container_id").alias("id"))
    targets = refs.join(s, refs["container_id"] == s["id"], "left_semi").select(F.col("symbol_id").alias("id"))
    return s.unionByName(containers).unionByName(targets).filter("id is not null and id <> ''").distinct()


def top_included(edges: DataFrame, n: int) -> DataFrame:
    """(included, n_including): the n files that most files include directly, ties by path."""
    per = edges.select("including", "included").distinct().groupBy("included").agg(F.count("*").alias("n_including"))
    return per.orderBy(F.desc("n_including"), "included").limit(n)


def degrees(*edges: DataFrame) -> DataFrame:
    """(node, degree) over edge tables of two columns."""
    ends = None
    for e in edges:
        a, b = e.columns[:2]
        one = e.select(F.col(a).cast("string").alias("node")).unionByName(e.select(F.col(b).cast("string").alias("node")))
        ends = one if ends is None else ends.unionByName(one)
    return ends.groupBy("node").agg(F.count("*").alias("degree"))
