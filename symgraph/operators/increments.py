"""Which run has to process which change: every commit belongs to exactly one successful run.

The listing is the ledger of commits (each from its earliest delivery), the batch identifier
is the run, and the manifest is the claim (commit, run). The anti-join "not claimed by an
earlier successful run" is, over a whole history, an as-of join: a commit belongs to the
first successful run that started at or after its earliest delivery. It is computed for all
runs at once, in blocks of time, so that a project that holds a third of all commits is
still spread over many tasks: inside a block by a running minimum, and for commits that
find no run in their own block by the first run of the following blocks.

Defined results: a run succeeded if its status is 'ok' without regard to case and blanks and
it has finished. Of runs that start together the smallest run id counts. Commits without
project, hash or load time, and runs without project or start, take no part. Null and ''
are no paths. Repeated deliveries, runs and paths count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from symgraph.functions.text import trimmed

BLOCK_DAYS = 7


def commit_ledger(changes: DataFrame) -> DataFrame:
    """One row per delivery of a commit and path: (project_path, commit_hash, loaded_at, path); path null where a commit has none."""
    none = F.array().cast("array<string>")
    paths = F.array_distinct(F.concat(F.coalesce("added", none), F.coalesce("modified", none)))
    kept = F.filter(paths, lambda p: p.isNotNull() & (p != ""))
    return changes.filter("project_path is not null and commit_hash is not null and loaded_at is not null").select("project_path", "commit_hash", "loaded_at", F.explode_outer(kept).alias("path"))


def successful_runs(runs: DataFrame) -> DataFrame:
    ok = (F.lower(trimmed("status")) == "ok") & F.col("finished_at").isNotNull() & F.col("started_at").isNotNull() & F.col("project_path").isNotNull() & F.col("run_id").isNotNull()
    return runs.filter(ok).groupBy("run_id", "project_path").agg(F.min("started_at").alias("started_at"))


def first_at_or_after(left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str, value: str, block_days: int = BLOCK_DAYS) -> DataFrame:
    """left with ``value`` of the first right row of its key at or after ``left_at`` (null: none)."""
    block = lambda c: F.floor(F.unix_micros(c) / F.lit(block_days * 86_400_000_000)).cast("long")
    hit = F.struct(F.col(right_at).alias("at"), F.col(value).alias("v"))
    r = right.select(F.col(key).alias("_k"), F.col(right_at).cast("timestamp").alias(right_at), value).select("_k", block(F.col(right_at)).alias("_b"), F.col(right_at).alias("_t"), hit.alias("_hit"))
    l = left.select(F.col(key).alias("_k"), block(F.col(left_at).cast("timestamp")).alias("_b"), F.col(left_at).cast("timestamp").alias("_t"), F.struct(*left.columns).alias("_row"))  # noqa: E741
    both = l.unionByName(r, allowMissingColumns=True)
    running = W.partitionBy("_k", "_b").orderBy(F.col("_t").desc()).rangeBetween(W.unboundedPreceding, W.currentRow)
    inside = both.withColumn("_in", F.min("_hit").over(running)).filter("_row is not null").select("_k", "_b", "_row", "_in")
    blocks = both.groupBy("_k", "_b").agg(F.min("_hit").alias("_first"))
    later = W.partitionBy("_k").orderBy(F.col("_b").desc()).rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("_later", F.min("_first").over(later)).select("_k", "_b", "_later")
    return inside.join(blocks, ["_k", "_b"], "left").select("_row.*", F.coalesce("_in", "_later")["v"].alias(value))


def claims(ledger: DataFrame, runs: DataFrame) -> DataFrame:
    """The manifest of a whole history: (project_path, commit_hash, run_id), one row per claimed commit."""
    commits = ledger.groupBy("project_path", "commit_hash").agg(F.min("loaded_at").alias("first_at"))
    return first_at_or_after(commits, successful_runs(runs), "project_path", "first_at", "started_at", "run_id").filter("run_id is not null").select("project_path", "commit_hash", "run_id")


def paths_by_run(ledger: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, path): what each successful run has to process."""
    return ledger.filter("path is not null").select("project_path", "commit_hash", "path").join(claims(ledger, runs), ["project_path", "commit_hash"]).select("run_id", "path").distinct()


def unclaimed(ledger: DataFrame, claimed: DataFrame) -> DataFrame:
    """Commits that no successful run has taken yet: the listing anti-joined against the manifest."""
    return ledger.select("project_path", "commit_hash").distinct().join(claimed, ["project_path", "commit_hash"], "left_anti")
