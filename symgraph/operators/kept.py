"""Snapshots that arrive one after the other, merged with the kept one.

The last snapshot of every group is kept in files, one folder per range of (group, key), sorted by
(group, key). A delivery goes through one exchange to the same ranges; a task then reads
the kept files of its ranges and merges the two sorted sides with a pointer on either, which
gives the typed changes and the snapshot to keep. The kept side never goes through an exchange.

The bounds of the ranges come from a sample of at most ``SAMPLE_ROWS`` keys of the first
delivery; a range holds about ``range_rows`` rows of it, and a task one range at a time. A
delivery writes a new version of the kept files and then names it, so a failed one leaves the
version before in place, and the same delivery again changes nothing.

Defined results: as of ``operators.snapshots``. Of a group a delivery holds one snapshot (of
several the one of the greatest number counts); groups that it does not hold stay as they are,
and a snapshot that is not later than the kept one of its group is passed over. A group's first
snapshot gives no change. The driver knows the last number of each group: at most ``GROUPS``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from symgraph.functions.text import symbol_key
from symgraph.operators.snapshots import content

SAMPLE_ROWS, GROUPS = 20_000, 200_000
#: Between group and key in a sort key; below any character of a text.
SEPARATOR = "\x00"
SIDE = ["g", "n", "k", "o", "c"]


def merge(old: pd.DataFrame, new: pd.DataFrame, numbers: dict[str, int], known: dict[str, int]) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(kept, changes) of two sides (group, number, key, sort key, content), each sorted by its sort key.

    numbers: the groups that the delivery holds; known: those that were kept before. The pointers of a
    merge of sorted arrays are found all at once: where each new sort key falls among the old ones.
    """
    moved = old["g"].isin(list(numbers)).to_numpy(bool)
    before, o, x = old[moved], old["o"].to_numpy(object)[moved], new["o"].to_numpy(object)
    at = np.searchsorted(o, x) if len(o) else np.zeros(len(x), np.int64)
    same = np.zeros(len(x), bool)
    inside = at < len(o)
    same[inside] = o[at[inside]] == x[inside]
    differs = np.zeros(len(x), bool)
    differs[same] = before["c"].to_numpy(object)[at[same]] != new["c"].to_numpy(object)[same]
    gone = np.ones(len(o), bool)
    gone[at[same]] = False
    removed = before[gone].assign(kind="removed", n=[numbers[g] for g in before["g"][gone]])
    changes = pd.concat([new[~same].assign(kind="added"), new[differs].assign(kind="changed"), removed])
    return pd.concat([old[~moved], new]).sort_values("o", kind="stable"), changes[[g in known for g in changes["g"]]]


def _by_range(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    """Rows in order of ranges, a range at a time."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        for no, part in frame.groupby("range", sort=True):
            if held and held[0]["range"].iloc[0] != no:
                yield int(held[0]["range"].iloc[0]), pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield int(held[0]["range"].iloc[0]), pd.concat(held)


def _kept(folder: str | None, no: int) -> pd.DataFrame:
    """The kept rows of a range, sorted."""
    from pyarrow import dataset, fs

    if folder is None:
        return pd.DataFrame({c: [] for c in SIDE})
    where, root = (fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")) if folder.startswith(("file:", "/")) else fs.FileSystem.from_uri(folder)
    path = f"{root}/kind=kept/range={no}"
    if where.get_file_info(path).type == fs.FileType.NotFound:
        return pd.DataFrame({c: [] for c in SIDE})
    return dataset.dataset(path, filesystem=where, format="parquet").to_table(columns=SIDE).to_pandas().sort_values("o", kind="stable", ignore_index=True)  # one sorted file, or a few


class KeptSnapshots:
    """State of the snapshots of one table under a folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str, group: str, number: str, key: str, sequence: str, compared: list[str], range_rows: int = 100_000):
        self.spark, self.root, self.range_rows = spark, root.rstrip("/"), range_rows
        self.group, self.number, self.key, self.sequence, self.compared = group, number, key, sequence, compared

    def _path(self, name: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _state(self) -> dict:
        fs, p = self._path("version")
        if not fs.exists(p):
            return {"version": None, "bounds": None, "numbers": {}}
        return json.loads(self.spark.read.text(f"{self.root}/version", wholetext=True).head()[0])

    def _name(self, state: dict) -> None:
        """Writes the state to a file and puts it in place of the old one by one rename."""
        fs, waiting = self._path(f"_{uuid.uuid4().hex}")
        out = fs.create(waiting, True)
        out.write(bytearray(json.dumps(state), "utf-8"))
        out.close()
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        how = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(waiting.toUri(), conf).rename(waiting, self._path("version")[1], how)

    def _bounds(self, o: DataFrame) -> list[str]:
        n = o.count()
        ranges = max(1, round(n / self.range_rows))
        got = sorted({r.o for r in o.filter(F.pmod(F.xxhash64("o"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE_ROWS / max(1, n)))).limit(2 * SAMPLE_ROWS).collect()})
        return [got[len(got) * i // ranges] for i in range(1, ranges)] if got else []

    def take(self, delivery: DataFrame) -> DataFrame:
        """(group, number, key, change_kind) of a delivery against what is kept, which it then replaces."""
        rows = delivery.select(F.col(self.group).cast("string").alias("g"), F.col(self.number).cast("long").alias("n"), symbol_key(self.key).alias("k"), F.col(self.sequence).alias("s"), F.to_json(content(delivery, self.compared)).alias("c"))
        rows = rows.filter("g is not null and n is not null and k is not null").withColumn("o", F.concat("g", F.lit(SEPARATOR), "k"))
        state = self._state()
        bounds = np.array(self._bounds(rows.select("o")) if state["bounds"] is None else state["bounds"], object)
        known, held = state["numbers"], {r.g: r.n for r in rows.groupBy("g").agg(F.max("n").alias("n")).limit(GROUPS + 1).collect()}
        if len(held) > GROUPS:
            raise ValueError(f"a delivery holds at most {GROUPS} groups")
        numbers = {g: n for g, n in held.items() if g not in known or n > known[g]}
        before, n_ranges = f"{self.root}/{state['version']}" if state["version"] else None, len(bounds) + 1

        @F.pandas_udf(T.IntegerType())
        def range_of(o: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(bounds, o.to_numpy(object), side="right").astype(np.int32))

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for no, part in _by_range(frames):
                new = part[[numbers.get(g) == n for g, n in zip(part["g"], part["n"])]].drop_duplicates("o")[SIDE]
                kept, changes = merge(_kept(before, no), new, numbers, known)
                yield pd.concat([kept.assign(kind="kept"), changes]).assign(range=no)[["range", "kind", *SIDE]].astype({"n": "Int64"})

        ranged = rows.withColumn("range", range_of("o"))
        marks = self.spark.range(n_ranges).select(*[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns], F.col("id").cast("int").alias("range"))  # so that every range has its task
        ordered = ranged.unionByName(marks).repartition(min(n_ranges, 4096), "range").sortWithinPartitions("range", "o", F.desc("n"), F.desc_nulls_last("s"), F.desc("c"))
        merged = ordered.mapInPandas(run, "range int, kind string, g string, n long, k string, o string, c string")
        version = f"v-{uuid.uuid4().hex}"
        merged.sortWithinPartitions("kind", "range", "o").write.partitionBy("kind", "range").parquet(f"{self.root}/{version}")
        self._name({"version": version, "bounds": list(bounds), "numbers": known | numbers})
        written = self.spark.read.schema("g string, n long, k string, o string, c string, kind string, range int").parquet(f"{self.root}/{version}")
        return written.filter("kind <> 'kept'").select(F.col("g").alias(self.group), F.col("n").alias(self.number), F.col("k").alias(self.key), F.col("kind").alias("change_kind"))
