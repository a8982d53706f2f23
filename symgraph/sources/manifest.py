"""Processing only new input files: a manifest of files with size and checksum.

A run (1) lists the input files, (2) anti-joins the listing against the manifest, (3) hashes
the content of the files that remain and drops contents already processed under another
name, (4) writes its result below its batch identifier, each attempt apart, and (5) commits
by renaming the batch's manifest file into place, which fails if another attempt of the
batch was there first. Readers see only attempts that a manifest names, so a failure before
(5) leaves nothing behind that counts, a repeat after (5) finds nothing to do, and of two
runs of one batch at a time one commits. What failed attempts of a batch left is deleted when
the batch commits. Many batches can be brought together as one (``compact``).

Files of any size are hashed on the executors in parts of fixed size. The driver holds names
and sizes of input files, never their content.

Defined results: a file whose path, size and modification time are in the manifest is not
read again. A changed file under an old path is processed as new. Empty listings commit
nothing. Two files of equal content count once, the smaller path first.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

LISTING = T.StructType([T.StructField("path", T.StringType()), T.StructField("size", T.LongType()), T.StructField("modified_ms", T.LongType())])
MANIFEST = T.StructType([*LISTING.fields, T.StructField("checksum", T.StringType()), T.StructField("batch_id", T.StringType()), T.StructField("attempt", T.StringType()), T.StructField("replaces", T.ArrayType(T.StringType()))])
#: Bytes of a file that are held at a time while it is hashed.
PART_BYTES = 8 << 20


def checksum(path: str) -> str:
    """SHA-256 of a file on any file system that the executors reach, in parts of fixed size."""
    from pyarrow import fs

    if path.startswith(("file:", "/")):
        where, name = fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    else:
        where, name = fs.FileSystem.from_uri(path)
    total = hashlib.sha256()
    with where.open_input_stream(name) as stream:
        while part := stream.read(PART_BYTES):
            total.update(part)
    return total.hexdigest()


def _checksums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(checksum=[checksum(p) for p in batch["path"]])


class Manifest:
    """State of one incremental input under a folder: ``manifest/``, a file per batch, and ``data/``, a folder per batch and attempt."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def listing(self, inputs: Iterable[str], suffix: str = "") -> DataFrame:
        """All files under the inputs. Only names and sizes pass through the driver, a directory's iterator at a time."""
        rows = []
        for path in inputs:
            fs, p = self._fs(path)
            if not fs.exists(p):
                continue
            found = fs.listFiles(p, True)
            while found.hasNext():
                f = found.next()
                name = f.getPath().getName()
                if name.endswith(suffix) and not name.startswith(("_", ".")):
                    rows.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return self.spark.createDataFrame(rows, LISTING)

    def _entries(self) -> DataFrame:
        fs, p = self._fs(f"{self.root}/manifest")
        return self.spark.read.schema(MANIFEST).json(f"{self.root}/manifest") if fs.exists(p) else self.spark.createDataFrame([], MANIFEST)

    def processed(self) -> DataFrame:
        """(path, size, modified_ms, checksum, batch_id) of every file that a committed batch took."""
        every = self._entries()
        old = every.select(F.explode("replaces").alias("batch_id")).distinct()
        return every.join(old, "batch_id", "left_anti").select(*[f.name for f in MANIFEST.fields[:5]])

    def _attempts(self) -> dict[str, str]:
        """Batch -> attempt of the committed batches, without those that a later one has replaced; a batch is a run, so they are few."""
        every = self._entries().select("batch_id", "attempt", F.coalesce("replaces", F.array().cast("array<string>")).alias("replaces")).distinct().collect()
        old = {b for r in every for b in r.replaces}
        return {r.batch_id: r.attempt for r in sorted(every) if r.batch_id not in old}

    def committed(self) -> list[str]:
        """Batch identifiers whose manifest is in place, in order, replaced ones too."""
        fs, p = self._fs(f"{self.root}/manifest")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n.removesuffix(".json") for n in names if not n.startswith(("_", ".")))

    def pending(self, inputs: Iterable[str], suffix: str = "") -> DataFrame:
        """Files still to be processed, with the checksum of their content."""
        done = self.processed()
        new = self.listing(inputs, suffix).join(done.select("path", "size", "modified_ms"), ["path", "size", "modified_ms"], "left_anti")
        sums = new.repartition("path").mapInPandas(_checksums, T.StructType([*LISTING.fields, T.StructField("checksum", T.StringType())]))
        first = W.partitionBy("checksum").orderBy("path")
        unseen = sums.join(done.select("checksum"), "checksum", "left_anti")
        return unseen.withColumn("_r", F.row_number().over(first)).filter("_r = 1").select("path", "size", "modified_ms", "checksum")

    def run(self, batch_id: str, inputs: Iterable[str], process: Callable[[list[str]], DataFrame], suffix: str = "") -> bool:
        """Process what is pending as one batch; False if the batch is already committed or nothing is new."""
        if batch_id in self.committed():
            return False
        files = self.pending(inputs, suffix).collect()  # names of files, not data
        if not files:
            return False
        attempt = uuid.uuid4().hex
        process([f.path for f in files]).write.parquet(self._data(batch_id, attempt))
        return self._commit(batch_id, attempt, [{"path": f.path, "size": f["size"], "modified_ms": f.modified_ms, "checksum": f.checksum} for f in files])

    def _data(self, batch_id: str, attempt: str) -> str:
        return f"{self.root}/data/{batch_id}/{attempt}"

    def _commit(self, batch_id: str, attempt: str, files: list[dict], replaces: list[str] | None = None) -> bool:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        fs, waiting = self._fs(f"{self.root}/manifest/_{batch_id}-{attempt}")
        out = fs.create(waiting, False)
        out.write(bytearray("".join(json.dumps({**f, "batch_id": batch_id, "attempt": attempt, "replaces": replaces}) + "\n" for f in files), "utf-8"))
        out.close()
        _, target = self._fs(f"{self.root}/manifest/{batch_id}.json")
        no_options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:  # a file onto a name that must be free
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(waiting.toUri(), conf).rename(waiting, target, no_options)
        except Exception as e:
            if "FileAlreadyExistsException" not in str(e):
                raise
            fs.delete(waiting, False)
            return False
        _, folder = self._fs(f"{self.root}/data/{batch_id}")
        for s in fs.listStatus(folder):
            if s.getPath().getName() != attempt:
                fs.delete(s.getPath(), True)
        return True

    def compact(self, batch_id: str) -> bool:
        """All committed batches as one, so that readers open few folders; the old ones no longer count once it is in place."""
        old = self._attempts()
        if len(old) < 2:
            return False
        attempt = uuid.uuid4().hex
        self.data().write.parquet(self._data(batch_id, attempt))
        files = [r.asDict() for r in self.processed().drop("batch_id").distinct().collect()]  # names of files, not data
        return self._commit(batch_id, attempt, files, sorted(old))

    def exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def folders(self, path: str) -> list[str]:
        """Names of the folders right below a folder, in order."""
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())

    def data(self, batch_id: str | None = None) -> DataFrame | None:
        """What the committed batches, or one of them, wrote."""
        done = [self._data(b, a) for b, a in self._attempts().items() if batch_id in (None, b)]
        return self.spark.read.parquet(*done) if done else None
