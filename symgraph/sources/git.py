"""Git as a source: the changes between two commits, and where a repository stands."""

from __future__ import annotations

import subprocess
import tempfile
from collections.abc import Iterator
from itertools import islice
from typing import IO

from pyspark.sql import DataFrame, SparkSession

from symgraph.operators import changes
from symgraph.session import shared_dir


def _git(folder: str, *args: str) -> str:
    return subprocess.run(["git", "-C", folder, *args], capture_output=True, text=True, check=True).stdout


def repository(folder: str) -> str:
    """The top folder of the working tree that holds ``folder``; an error if there is none."""
    try:
        return _git(folder, "rev-parse", "--show-toplevel").strip()
    except subprocess.CalledProcessError as e:
        raise ValueError(f"{folder} is not inside a Git working tree") from e


def head(folder: str) -> str:
    return _git(folder, "rev-parse", "HEAD").strip()


def is_clean(folder: str) -> bool:
    return not _git(folder, "status", "--porcelain", "--untracked-files=no").strip()


#: Records that the driver holds at a time while it takes a diff in.
SLICE = 50_000
RECORD = "seq long, status string, path string, original string"


def _records(stream: IO[bytes], size: int = 1 << 16) -> Iterator[tuple[str, str, str | None]]:
    """(status, path, original) from raw NUL-separated diff output, read in parts."""
    rest, fields, wanted = b"", [], 0
    while part := stream.read(size):
        *whole, rest = (rest + part).split(b"\0")
        for field in whole:
            text = field.decode("utf-8", "replace")
            if not fields:
                if not text.startswith(":"):
                    continue
                status = text.rsplit(" ", 1)[-1]
                fields, wanted = [status], 3 if status[:1] in ("R", "C") else 2
            else:
                fields.append(text)
                if len(fields) == wanted:
                    yield fields[0], fields[-1], fields[1] if wanted == 3 else None
                    fields = []


def diff(spark: SparkSession, folder: str, old: str, new: str = "HEAD") -> DataFrame:
    """(seq, status, path, original, change_type) between two commits; only exact renames and copies are told.

    The driver reads the output as a stream and writes it to the shared folder in slices, so a diff of any length passes.
    """
    repository(folder)
    command = ["git", "-C", folder, "diff-tree", "--find-copies-harder", "-M100%", "-C100%", "-r", "--raw", "-z", old, new]
    root, records = shared_dir(spark, "diff"), enumerate(iter_checked(command))
    spark.createDataFrame([], RECORD).write.parquet(root)
    while some := [(seq, *r) for seq, r in islice(records, SLICE)]:
        spark.createDataFrame(some, RECORD).coalesce(1).write.mode("append").parquet(root)
    return changes.classify(spark.read.schema(RECORD).parquet(root))


def iter_checked(command: list[str]) -> Iterator[tuple[str, str, str | None]]:
    """The records of a diff command; an error if it fails."""
    with tempfile.TemporaryFile() as said, subprocess.Popen(command, stdout=subprocess.PIPE, stderr=said) as run:
        yield from _records(run.stdout)
        if run.wait():
            said.seek(0)
            raise ValueError(said.read().decode("utf-8", "replace").strip())


def changed_lists(spark: SparkSession, folder: str, old: str, new: str = "HEAD") -> dict[str, list]:
    """The five lists of changes, for a reader: added, modified, deleted; renamed_exact and copied_exact as (original, new)."""
    rows = diff(spark, folder, old, new).orderBy("path").toLocalIterator()
    out: dict[str, list] = {k: [] for k in ("added", "modified", "deleted", "copied_exact", "renamed_exact")}
    for r in rows:
        out[r.change_type].append({"original": r.original, "new": r.path} if r.original else r.path)
    return out


def source_changes(spark: SparkSession, folder: str, old: str, new: str = "HEAD") -> DataFrame:
    """(change_type, path): source files, renames and copies folded into deletions and additions."""
    return changes.fold(diff(spark, folder, old, new).select("change_type", "path", "original"), [])
