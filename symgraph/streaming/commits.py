"""Commits as a stream: files of changes that arrive are folded and taken in exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from symgraph.operators import changes


def stream_changes(spark: SparkSession, source: str, schema, target: str, checkpoint: str, keep: list[str], available_now: bool = True) -> StreamingQuery:
    """Fold each micro-batch of commit rows into (keep, change_type, path) below ``target``.

    A batch writes to its own folder and replaces what a failed attempt left, so a repeat
    after a failure neither loses nor repeats rows; the checkpoint knows which files are done.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        changes.fold(changes.listed_changes(batch, keep), keep).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    stream = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if available_now else stream).start()
