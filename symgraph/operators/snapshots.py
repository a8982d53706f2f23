"""What changed between full snapshots: a two-pointer merge over range-partitioned, sorted keys.

All rows of all snapshots are range-partitioned by (table, key) and sorted by (table, key,
snapshot, sequence) in one exchange, the only one that content goes through. A single forward
pass over each range then passes over rows that a later one of the same snapshot replaces,
holds two neighbouring rows of a key at a time (the two pointers) and emits a typed change
where they differ; the right side of one comparison is the left side of the next. Range
partitioning satisfies the clustering that the pass needs, so there is no second shuffle. A
key's rows are as many as its snapshots and repeats, so a table or a snapshot that holds
most of the rows is still spread over many ranges.

Which snapshot precedes which comes from the distinct (table, number) pairs, joined to what
the pass emits: broadcast up to ``BROADCAST_NUMBERS`` pairs, by shuffle of (table, number, key)
without content beyond.

Defined results: within a snapshot the row with the greatest sequence number stands for a
key (null is the least; of equal ones the greatest content). Null equals '' and surrounding
blanks do not count; a struct is compared field by field, and a null struct equals one
whose fields are all null or ''. Rows without a group, snapshot or key take no part. A
group's first snapshot gives no change; numbers that are left out do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from symgraph.functions.text import plain, symbol_key
from symgraph.session import cut

#: Distinct (table, number) pairs up to this many (some 50 bytes each) are broadcast.
BROADCAST_NUMBERS = 200_000


def content(df: DataFrame, columns: list[str]) -> Column:
    """The compared columns of a row as one struct, each in its plain form."""

    def one(c: Column, t: T.DataType, name: str) -> list[Column]:
        if isinstance(t, T.StructType):
            return [x for f in t.fields for x in one(c.getField(f.name), f.dataType, f"{name}_{f.name}")]
        return [(plain(c) if isinstance(t, T.StringType) else c).alias(name)]

    return F.struct(*[x for c in columns for x in one(df[c], df.schema[c].dataType, c)])


def snapshot_changes(snapshots: DataFrame, group: str, number: str, key: str, sequence: str, compared: list[str], ranges: int | None = None) -> DataFrame:
    """(group, number, key, change_kind): added, removed or changed, at the later snapshot."""
    rows = snapshots.select(F.col(group).alias("_g"), F.col(number).alias("_n"), symbol_key(key).alias("_k"), F.col(sequence).alias("_s"), content(snapshots, compared).alias("_c"))
    rows = rows.filter(F.col("_g").isNotNull() & F.col("_n").isNotNull() & F.col("_k").isNotNull())
    per_group = W.partitionBy("_g").orderBy("_n")
    present = snapshots.select(F.col(group).alias("_g"), F.col(number).alias("_n")).filter(F.col("_g").isNotNull() & F.col("_n").isNotNull() & symbol_key(key).isNotNull()).distinct()
    numbers = cut(present.withColumns({"_before": F.lag("_n").over(per_group), "_after": F.lead("_n").over(per_group)}), "snapshots")
    beside = F.broadcast if numbers.count() <= BROADCAST_NUMBERS else lambda x: x

    by = [F.col("_g"), F.col("_k")]
    ranged = rows.repartitionByRange(ranges, *by) if ranges else rows.repartitionByRange(*by)
    order = [F.col("_n"), F.col("_s").desc_nulls_last(), F.col("_c").desc()]
    along = W.partitionBy("_g", "_k").orderBy(*order)
    chosen = ranged.withColumn("_same", F.lag("_n").over(along)).filter(~F.col("_n").eqNullSafe(F.col("_same")))
    pair = chosen.select("_g", "_n", "_k", F.lag("_n").over(along).alias("_left_n"), F.lead("_n").over(along).alias("_right_n"), (~F.lag("_c").over(along).eqNullSafe(F.col("_c"))).alias("_differs"))
    merged = pair.join(beside(numbers), ["_g", "_n"])
    is_next = F.col("_left_n").eqNullSafe(F.col("_before"))
    here = F.when(F.col("_before").isNotNull() & ~is_next, F.struct(F.col("_n").alias("n"), F.lit("added").alias("kind"))).when(F.col("_before").isNotNull() & is_next & F.col("_differs"), F.struct(F.col("_n").alias("n"), F.lit("changed").alias("kind")))
    gone = F.when(F.col("_after").isNotNull() & ~F.col("_right_n").eqNullSafe(F.col("_after")), F.struct(F.col("_after").alias("n"), F.lit("removed").alias("kind")))
    return merged.select("_g", "_k", F.explode(F.array_compact(F.array(here, gone))).alias("x")).select(F.col("_g").alias(group), F.col("x.n").alias(number), F.col("_k").alias(key), F.col("x.kind").alias("change_kind"))


def change_report(changes: DataFrame, group: str, number: str) -> DataFrame:
    """Counts per snapshot and kind."""
    return changes.groupBy(group, number, "change_kind").agg(F.count("*").alias("n_keys"))
