"""Filling containers of fixed capacity with items, by hierarchical residual packing.

An item longer than the capacity is split: into parts of exactly the capacity, which fill a
bin each and go nowhere else, and a rest, which is packed like an item. Nothing else is
split. So each item has at most one part to pack under a budget.

Items move once, by row, to slots of about ``slot_rows``; a slot packs its items best-fit,
largest first, under each budget. Bins that are nearly full are done. The others go on as
items of their own: slots are merged ``fan_in`` at a time and the underfull bins packed
best-fit into each other, level by level, until one slot is left. A slot of any level gets
about ``slot_rows`` units at most: where the underfull bins are more, they go to more slots,
which mix them anew, and the rounds end when such a round saves less than a hundredth of
them (so where nothing fits together, after one). No unit is closed for want of room.

Defined results: items of size 0 go into a bin like others (a bin of their own if there is
no other in their slot). Null sizes count as 0. Null ids are kept as items. Rows are items:
a repeated id is packed as often as it comes, told apart by part and bin. Budgets without a
capacity above 0 give nothing.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from symgraph.session import cut

#: Underfull bins that went on: broadcast up to this many (some 20 bytes each), else joined by shuffle.
BROADCAST_MOVES = 200_000
#: A round that mixes units anew goes on if it leaves at most this share of them.
WORTHWHILE = 0.99
PLACED = "budget_id int, capacity int, slot int, item_id long, part_no int, token_from long, n_tokens int, unit long, filled int"
MERGED = "budget_id int, capacity int, slot int, unit long, target long, filled int"
RESULT = ["budget_id", "item_id", "part_no", "token_from", "n_tokens", "bin_id"]


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item, largest first into the fullest bin that still takes it."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    rest: list[tuple[int, int]] = []  # (room, bin), sorted
    out, n = [0] * len(sizes), 0
    for i in order:
        at = bisect_left(rest, (sizes[i], -1))
        if at < len(rest):
            room, b = rest.pop(at)
        else:
            room, b, n = capacity, n, n + 1
        out[i] = b
        insort(rest, (room - sizes[i], b))
    return out


def _numbered(level: int, slot: int, bins: np.ndarray) -> np.ndarray:
    """Bins of a slot as numbers that no other slot or level gives."""
    return (np.int64(level) << 56) | (np.int64(slot) << 28) | bins


def _filled(bins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.bincount(bins, sizes, minlength=1)[bins].astype(np.int32) if len(bins) else np.zeros(0, np.int32)


def full_parts(items: DataFrame, budgets: list[tuple[int, int]]) -> DataFrame:
    """The parts of exactly the capacity of items (row, item_id, size), a bin each; nothing moves."""
    each = F.explode(F.array(*[F.struct(F.lit(b).alias("budget_id"), F.lit(c).alias("capacity")) for b, c in budgets]))
    long = items.select("row", "item_id", "size", each.alias("b")).select("row", "item_id", "size", "b.*").filter("size > capacity")
    part = long.select("*", F.explode(F.sequence(F.lit(0), F.floor(F.col("size") / F.col("capacity")).cast("int") - 1)).alias("part_no"))
    at = (F.col("part_no") * F.col("capacity").cast("long")).alias("token_from")
    return part.select("budget_id", "item_id", "part_no", at, F.col("capacity").alias("n_tokens"), F.format_string("%d-full-%d-%d", "budget_id", "row", "part_no").alias("bin_id"))


def _local(budgets: list[tuple[int, int]]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def local(group: pd.DataFrame) -> pd.DataFrame:
        slot, size, out = int(group["slot"].iloc[0]), group["size"], []
        for b, c in budgets:
            one = group.assign(n_tokens=np.where(size > c, size % c, size), part_no=np.where(size > c, size // c, 0))
            one = one[(one["n_tokens"] > 0) | (size == 0)].sort_values(["n_tokens", "item_id", "part_no"], ascending=[False, True, True])
            bins = np.array(best_fit(one["n_tokens"].tolist(), c), np.int64)
            out.append(one.assign(budget_id=b, capacity=c, token_from=one["part_no"].astype(np.int64) * c, unit=_numbered(0, slot, bins), filled=_filled(bins, one["n_tokens"].to_numpy())))
        return pd.concat(out)[["budget_id", "capacity", "slot", "item_id", "part_no", "token_from", "n_tokens", "unit", "filled"]]

    return local


def _merge(level: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def merge(group: pd.DataFrame) -> pd.DataFrame:
        c, s = (int(group[x].iloc[0]) for x in ("capacity", "slot"))
        group = group.sort_values(["filled", "unit"], ascending=[False, True])
        bins = np.array(best_fit(group["filled"].tolist(), c), np.int64)
        return group.assign(target=_numbered(level, s, bins), filled=_filled(bins, group["filled"].to_numpy()))[["budget_id", "capacity", "slot", "unit", "target", "filled"]]

    return merge


def pack(items: DataFrame, budgets: DataFrame, slot_rows: int = 20000, fan_in: int = 8, nearly_full: float = 0.99) -> DataFrame:
    """(budget_id, item_id, part_no, token_from, n_tokens, bin_id) for items (item_id, size) and budgets (budget_id, capacity).

    Each budget is a packing of all items, so budgets are few and the driver knows them.
    """
    spark = items.sparkSession
    known = sorted({(int(r.budget_id), int(r.capacity)) for r in budgets.filter("budget_id is not null and capacity > 0").select("budget_id", "capacity").distinct().collect()})
    if not known:
        return spark.createDataFrame([], "budget_id int, item_id long, part_no int, token_from long, n_tokens int, bin_id string")
    items = cut(items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("size").cast("int"), F.lit(0)).alias("size")), "packing-items")
    n = max(1, -(-items.count() // slot_rows))
    # by row, not by id: rows that share an id are spread too; the written table gives the same row numbers again
    items = items.withColumn("row", F.monotonically_increasing_id())
    spread = items.select(F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias("slot"), "item_id", "size")
    placed = cut(spread.groupBy("slot").applyInPandas(_local(known), PLACED), "packing")

    def underfull(df: DataFrame, unit: str) -> tuple[DataFrame, list[int]]:
        """The units that go on, and how many of each budget."""
        got = df.filter(F.col("filled") < F.col("capacity") * nearly_full).select("budget_id", "capacity", "slot", F.col(unit).alias("unit"), "filled").distinct()
        return got, [r["count"] for r in got.groupBy("budget_id").count().collect()]

    moves, level, n_moves = None, 0, 0
    units, counts = underfull(placed, "unit") if n > 1 else (None, [])
    while n > 1 and counts:
        level, before = level + 1, sum(counts)
        n_moves += before
        fewer = max(-(-n // fan_in), -(-max(counts) // slot_rows))
        anew = fewer >= n
        slot = F.pmod(F.xxhash64("unit"), F.lit(fewer)) if anew else F.floor(F.col("slot") * F.lit(fewer) / F.lit(n))
        n = fewer
        up = units.withColumn("slot", slot.cast("int"))
        merged = cut(up.groupBy("budget_id", "capacity", "slot").applyInPandas(_merge(level), MERGED), "packing")
        step = merged.select("budget_id", "unit", "target")
        if moves is not None:
            onward = step.select("budget_id", F.col("unit").alias("target"), F.col("target").alias("next"))
            step = moves.join(onward, ["budget_id", "target"], "left").select("budget_id", "unit", F.coalesce("next", "target").alias("target")).unionByName(step)
        moves = step
        units, counts = underfull(merged, "target")
        if anew and sum(counts) > WORTHWHILE * before:
            break

    if moves is not None:
        moves = moves.join(placed.filter(F.col("filled") < F.col("capacity") * nearly_full).select("budget_id", "unit").distinct(), ["budget_id", "unit"], "left_semi") if level > 1 else moves
        beside = F.broadcast if n_moves <= BROADCAST_MOVES else lambda x: x
        placed = placed.join(beside(moves), ["budget_id", "unit"], "left").withColumn("unit", F.coalesce("target", "unit"))
    bins = placed.withColumn("bin_id", F.concat_ws("-", "budget_id", F.hex("unit"))).select(*RESULT)
    return bins.unionByName(full_parts(items, known))


def check(packed: DataFrame, items: DataFrame, budgets: DataFrame) -> DataFrame:
    """(budget_id, n_items, n_overfull, n_lost, n_twice): whether each token of each item (item_id unique) is in one bin of no more than the capacity.

    n_lost and n_twice count items of whose tokens some are in no bin, or in two.
    """
    known = budgets.select(F.col("budget_id").cast("int").alias("budget_id"), F.col("capacity").cast("int").alias("capacity"))
    full = packed.groupBy("budget_id", "bin_id").agg(F.sum("n_tokens").alias("filled")).join(F.broadcast(known), "budget_id").groupBy("budget_id").agg(F.count_if(F.col("filled") > F.col("capacity")).alias("n_overfull"))
    # parts that lie side by side from 0 on have as many tokens as the item, and no two begin at one place
    per = packed.groupBy("budget_id", "item_id").agg(F.sum("n_tokens").alias("got"), F.max(F.col("token_from") + F.col("n_tokens")).alias("end"), F.count("*").alias("n"), F.count_distinct("token_from").alias("n_from"))
    both = per.join(items.select("item_id", F.col("size").alias("want")), "item_id", "left")
    sums = both.groupBy("budget_id").agg(F.count("*").alias("n_items"), F.count_if((F.col("got") < F.col("want")) | (F.col("end") < F.col("want"))).alias("n_lost"), F.count_if((F.col("got") > F.col("want")) | (F.col("n") > F.col("n_from"))).alias("n_twice"))
    return sums.join(full, "budget_id").select("budget_id", "n_items", "n_overfull", "n_lost", "n_twice")


def fill_report(packed: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per budget: items, bins, the least possible number of bins by size alone, the fullest bin, and the share of space used."""
    bins = packed.groupBy("budget_id", "bin_id").agg(F.sum("n_tokens").alias("filled"), F.count("*").alias("n"))
    per = bins.groupBy("budget_id").agg(F.sum("n").alias("n_parts"), F.count("*").alias("n_bins"), F.sum("filled").alias("n_tokens"), F.max("filled").alias("fullest"))
    known = budgets.select(F.col("budget_id").cast("int").alias("budget_id"), F.col("capacity").cast("int").alias("capacity"))
    return per.join(known, "budget_id").withColumns({"least_bins": F.ceil(F.col("n_tokens") / F.col("capacity")), "share_used": F.round(F.col("n_tokens") / (F.col("n_bins") * F.col("capacity")), 4)})
