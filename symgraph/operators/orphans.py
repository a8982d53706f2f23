"""References to records that do not exist: a fixpoint cascade down the foreign-key graph.

A child value is a *direct* orphan if no row of the parent was alive under that key when
the child was loaded. It is an *inherited* orphan if live parent rows exist, but each of
them is itself an orphan (direct or inherited). Rounds of semi- and anti-joins go down the
foreign-key graph, with or without cycles: the orphans of a round are written to the shared
folder, and the next round looks only at the tables that refer to one of their tables, and
there only at values that name a key of a row that became an orphan in the last round. It
ends when no orphan of a round can itself be referred to.

Defined results: null, '' and all-zero values are no references. A child row delivered
more than once is judged by the delivery with the earliest load time (a null load time is
the latest; of equal times the smallest values count). A row of which the load time is null
sees no parent row that needs one, so its references are direct orphans with a null month; a
child table without a load time sees every parent row that there ever was. Keys compare
without surrounding blanks, and in upper case unless their parent says ``exact``. Rows
without a row id take no part. Empty tables give empty results. Rows on a cycle of which
each lives by the next are no orphans.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from symgraph.functions.text import is_reference, symbol_key, trimmed
from symgraph.session import cut

#: A key that holds more than this share of the references is salted.
HOT_SHARE = 0.01
SALTS = 16
OUTPUT = ["src_table", "ref_field", "row_id", "ref_key", "loaded_at", "orphan_kind", "depth"]


@dataclass(frozen=True)
class Parent:
    """Rows that can be referred to. live_from / live_to: columns, or None for 'always'."""

    name: str
    rows: DataFrame
    key: str
    live_from: str | None = None
    live_to: str | None = None
    row_id: Column | None = None
    exact: bool = False  # keys compare as they are written, but for blanks around them


@dataclass(frozen=True, eq=False)
class Child:
    """Rows with references: row_id identifies a record over its deliveries."""

    name: str
    rows: DataFrame
    row_id: Column
    loaded_at: str | None
    fields: dict[str, str] = field(default_factory=dict)  # field -> name of the parents' group


def hot_keys(values: DataFrame, key: str, share: float = HOT_SHARE) -> list[str]:
    """Keys that may hold more than ``share`` of the rows, from a sketch over all rows.

    The list has at most 2 / share entries whatever the data holds. It only steers salting:
    a wrong entry costs a few copied rows and never changes a result.
    """
    k = int(2 / share)
    got = values.agg(F.expr(f"approx_top_k({key}, {k}, {k * 8})").alias("top"), F.count(key).alias("n")).head()
    return [x["item"] for x in got["top"] or [] if x["item"] is not None and x["count"] > share * got["n"]]


def _salted(df: DataFrame, key: str, hot: list[str], by: str | None) -> DataFrame:
    if not hot:
        return df.withColumn("_salt", F.lit(0))
    is_hot = F.col(key).isin(hot)
    if by:
        return df.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).otherwise(F.lit(0)))
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    return df.withColumn("_salt", F.explode(F.when(is_hot, every).otherwise(F.array(F.lit(0)))))


def _alive(v: DataFrame, p: DataFrame) -> Column:
    at = v["loaded_at"]
    return (v["ref_key"] == p["key"]) & (v["_salt"] == p["_salt"]) & (p["always"] | v["any_time"] | ((p["live_from"] <= at) & (at < p["live_to"])))


def _periods(lives: DataFrame) -> DataFrame:
    """Lives of a key that touch or overlap as one period, so that a key delivered over and over is a few rows."""
    early, late = (F.lit(x).cast("timestamp") for x in ("0001-01-01", "9999-12-31"))
    each = lives.select("key", "always", F.coalesce("live_from", early).alias("live_from"), F.coalesce("live_to", late).alias("live_to")).filter("live_from < live_to")
    before = W.partitionBy("key").orderBy("live_from", "live_to").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy("key").orderBy("live_from", "live_to").rowsBetween(W.unboundedPreceding, W.currentRow)
    apart = each.withColumn("_new", F.coalesce((F.col("live_from") > F.max("live_to").over(before)).cast("int"), F.lit(1)))
    numbered = apart.withColumn("_no", F.sum("_new").over(upto))
    return numbered.groupBy("key", "_no").agg(F.min("live_from").alias("live_from"), F.max("live_to").alias("live_to"), F.max("always").alias("always")).drop("_no")


def _lives(parents: list[Parent], with_row: bool = False) -> DataFrame:
    out = None
    for p in parents:
        start = F.col(p.live_from) if p.live_from else F.lit(None).cast("timestamp")
        end = F.col(p.live_to) if p.live_to else F.lit(None).cast("timestamp")
        row = [F.lit(p.name).alias("parent_table"), (p.row_id if p.row_id is not None else F.lit(None)).cast("string").alias("parent_row")]
        one = p.rows.select(_key(p.key, p.exact).alias("key"), start.cast("timestamp").alias("live_from"), end.cast("timestamp").alias("live_to"), F.lit(p.live_from is None).alias("always"), *(row if with_row else []))
        out = one if out is None else out.unionByName(one)
    return out.filter(is_reference(F.col("key")) & (F.col("always") | F.col("live_from").isNotNull())).distinct()


def _key(c: str, exact: bool) -> Column:
    return trimmed(c) if exact else symbol_key(c)


def reference_values(child: Child, groups: dict[str, list[Parent]]) -> DataFrame:
    """One row per record and field that names something: (src_table, ref_field, row_id, ref_key, loaded_at, any_time)."""
    at = F.col(child.loaded_at).cast("timestamp") if child.loaded_at else F.lit(None).cast("timestamp")
    values = [_key(f, any(p.exact for p in groups[g])).alias(f"_f{i}") for i, (f, g) in enumerate(child.fields.items())]
    rows = child.rows.select(child.row_id.alias("row_id"), at.alias("_at"), *values)
    first = rows.filter(F.col("row_id").isNotNull()).groupBy("row_id").agg(F.min(F.struct(F.col("_at").isNull().alias("late"), "_at", *[f"_f{i}" for i in range(len(child.fields))])).alias("r"))
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("ref_field"), F.col(f"r._f{i}").alias("ref_key")) for i, f in enumerate(child.fields)]))
    named = first.select("row_id", F.col("r._at").alias("loaded_at"), each.alias("v")).select(F.lit(child.name).alias("src_table"), "v.ref_field", F.col("row_id").cast("string").alias("row_id"), "v.ref_key", "loaded_at")
    return named.filter(is_reference(F.col("ref_key"))).withColumn("any_time", F.lit(child.loaded_at is None))


def _without(values: DataFrame, lives: DataFrame, hot: list[str], how: str) -> DataFrame:
    v, p = _salted(values, "ref_key", hot, "row_id"), _salted(_periods(lives), "key", hot, None)
    return v.join(p, _alive(v, p), how).drop("_salt")


def orphan_cascade(children: list[Child], groups: dict[str, list[Parent]], hot: dict[str, list[str]] | None = None, max_rounds: int = 1000) -> DataFrame:
    """Every orphan reference with its kind: OUTPUT columns; depth 0 is direct, n inherited in round n."""
    hot, values, direct = dict(hot or {}), {}, []
    for c in children:
        if c.name not in hot:
            keys = c.rows.select(F.explode(F.array(*[_key(f, any(p.exact for p in groups[g])) for f, g in c.fields.items()])).alias("k"))
            hot[c.name] = hot_keys(keys.filter(is_reference(F.col("k"))), "k")
    mark = lambda df, kind, depth: df.withColumns({"orphan_kind": F.lit(kind), "depth": F.lit(depth)}).select(*OUTPUT)
    for c in children:
        all_values = reference_values(c, groups)
        for g in dict.fromkeys(c.fields.values()):
            values[c, g] = all_values.filter(F.col("ref_field").isin([f for f, of in c.fields.items() if of == g]))
            direct.append(mark(_without(values[c, g], _lives(groups[g]), hot[c.name], "left_anti"), "direct", 0))

    union = lambda dfs: reduce(DataFrame.unionByName, dfs)
    tables = {c.name for c in children}
    parents = sorted({p.name for ps in groups.values() for p in ps} & tables)  # tables that refer and are referred to
    parent_rows = lambda df: df.filter(F.col("src_table").isin(parents)).select(F.col("src_table").alias("parent_table"), F.col("row_id").alias("parent_row")).distinct()

    def inherited(c: Child, g: str, new: DataFrame, orphans: DataFrame, depth: int) -> DataFrame:
        """References with live parents, one of them a new orphan, of which none is healthy."""
        lives = _lives(groups[g], with_row=True)
        row = ["parent_table", "parent_row"]
        fallen, healthy = lives.join(new, row, "left_semi"), lives.join(orphans, row, "left_anti")
        return mark(_without(_without(values[c, g], fallen, hot[c.name], "left_semi"), healthy, hot[c.name], "left_anti"), "inherited", depth)

    total = found = cut(union(direct), "orphans")
    for depth in range(1, max_rounds + 1):
        fallen = parent_rows(found)
        reached = {r.parent_table for r in fallen.select("parent_table").distinct().collect()}  # names of tables
        below = [(c, g) for c, g in values if any(p.name in reached for p in groups[g])]
        if not below:
            return total
        orphans = parent_rows(total)
        new = union([inherited(c, g, fallen, orphans, depth) for c, g in below])
        found = cut(new.join(total, ["src_table", "ref_field", "row_id"], "left_anti"), "orphans")
        total = total.unionByName(found)
    raise RuntimeError(f"no fixpoint after {max_rounds} rounds")


def why_missing(orphans: DataFrame, parents: list[Parent]) -> DataFrame:
    """Adds reason: never (no parent row ever had the key), not_yet (only later ones), removed (earlier ones have ended), or parent_orphan (inherited)."""
    first = _lives(parents).groupBy("key").agg(F.min("live_from").alias("first_at"), F.max("always").alias("_always"))
    o = orphans.join(first, orphans["ref_key"] == first["key"], "left")
    reason = F.when(F.col("orphan_kind") == "inherited", "parent_orphan").when(F.col("key").isNull(), "never").when(F.col("first_at") > F.col("loaded_at"), "not_yet").when(F.col("loaded_at").isNull(), "not_yet").otherwise("removed")
    return o.withColumn("reason", reason).drop("key", "first_at", "_always")


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Counts per table, field, month, kind and reason."""
    return orphans.withColumn("month_key", F.date_format("loaded_at", "yyyy-MM")).groupBy("src_table", "ref_field", "month_key", "orphan_kind", "reason").agg(F.count("*").alias("n_refs"), F.countDistinct("ref_key").alias("n_keys"))
