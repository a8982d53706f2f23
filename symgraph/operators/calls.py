"""The call graph: call sites by container or by enclosing body, edges and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, functions as F

from symgraph.functions import paths as P
from symgraph.functions.text import is_reference

# The kinds of a reference that is a call, with and without the call bit of the newer format.
CALL_KINDS_NEW = (20, 28)
CALL_KINDS_OLD = (4, 12)
CALL_BIT = 16


def feature_flags(refs: DataFrame) -> DataFrame:
    """(has_container, has_call_kind): the format of an index, from its references. Sentinels count as containers, '' does not."""
    container = F.coalesce(F.bool_or(F.col("container_id") != ""), F.lit(False))
    return refs.agg(container.alias("has_container"), F.coalesce(container | F.bool_or(F.col("kind") >= CALL_BIT), F.lit(False)).alias("has_call_kind"))


def valid_refs(refs: DataFrame, symbols: DataFrame) -> DataFrame:
    """References with place and kind to a known symbol."""
    return refs.filter("location is not null and kind is not null").join(symbols.select(F.col("id").alias("symbol_id")).distinct(), "symbol_id", "left_semi")


def sites_by_container(refs: DataFrame, functions: DataFrame) -> DataFrame:
    """(ref_id, caller_id, caller_name, callee_id, callee_name): the container is the caller; both must be functions."""
    calls = refs.filter(F.col("kind").isin(*CALL_KINDS_NEW) & is_reference(F.col("container_id")))
    callee = functions.select(F.col("id").alias("symbol_id"), F.col("name").alias("callee_name"))
    caller = functions.select(F.col("id").alias("container_id"), F.col("name").alias("caller_name"))
    return calls.join(callee, "symbol_id").join(caller, "container_id").select("ref_id", F.col("container_id").alias("caller_id"), "caller_name", F.col("symbol_id").alias("callee_id"), "callee_name")


def sites_by_body(refs: DataFrame, functions: DataFrame, bodies: DataFrame, kinds: tuple[int, ...]) -> DataFrame:
    """The same from an index without containers: the caller is the first function whose body encloses the reference; refs of the given kinds count."""
    at = F.col("location")
    sites = refs.filter(F.col("kind").isin(*kinds) & at.isNotNull()).select(F.col("ref_id").alias("site_id"), "symbol_id", P.uri_path(at["file_uri"]).alias("file"), at["start_line"].alias("line"), at["start_column"].alias("column"))
    callee = functions.select(F.col("id").alias("symbol_id"), F.col("name").alias("callee_name"))
    known = sites.join(callee, "symbol_id")
    inside = first_enclosing_body(known.withColumn("site_id", F.struct("site_id", "symbol_id", "callee_name")), bodies)
    caller = functions.select("id", F.col("name").alias("caller_name"))
    return inside.join(caller, "id").select(F.col("site_id.site_id").alias("ref_id"), F.col("id").alias("caller_id"), "caller_name", F.col("site_id.symbol_id").alias("callee_id"), F.col("site_id.callee_name").alias("callee_name"))


def call_sites(refs: DataFrame, functions: DataFrame, root: str, flags: Row) -> DataFrame:
    """Call sites by the format of the whole index (flags: of ``feature_flags`` over all its references, also where refs are some of them).

    functions: id, name, file_path below root, body_location.
    """
    if flags["has_container"]:
        return sites_by_container(refs, functions)
    b = lambda i: F.get("body_location", i)
    bodies = functions.filter("size(body_location) = 4 and file_path is not null").select("id", P.joined(F.lit(root), "file_path").alias("file"), b(0).alias("start_line"), b(1).alias("start_column"), b(2).alias("end_line"), b(3).alias("end_column"), F.col("id").alias("seq"))
    return sites_by_body(refs, functions, bodies, CALL_KINDS_NEW if flags["has_call_kind"] else CALL_KINDS_OLD)


def call_edges(sites: DataFrame) -> DataFrame:
    return sites.select("caller_id", "callee_id").distinct()


def _block(line: Column, block_lines: int) -> Column:
    return F.floor(line / F.lit(block_lines)).cast("int")


def enclosing_bodies(sites: DataFrame, bodies: DataFrame, block_lines: int = 64) -> DataFrame:
    """Every (site_id, id, start_line, seq) of a body that encloses a site, both ends inclusive.

    sites: site_id, file, line, column; bodies: id, file, start_line, start_column, end_line,
    end_column, seq. Places compare by line, then column. Sites and bodies meet by file and
    block of lines, so one huge file is spread over many tasks and no file is compared whole
    with itself; a body is copied to each block it touches.
    """
    spread = bodies.filter("end_line >= start_line").withColumn("_block", F.explode(F.sequence(_block(F.col("start_line"), block_lines), _block(F.col("end_line"), block_lines))))
    at = sites.withColumn("_block", _block(F.col("line"), block_lines)).alias("s")
    b = spread.alias("b")
    inside = (F.struct("s.line", "s.column") >= F.struct("b.start_line", "b.start_column")) & (F.struct("s.line", "s.column") <= F.struct("b.end_line", "b.end_column"))
    return at.join(b, (F.col("s.file") == F.col("b.file")) & (F.col("s._block") == F.col("b._block")) & inside).select("s.site_id", "b.id", "b.start_line", "b.seq")


def first_enclosing_body(sites: DataFrame, bodies: DataFrame, block_lines: int = 64) -> DataFrame:
    """(site_id, id): of several enclosing bodies the one that starts on the earliest line, then the first in order."""
    return enclosing_bodies(sites, bodies, block_lines).groupBy("site_id").agg(F.min(F.struct("start_line", "seq", "id")).alias("m")).select("site_id", F.col("m.id").alias("id"))


def call_stats(sites: DataFrame, functions: DataFrame | None = None) -> DataFrame:
    """Statistics of a call graph in one row. Callers and callees are told apart by name, recursion by id; n_calls counts sites.

    functions: id and body_location of the functions of the index, for how many there are and how
    many have a body. Sites are read once: what is counted by name and by site goes through one grouping.
    """
    same = F.col("caller_id") == F.col("callee_id")
    out = F.struct(F.col("caller_name").alias("name"), F.lit(1).alias("out"), F.lit(0).alias("in"), F.lit(1).alias("site"), same.cast("int").alias("again"), F.when(same, F.col("caller_id")).alias("id"))
    into = F.struct(F.col("callee_name").alias("name"), F.lit(0).alias("out"), F.lit(1).alias("in"), F.lit(0).alias("site"), F.lit(0).alias("again"), F.lit(None).cast("string").alias("id"))
    per = sites.select(F.explode(F.array(out, into)).alias("r")).groupBy("r.name").agg(
        F.max("r.out").alias("calls"), F.max("r.in").alias("called"), F.sum("r.site").alias("sites"), F.sum("r.again").alias("again"), F.count_distinct("r.id").alias("ids"),
    )
    none = lambda c: F.coalesce(F.sum(c), F.lit(0))
    total = per.agg(
        none("sites").alias("n_calls"), none("again").alias("n_recursive_calls"), none("ids").alias("n_recursive"), none("calls").alias("n_callers"), none("called").alias("n_callees"), F.count_if(F.expr("calls = 1 and called = 1")).alias("n_both"),
        F.count_if(F.expr("calls = 1 and called = 0")).alias("n_entry"), F.count_if(F.expr("calls = 0 and called = 1")).alias("n_leaf"), F.count("*").alias("n_names"),
    )
    if functions is None:
        return total
    known = functions.groupBy("id").agg(F.bool_or(F.col("body_location").isNotNull()).alias("body")).agg(F.count("*").alias("n_functions"), F.count_if("body").alias("n_with_body"))
    return known.crossJoin(total)  # one row each


def fan_out(sites: DataFrame) -> DataFrame:
    return sites.groupBy("caller_id").agg(F.count("*").alias("n_sites"), F.count_distinct("callee_id").alias("n_callees"))


def with_bodies(functions: DataFrame, spans: DataFrame) -> DataFrame:
    """Functions with body_location, matched on (name, file, line, column) of the definition; the last span of a place wins.

    functions: id, name, file, line, column; spans: the same key, seq and body.
    """
    key = ["name", "file", "line", "column"]
    last = spans.groupBy(*key).agg(F.max(F.struct("seq", "body")).alias("m")).select(*key, F.col("m.body").alias("body_location"))
    return functions.join(last, key, "left")
