"""Queries on the code graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from symgraph.functions import paths as P
from symgraph.functions.text import symbol_key
from symgraph.operators import calls, changes, enrich, nodes, render, store, traverse
from symgraph.plans import views as V
from symgraph.session import cut, table
from symgraph.sources import markers

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _rows(s: SparkSession, d: str) -> DataFrame:
    return nodes.symbol_rows(V.symbols(s, d))


def _functions(s: SparkSession, d: str) -> DataFrame:
    return nodes.functions(_rows(s, d))


def _sites(s: SparkSession, d: str) -> DataFrame:
    return calls.sites_by_container(V.refs(s, d), V.functions(s, d))


def _calls(s: SparkSession, d: str) -> DataFrame:
    return calls.call_edges(_sites(s, d))


def _files(s: SparkSession, d: str) -> DataFrame:
    return nodes.file_nodes(V.symbols(s, d))


def _defines(s: SparkSession, d: str) -> DataFrame:
    return nodes.defines_edges(_rows(s, d), _files(s, d))


# Symbols, files and folders


@query
def feature_flags(s, d):
    return calls.feature_flags(V.refs(s, d))


@query
def last_wins_symbols(s, d):
    return V.symbols(s, d).select("id", "project_path", "name", "kind", "loaded_at")


@query
def symbol_rows(s, d):
    rows = _rows(s, d)
    return rows.select(*[c for c in rows.columns if c != "name_location"], F.get("name_location", 0).alias("name_line"), F.get("name_location", 1).alias("name_column"))


@query
def kind_routing(s, d):
    label = F.when(F.col("kind").isin(*nodes.FUNCTION_KINDS), "FUNCTION").when(F.col("kind").isin(*nodes.STRUCTURE_KINDS), "DATA_STRUCTURE").otherwise("none")
    return _rows(s, d).groupBy(label.alias("label")).agg(F.count("*").alias("n"), F.count("file_path").alias("n_defined"))


@query
def kind_histogram(s, d):
    return nodes.kind_histogram(V.symbols(s, d, columns=("name", "kind")))


@query
def file_nodes(s, d):
    return _files(s, d)


@query
def folder_nodes(s, d):
    return nodes.folder_nodes(_files(s, d))


@query
def contains_edges(s, d):
    files = _files(s, d)
    return nodes.contains_edges(files, nodes.folder_nodes(files))


@query
def defines_edges(s, d):
    return _defines(s, d)


@query
def definitions_by_file(s, d):
    return nodes.definitions_by_file(_defines(s, d))


@query
def header_language(s, d):
    return nodes.header_language(_files(s, d))


@query
def schema_triples(s, d):
    files = _files(s, d)
    edges = {"CONTAINS": (nodes.contains_edges(files, nodes.folder_nodes(files)), "src_label", "dst_label"), "DEFINES": (_defines(s, d).withColumn("src_label", F.lit("FILE")), "src_label", "dst_label"), "CALLS": (_calls(s, d), None, None)}
    return store.edge_types(edges, {"CALLS": ("FUNCTION", "FUNCTION")})


@query
def folder_drawing(s, d):
    files = _files(s, d)
    return render.dot_lines(nodes.folder_nodes(files), "path", "parent_path", "name")


@query
def span_listing(s, d):
    f = V.function_nodes(s, d, "name", "file_path", "name_location", "body_location").filter("body_location is not null")
    spans = f.select(F.col("file_path").alias("file"), "name", F.get("name_location", 0).alias("line"), F.get("name_location", 1).alias("column"), F.col("body_location").alias("body"))
    return render.span_listing(spans)


# Calls


@query
def call_sites(s, d):
    return _sites(s, d).select("ref_id", "caller_id", "caller_name", "callee_id", "callee_name")


@query
def call_edges(s, d):
    return _calls(s, d)


@query
def call_edges_stored(s, d):
    return nodes.pair_edges(_calls(s, d), _functions(s, d), "caller_id", "callee_id", "id")


@query
def call_stats(s, d):
    nodes = V.function_nodes(s, d, "body_location").select(symbol_key("id").alias("id"), "body_location")
    return calls.call_stats(_sites(s, d), V.functions(s, d).join(nodes, "id", "left"))


@query
def call_fanout(s, d):
    return calls.fan_out(_sites(s, d))


@query
def entry_functions(s, d):
    """Names that call and are never called."""
    sites = _sites(s, d)
    return sites.select(F.col("caller_name").alias("name")).distinct().join(sites.select(F.col("callee_name").alias("name")).distinct(), "name", "left_anti")


@query
def valid_refs(s, d):
    return calls.valid_refs(V.refs(s, d, place=True), V.symbols(s, d, columns=("name",))).groupBy("kind").agg(F.count("*").alias("n"))


@query
def interval_all_matches(s, d):
    return calls.enclosing_bodies(V.call_sites(s, d), V.bodies(s, d)).select("site_id", "id")


@query
def interval_first_match(s, d):
    return calls.first_enclosing_body(V.call_sites(s, d), V.bodies(s, d))


@query
def span_enrichment(s, d):
    """Bodies of functions by name and place of the name, files told apart by project."""
    f = _functions(s, d).filter("file_path is not null").select("id", "name", P.joined("project_path", "file_path").alias("file"), F.get("name_location", 0).alias("line"), F.get("name_location", 1).alias("column"))
    found = V.function_nodes(s, d, "name", "file_path", "name_location", "body_location").filter("body_location is not null").withColumn("id", symbol_key("id"))
    project = V.symbols(s, d, columns=("project_path",)).select("id", "project_path")
    spans = found.join(project, "id").select("name", P.joined("project_path", "file_path").alias("file"), F.get("name_location", 0).alias("line"), F.get("name_location", 1).alias("column"), F.col("id").alias("seq"), F.col("body_location").alias("body"))
    return calls.with_bodies(f, spans).select("id", F.get("body_location", 0).alias("first_line"), F.get("body_location", 2).alias("last_line"))


@query
def call_sites_old(s, d):
    """Calls of the older format: references without container and call bit, each in the body around it."""
    refs = V.refs(s, d, place=True).filter("container_id = ''")
    return calls.sites_by_body(refs, V.functions(s, d), V.bodies(s, d), calls.CALL_KINDS_OLD)


@query
def call_edge_script(s, d):
    return store.edge_script(_calls(s, d), "calls")


@query
def span_totals(s, d):
    """How many functions in files there are, and how many a body was found for."""
    return span_enrichment(s, d).agg(F.count("*").alias("n_functions"), F.count("first_line").alias("n_matched"))


@query
def node_json(s, d):
    """Functions as JSON texts, as they go to another engine."""
    rows = _functions(s, d).select("id", "name", "kind", "scope", "has_definition", "file_path")
    return rows.select("id", F.to_json(F.struct("name", "kind", "scope", "has_definition", "file_path")).alias("document"))


# Includes and impact


@query
def includes_edges(s, d):
    """Include pairs of which both ends are files."""
    return nodes.pair_edges(V.includes(s, d), _files(s, d).select(P.joined("project_path", "path").alias("path")), "including", "included", "path")


@query
def include_groups(s, d):
    return nodes.grouped_includes(V.includes(s, d)).select("including", "n", F.concat_ws(",", "included").alias("included"))


@query
def reverse_includes(s, d):
    return V.includes(s, d).groupBy("included").agg(F.count_distinct("including").alias("n_including"))


def _changed_headers(s: SparkSession, d: str) -> DataFrame:
    """(seed), absolute: headers that some commit modifies or deletes."""
    return changes.changed_headers(changes.fold(_changes(s, d), _COMMIT)).select(P.joined("project_path", "path").alias("seed")).distinct()


@query
def impact_transitive(s, d):
    return traverse.impact(V.includes(s, d), _changed_headers(s, d), "including", "included")


@query
def impact_no_seed(s, d):
    return traverse.impact(V.includes(s, d), _changed_headers(s, d), "including", "included", with_seed=False)


@query
def impact_sources(s, d):
    return traverse.impacted_sources(V.includes(s, d), _changed_headers(s, d), "including", "included").select("seed", F.concat_ws(",", "sources").alias("sources"))


@query
def impact_all_headers(s, d):
    """How many files each included header reaches: the closure of all headers."""
    edges = cut(V.includes(s, d), "includes")
    return traverse.impact(edges, V.headers(edges), "including", "included").groupBy("seed").agg(F.count("*").alias("n_files"))


@query
def file_nodes_with_includes(s, d):
    """Files of symbols and, in their project, of both ends of include pairs."""
    roots = table(s, d, "project").select(F.col("path").alias("project_path"))
    pairs = V.includes(s, d).withColumn("_at", F.explode(P.ancestors("including")))
    return nodes.file_nodes(V.symbols(s, d), pairs.join(roots, F.col("_at") == F.col("project_path")).select("project_path", "including", "included"))


@query
def top_included(s, d):
    return traverse.top_included(V.includes(s, d), 20)


@query
def similar_headers(s, d):
    """Changed headers that nothing includes, with included files of the same name."""
    return traverse.similar_headers(V.includes(s, d), _changed_headers(s, d)).select("seed", F.concat_ws(",", "similar").alias("similar"))


# Neighbourhoods


def _seeds(s: SparkSession, d: str) -> DataFrame:
    """Functions that wait for a code summary."""
    return enrich.needs_code_summary(V.function_nodes(s, d, "code_summary", "body_location")).select("id")


@query
def neighbours_one_hop(s, d):
    return traverse.neighbours(_seeds(s, d), _calls(s, d))


def _summarised(s: SparkSession, d: str) -> DataFrame:
    """(id, code_summary, summary) of function nodes."""
    return V.function_nodes(s, d, "code_summary", "summary").withColumn("id", symbol_key("id"))


@query
def call_context(s, d):
    return traverse.call_context(_summarised(s, d), _calls(s, d)).select("id", F.concat_ws(" | ", "callers").alias("callers"), F.concat_ws(" | ", "callees").alias("callees"))


@query
def subset_one_hop(s, d):
    return traverse.subset_one_hop(_seeds(s, d), V.refs(s, d))


@query
def files_of_symbols(s, d):
    return _defines(s, d).join(_seeds(s, d), "id", "left_semi").select("project_path", "file_path").distinct()


@query
def node_degrees(s, d):
    return traverse.degrees(_calls(s, d))


@query
def disconnected_functions(s, d):
    return store.disconnected(_functions(s, d).select("id"), "id", [_calls(s, d), _defines(s, d).select("id")])


@query
def uncalled_symbols(s, d):
    """Functions and data structures at no end of a call."""
    return store.disconnected(_rows(s, d).filter(F.col("kind").isin(*nodes.FUNCTION_KINDS, *nodes.STRUCTURE_KINDS)).select("id", "kind"), "id", [_calls(s, d)])


@query
def leaf_functions(s, d):
    """Names that are called and never call."""
    sites = _sites(s, d)
    return sites.select(F.col("callee_name").alias("name")).distinct().join(sites.select(F.col("caller_name").alias("name")).distinct(), "name", "left_anti")


# Maintenance


@query
def overlay_upsert(s, d):
    """Current symbols over ended ones by id; the current ones take the return type away."""
    fields = ["id", "name", "kind", "signature", "return_type"]
    old = V.symbols(s, d, "ended").select(*fields)
    new = V.symbols(s, d, "current").select("id", "name", F.nullif("kind", F.lit("")).alias("kind"), F.nullif("signature", F.lit("")).alias("signature"), F.array(F.lit("return_type")).alias("gone"))
    return store.overlay(old, new, ["id"], "gone")


@query
def overlay_structures(s, d):
    """The same for data structures."""
    one = lambda which: V.symbols(s, d, which).filter(F.col("kind").isin(*nodes.STRUCTURE_KINDS)).select("id", "name", F.nullif("scope", F.lit("")).alias("scope"))
    return store.overlay(one("ended"), one("current"), ["id"])


@query
def purge_counts(s, d):
    """(what, n_before, n_after) of a purge of deleted files."""
    f, defines, edges = _functions(s, d).select("id"), _absolute_defines(s, d), _calls(s, d)
    kept, left, cut_edges = store.purge_symbols(f, defines, {"calls": (edges, ["caller_id", "callee_id"])}, _gone_files(s, d))
    return store.purge_counts({"functions": (f, kept), "defines": (defines, left), "calls": (edges, cut_edges["calls"])})


@query
def write_counts(s, d):
    return store.write_counts(V.symbols(s, d, "ended"), V.symbols(s, d, "current"), ["id"])


def _gone_files(s: SparkSession, d: str) -> DataFrame:
    """(path), absolute: files that some commit deletes or renames."""
    folded = changes.fold(_changes(s, d), _COMMIT)
    return folded.filter("change_type = 'deleted'").select(P.joined("project_path", "path").alias("path")).distinct()


def _absolute_defines(s: SparkSession, d: str) -> DataFrame:
    return _defines(s, d).select(P.joined("project_path", "file_path").alias("file_path"), "id")


@query
def purge_symbols(s, d):
    kept, _, _ = store.purge_symbols(_functions(s, d).select("id"), _absolute_defines(s, d), {}, _gone_files(s, d))
    return kept


@query
def purge_call_edges(s, d):
    _, _, edges = store.purge_symbols(_functions(s, d).select("id"), _absolute_defines(s, d), {"calls": (_calls(s, d), ["caller_id", "callee_id"])}, _gone_files(s, d))
    return edges["calls"]


@query
def purge_includes(s, d):
    return store.purge_includes(V.includes(s, d), _gone_files(s, d))


@query
def prune_folders(s, d):
    full = lambda df: df.select(P.joined("project_path", "path").alias("path"))
    files = _files(s, d)
    left = store.without_keys(full(files), _gone_files(s, d), "path", "path")
    return store.prune_folders(full(nodes.folder_nodes(files)), left)


@query
def property_counts(s, d):
    return store.property_count({"FUNCTION": V.function_nodes(s, d, "summary"), "PROJECT": table(s, d, "project"), "FILE": _files(s, d)}, "summary")


@query
def duplicate_keys(s, d):
    return store.duplicate_keys(table(s, d, "function_nodes"), "id")


# Changes


_COMMIT = ["project_path", "commit_hash"]


def _changes(s: SparkSession, d: str) -> DataFrame:
    return changes.listed_changes(table(s, d, "git_changes"), _COMMIT)


@query
def listed_changes(s, d):
    return _changes(s, d)


@query
def raw_diff_classes(s, d):
    """Changes written as raw diff records and read back."""
    one = lambda c, letter: F.transform(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda p: p != ""), lambda p: F.concat(F.lit(f":100644 100644 0000000 1111111 {letter}\x00"), p))
    pairs = lambda c, letter: F.transform(F.coalesce(c, F.array().cast("array<struct<original:string,new:string>>")), lambda p: F.concat(F.lit(f":100644 100644 0000000 1111111 {letter}100\x00"), p["original"], F.lit("\x00"), p["new"]))
    raw = table(s, d, "git_changes").select(*_COMMIT, F.array_join(F.concat(one("added", "A"), one("modified", "M"), one("deleted", "D"), pairs("renamed_exact", "R"), pairs("copied_exact", "C")), "\x00").alias("raw"))
    return changes.classify(changes.parse_raw_diff(raw, "raw", _COMMIT)).groupBy("change_type").agg(F.count_distinct("commit_hash", "path").alias("n"))


@query
def rename_fold(s, d):
    return changes.fold(_changes(s, d), _COMMIT)


@query
def changed_headers(s, d):
    return changes.changed_headers(changes.fold(_changes(s, d), _COMMIT)).select(*_COMMIT, "path").distinct()


@query
def dirty_files(s, d):
    return changes.dirty_files(changes.fold(_changes(s, d), _COMMIT), _COMMIT)


@query
def purge_scope(s, d):
    folded = changes.fold(_changes(s, d), _COMMIT)
    return changes.purge_scope(folded, _COMMIT, changes.dirty_files(folded, _COMMIT))


@query
def dirty_symbols(s, d):
    dirty = changes.dirty_files(changes.fold(_changes(s, d), _COMMIT), _COMMIT).select(P.joined("project_path", "path").alias("path"))
    return changes.dirty_symbols(V.symbols(s, d), dirty).select("id")


# Updates: changes with the files that they reach over includes. The queries above take the listed changes alone.


def _update_scope(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(folded changes, dirty files) per commit; dirty are added and modified files and those of the
    commit's project that include, over any number of files, a header that it modifies or deletes."""
    folded = changes.fold(_changes(s, d), _COMMIT)
    headers = changes.changed_headers(folded).select(*_COMMIT, P.joined("project_path", "path").alias("seed")).distinct()
    reached = traverse.impact(V.includes(s, d), headers.select("seed"), "including", "included")
    inside = reached.join(headers, "seed").filter(P.in_project("node", "project_path"))
    impacted = inside.select(*_COMMIT, P.relative("node", "project_path").alias("path"))
    return folded, changes.dirty_files(folded, _COMMIT, impacted)


@query
def update_dirty_files(s, d):
    return _update_scope(s, d)[1]


@query
def update_purge_scope(s, d):
    folded, dirty = _update_scope(s, d)
    return changes.purge_scope(folded, _COMMIT, dirty)


@query
def update_dirty_symbols(s, d):
    dirty = _update_scope(s, d)[1].select(P.joined("project_path", "path").alias("path"))
    return changes.dirty_symbols(V.symbols(s, d), dirty).select("id")


def _update_gone(s: SparkSession, d: str) -> DataFrame:
    """(path), absolute: files that some commit purges. Which commit it is does not matter: what it reaches and deletes itself goes too, so
    reachability is asked by project, not by header and commit."""
    folded = changes.fold(_changes(s, d), _COMMIT)
    headers = changes.changed_headers(folded).select("project_path", P.joined("project_path", "path").alias("seed")).distinct()
    reached = traverse.reach(V.includes(s, d), headers, "including", "included", label="project_path").filter(P.in_project("node", "seed"))
    listed = folded.filter(F.col("change_type").isin("added", "modified", "deleted")).select(P.joined("project_path", "path").alias("path"))
    return listed.unionByName(reached.select(F.col("node").alias("path"))).distinct()


@query
def update_purge_symbols(s, d):
    kept, _, _ = store.purge_symbols(_functions(s, d).select("id"), _absolute_defines(s, d), {}, _update_gone(s, d))
    return kept


@query
def update_purge_call_edges(s, d):
    _, _, edges = store.purge_symbols(_functions(s, d).select("id"), _absolute_defines(s, d), {"calls": (_calls(s, d), ["caller_id", "callee_id"])}, _update_gone(s, d))
    return edges["calls"]


@query
def update_purge_includes(s, d):
    return store.purge_includes(V.includes(s, d), _update_gone(s, d))


# Enrichment


@query
def needs_code_summary(s, d):
    return enrich.needs_code_summary(V.function_nodes(s, d, "code_summary", "body_location")).select("id")


@query
def needs_summary(s, d):
    return enrich.needs_summary(V.function_nodes(s, d, "code_summary", "summary")).select("id")


@query
def needs_embedding(s, d):
    nodes = table(s, d, "function_nodes").select("id", "summary", F.col("summary_embedding").isNull().alias("_none")).distinct()
    bare = nodes.select("id", "summary", F.when(~F.col("_none"), F.lit(1)).alias("summary_embedding"))
    return enrich.needs_embedding({"FUNCTION": (bare, "id"), "PROJECT": (table(s, d, "project"), "path")})


def _said_in_files(s: SparkSession, d: str) -> DataFrame:
    """(project_path, file_path, summary) of the functions that files define."""
    return _defines(s, d).filter("dst_label = 'FUNCTION'").join(_summarised(s, d).select("id", "summary"), "id").select("project_path", "file_path", "summary")


@query
def file_prompts(s, d):
    return enrich.file_prompts(_said_in_files(s, d), ["project_path"])


def _children(s: SparkSession, d: str) -> DataFrame:
    """(project_path, label, name, summary, parent_path): files and folders. In place of a model's words a file's summary is the digest of all
    summaries in it, a folder's that of all files below it."""
    digest = lambda c: F.md5(F.concat_ws("; ", F.array_sort(F.collect_list(c))))
    files = _said_in_files(s, d).filter("summary is not null and summary <> ''").groupBy("project_path", "file_path").agg(digest("summary").alias("summary"))
    folders = files.select("project_path", F.explode(P.ancestors("file_path")).alias("path"), F.concat_ws(" ", "file_path", "summary").alias("x")).groupBy("project_path", "path").agg(digest("x").alias("summary"))
    one = lambda df, label, path: df.select("project_path", F.lit(label).alias("label"), P.basename(path).alias("name"), "summary", P.parent(path).alias("parent_path"))
    return one(files, "File", "file_path").unionByName(one(folders, "Folder", "path"))


@query
def folder_prompts(s, d):
    return enrich.folder_prompts(_children(s, d).filter("parent_path <> ''"), ["project_path"])


@query
def project_prompt(s, d):
    return enrich.project_prompts(_children(s, d).filter("parent_path = ''"), "project_path", P.basename("project_path"))


@query
def context_prompts(s, d):
    """Of functions that have a code summary and wait for a summary."""
    f = _summarised(s, d)
    waiting = enrich.needs_summary(f)
    return enrich.context_prompts(waiting.select("id", "code_summary"), traverse.call_context(f, _calls(s, d), waiting))


@query
def summaries_changed(s, d):
    """Code summaries taken for summaries; the embedding goes only where the text differs."""
    f = V.function_nodes(s, d, "summary", "code_summary", "summary_embedding")
    new = f.select("id", F.col("code_summary").alias("new_summary")).filter("new_summary is not null")
    return enrich.apply_summaries(f, new, ["id"]).select("id", "summary", F.col("summary_embedding").isNotNull().alias("embedded"))


@query
def cosine_topk(s, d):
    e = table(s, d, "embeddings")
    return enrich.cosine_topk(e.filter("vec_id % 100 = 0"), e, "vec_id", "embedding", 64, 5)


# Scalars on paths and texts


@query
def uri_to_path(s, d):
    uris = table(s, d, "refs").select(F.col("location.file_uri").alias("uri")).filter("uri is not null").distinct()
    return uris.select("uri", P.uri_path("uri").alias("path"), P.basename(P.uri_path("uri")).alias("name"), P.depth(P.uri_path("uri")).cast("bigint").alias("depth"))


@query
def percent_decode(s, d):
    """Escapes made from part names and decoded again; plus signs stay."""
    names = table(s, d, "part").select("p_partkey", F.concat("p_name", F.lit("+x"), "p_type").alias("name"))
    return names.select("p_partkey", P.percent_decoded(F.replace(F.col("name"), F.lit(" "), F.lit("%20"))).alias("name"))


@query
def path_joins(s, d):
    """Paths below their project, joined and made relative again."""
    full = P.joined("project_path", "path")
    return _files(s, d).select("project_path", "path", full.alias("full"), P.relative(full, "project_path").alias("again"), P.parent(full).alias("folder"), P.has_suffix("path", P.SOURCE_SUFFIXES).alias("is_source"))


@query
def quoted_labels(s, d):
    """Texts as labels of a drawing: blanks collapsed, quotes and backslashes escaped."""
    return V.documents(s, d).filter("text is not null").select("doc_id", P.dot_label(F.concat(F.lit('"'), F.regexp_replace("text", "[^\\x20-\\x7E\\n\\t]", "?"), F.lit("\\"))).alias("label"))


@query
def path_ancestors(s, d):
    return _files(s, d).select("project_path", "path", F.concat_ws(":", P.ancestors("path")).alias("folders"))


@query
def short_labels(s, d):
    return V.documents(s, d).filter("text is not null").select("doc_id", P.shortened("text").alias("label"))


@query
def line_slice(s, d):
    return V.documents(s, d).filter("text is not null").select("doc_id", enrich.source_lines("text", F.lit(1), F.lit(2)).alias("lines"))


@query
def marker_lines(s, d):
    return markers.marker_lines(V.documents(s, d), "doc_id", "text", "- ")


@query
def marker_runs(s, d):
    return markers.marker_runs(V.documents(s, d), "doc_id", "text", "- ")
