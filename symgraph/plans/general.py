"""Queries on the general problems: orphans, snapshot changes, increments, nested records."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from symgraph.functions.text import symbol_key
from symgraph.operators import increments, kept, orphans, shred, snapshots
from symgraph.schema import INDEX_SCHEMA, place_columns
from symgraph.session import shared_dir, table
from symgraph.sources.manifest import Manifest

#: Compared columns of a snapshot row.
SNAPSHOT_COLUMNS = ["name", "kind", "lang", "scope", "signature", "return_type", "type", "definition"]

# 1: references to records that do not exist


def orphan_rows(spark: SparkSession, d: str, projects: DataFrame | None = None, tables: tuple[str, ...] = ()) -> tuple[DataFrame, list[orphans.Parent]]:
    """The cascade over project <- symbols <- refs, call_relations, and the other tables named."""
    t = lambda name: table(spark, d, name)
    symbols = t("symbols").withColumn("_row", F.concat_ws("|", symbol_key("id"), F.col("loaded_at").cast("string"), F.col("removed_at").cast("string"), "project_path"))
    symbol_rows = [orphans.Parent("symbols", symbols, "id", "loaded_at", "removed_at", F.col("_row")), orphans.Parent("system_symbols", t("system_symbols"), "id", "loaded_at")]
    known = [orphans.Parent("project", t("project") if projects is None else projects, "path", exact=True)]
    children = [
        orphans.Child("symbols", symbols, F.col("_row"), "loaded_at", {"project_path": "projects"}),
        orphans.Child("refs", t("refs"), F.col("ref_id"), "loaded_at", {"symbol_id": "symbols", "container_id": "symbols"}),
        orphans.Child("call_relations", t("call_relations"), F.col("call_id"), "loaded_at", {"caller_id": "symbols", "callee_id": "symbols"}),
    ]
    others = {
        "function_nodes": lambda: orphans.Child("function_nodes", t("function_nodes"), symbol_key("id"), None, {"id": "symbols"}),
        "symbol_snapshots": lambda: orphans.Child("symbol_snapshots", t("symbol_snapshots"), F.concat_ws("|", "project_path", "snapshot_no", "doc_seq"), "taken_at", {"project_path": "projects", "id": "symbols"}),
        "update_runs": lambda: orphans.Child("update_runs", t("update_runs"), F.col("run_id"), "started_at", {"project_path": "projects"}),
        "git_changes": lambda: orphans.Child("git_changes", t("git_changes"), F.concat_ws("|", "project_path", "commit_hash"), "loaded_at", {"project_path": "projects"}),
    }
    return orphans.orphan_cascade(children + [others[x]() for x in tables], {"symbols": symbol_rows, "projects": known}), symbol_rows


OTHERS = ("function_nodes", "symbol_snapshots", "update_runs", "git_changes")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    rows, _ = orphan_rows(spark, d)
    direct = rows.filter(F.col("orphan_kind") == "direct").filter(F.col("src_table").isin("refs", "call_relations"))
    return direct.select("src_table", "ref_field", F.col("row_id").cast("bigint").alias("row_id"), F.date_format("loaded_at", "yyyy-MM").alias("month_key"))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans of all tables by month, kind and reason."""
    rows, parents = orphan_rows(spark, d, tables=OTHERS)
    return orphans.orphan_report(orphans.why_missing(rows, parents))


def p1_cascade(spark: SparkSession, d: str) -> DataFrame:
    """What the loss of a project entails: the same tables as if the project with the least path were not there, orphans by month, kind and depth."""
    projects = table(spark, d, "project")
    left = projects.filter(F.col("path") > projects.agg(F.min("path")).head()[0])
    rows, _ = orphan_rows(spark, d, left, OTHERS)
    return rows.groupBy("src_table", "ref_field", F.date_format("loaded_at", "yyyy-MM").alias("month_key"), "orphan_kind", "depth").agg(F.count("*").alias("n_refs"), F.count_distinct("ref_key").alias("n_keys"))


# 2: what changed between full snapshots


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.snapshot_changes(table(spark, d, "symbol_snapshots"), "project_path", "snapshot_no", "id", "doc_seq", SNAPSHOT_COLUMNS)


def p2_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """The changes of p2_found from snapshots that arrive one after the other: of each project its first, then its second and so on, merged with what is kept."""
    t = table(spark, d, "symbol_snapshots")
    place = F.dense_rank().over(W.partitionBy("project_path").orderBy("snapshot_no"))
    numbers = t.filter("project_path is not null and snapshot_no is not null").select("project_path", "snapshot_no").distinct().withColumn("place", place)
    last = numbers.agg(F.max("place")).head()[0] or 0
    state = kept.KeptSnapshots(spark, shared_dir(spark, "snapshots"), "project_path", "snapshot_no", "id", "doc_seq", SNAPSHOT_COLUMNS)
    found = [state.take(t.join(numbers.filter(F.col("place") == i), ["project_path", "snapshot_no"], "left_semi")) for i in range(1, last + 1)]
    none = spark.createDataFrame([], "project_path string, snapshot_no long, id string, change_kind string")
    return reduce(DataFrame.unionByName, found, none).withColumn("snapshot_no", F.col("snapshot_no").cast("int"))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.change_report(p2_found(spark, d), "project_path", "snapshot_no")


# 3: only new or changed records


def commit_manifest(spark: SparkSession, d: str) -> Manifest:
    """The manifest of git_changes, brought up to date: what arrived in each half-year is a delivery and a batch of its own.

    The state has one place for each version of the table (names, sizes and times of its
    files), so a second call finds all batches committed and reads nothing, a call after a
    failure goes on with the batch that did not commit, and a table that is replaced under its
    path starts anew.
    """
    source = f"{d}/git_changes.parquet"
    files = sorted(map(tuple, Manifest(spark, "").listing([source], ".parquet").collect()))  # names of files, not data
    state = shared_dir(spark, "commits", hashlib.sha256(repr(files).encode()).hexdigest()[:32])
    manifest, arrivals = Manifest(spark, f"{state}/ledger"), f"{state}/arrivals"
    if not manifest.exists(f"{arrivals}/_SUCCESS"):
        half = F.concat(F.year("loaded_at").cast("string"), F.when(F.month("loaded_at") <= 6, "a").otherwise("b"))
        table(spark, d, "git_changes").withColumn("arrival", F.coalesce(half, F.lit("none"))).write.mode("overwrite").partitionBy("arrival").parquet(arrivals)
    for name in manifest.folders(arrivals):
        manifest.run(name.replace("=", "-"), [f"{arrivals}/{name}"], lambda files: increments.commit_ledger(spark.read.parquet(*files)), ".parquet")
    return manifest


def _ledger(spark: SparkSession, d: str) -> DataFrame:
    got = commit_manifest(spark, d).data()
    return got if got is not None else increments.commit_ledger(table(spark, d, "git_changes").limit(0))


def p3_increments(spark: SparkSession, d: str) -> DataFrame:
    """(batch_id, n_rows, n_commits, n_pending): what each batch of git_changes wrote, and how many of its files a further run would read."""
    manifest = commit_manifest(spark, d)
    parts = [manifest.data(b).withColumn("batch_id", F.lit(b)) for b in manifest.committed()]
    if not parts:
        return spark.createDataFrame([], "batch_id string, n_rows long, n_commits long, n_pending long")
    arrivals = manifest.root.removesuffix("ledger") + "arrivals"
    batch = F.concat(F.lit("arrival-"), F.regexp_extract("path", "/arrival=([^/]*)/", 1))
    again = manifest.pending([arrivals], ".parquet").groupBy(batch.alias("batch_id")).agg(F.count("*").alias("n_pending"))
    per = reduce(DataFrame.unionByName, parts).groupBy("batch_id").agg(F.count("*").alias("n_rows"), F.count_distinct("project_path", "commit_hash").alias("n_commits"))
    return per.join(again, "batch_id", "left").select("batch_id", "n_rows", "n_commits", F.coalesce("n_pending", F.lit(0)).cast("long").alias("n_pending"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return increments.paths_by_run(_ledger(spark, d), table(spark, d, "update_runs"))


def p3_unclaimed(spark: SparkSession, d: str) -> DataFrame:
    ledger = _ledger(spark, d)
    return increments.unclaimed(ledger, increments.claims(ledger, table(spark, d, "update_runs")))


# 4: nested records to flat tables


def _shredded(spark: SparkSession, d: str, only: list[str] | None = None) -> DataFrame:
    return shred.shred(table(spark, d, "index_docs"), "body", ["doc_seq"], INDEX_SCHEMA, only)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    paths = ["ID", "References.Kind", "References.Location.FileURI"]
    refs = shred.assemble(_shredded(spark, d, paths), INDEX_SCHEMA, "References", ["doc_seq"], {}, {"ID": "id"}, {"References.Kind": "kind_level", "References.Location.FileURI": "place_level"})
    good = (F.col("kind_level") == 3) & (F.col("place_level") >= 3) & F.col("id").isNotNull() & (symbol_key("id") != "")
    return refs.filter(good).select("doc_seq", F.col("pos_1").alias("ref_pos"), symbol_key("id").alias("symbol_id"))


def p4_references(spark: SparkSession, d: str) -> DataFrame:
    """Every element of References with its document, position and symbol; bad elements keep their position."""
    columns = {"References.Kind": "kind", "References.Container.ID": "container_id"} | place_columns("References.Location", "location")
    refs = shred.assemble(_shredded(spark, d, ["ID", *columns]), INDEX_SCHEMA, "References", ["doc_seq"], columns, {"ID": "id"})
    return refs.select("doc_seq", F.col("pos_1").alias("ref_pos"), symbol_key("id").alias("symbol_id"), *columns.values())


def p4_headers(spark: SparkSession, d: str) -> DataFrame:
    columns = {"IncludeHeaders.Header": "header", "IncludeHeaders.References": "n_refs"}
    rows = shred.assemble(_shredded(spark, d, ["ID", *columns]), INDEX_SCHEMA, "IncludeHeaders", ["doc_seq"], columns, {"ID": "id"})
    return rows.select("doc_seq", F.col("pos_1").alias("header_pos"), symbol_key("id").alias("symbol_id"), *columns.values())


def p4_symbols(spark: SparkSession, d: str) -> DataFrame:
    """One row per document that has an ID and a SymInfo group."""
    columns = {"ID": "id", "Name": "name", "Scope": "scope", "SymInfo.Kind": "kind", "SymInfo.Lang": "lang", "Flags": "flags", "Signature": "signature", "ReturnType": "return_type", "Type": "type", "Documentation": "documentation"} | place_columns("CanonicalDeclaration", "declaration") | place_columns("Definition", "definition")
    rows = shred.assemble(_shredded(spark, d, list(columns)), INDEX_SCHEMA, "", ["doc_seq"], columns, {}, {"SymInfo.Kind": "info_level"})
    return rows.filter("info_level >= 1 and id is not null").withColumn("id", symbol_key("id")).withColumnRenamed("id", "symbol_id").drop("info_level")



QUERIES = {f.__name__: f for f in (p1_found, p1_report, p1_cascade, p2_found, p2_report, p2_deliveries, p3_found, p3_unclaimed, p3_increments, p4_found, p4_references, p4_headers, p4_symbols)}

_KEY = "upper(trim({}, ' \t'))"
_LIVE = f"lives as materialized (select {_KEY.format('id')} as k, loaded_at as f, removed_at as u from symbols union all select {_KEY.format('id')}, loaded_at, null from system_symbols)"


def _first(name: str, row: str, fields: list[str]) -> str:
    parts = " union all ".join(f"select '{name}' as src_table, '{f}' as ref_field, {row} as row_id, {_KEY.format(f)} as k, loaded_at as t from first_{name}" for f in fields)
    return f"first_{name} as (select * from (select *, row_number() over (partition by {row} order by loaded_at) as _r from {name}) where _r = 1), vals_{name} as ({parts})"


_ORPHANS = f"""{_LIVE}, {_first('refs', 'ref_id', ['symbol_id', 'container_id'])}, {_first('call_relations', 'call_id', ['caller_id', 'callee_id'])},
vals as (select * from vals_refs union all select * from vals_call_relations),
good as (select * from vals where k is not null and k <> '' and not regexp_matches(k, '^0+$')),
alive as (select distinct g.src_table, g.ref_field, g.row_id from good g join lives l on g.k = l.k and l.f <= g.t and (l.u is null or g.t < l.u)),
orphans as (select g.* from good g left join alive a on a.src_table = g.src_table and a.ref_field = g.ref_field and a.row_id = g.row_id where a.row_id is null)"""

_PLAIN = "trim({}, ' \t')"
_NAMED = "{0} is not null and {0} <> '' and not regexp_matches({0}, '^0+$')"


def _all_orphans(projects: str) -> str:
    """Orphans (src_table, ref_field, k, t, orphan_kind, depth) of all tables, given the paths of the projects that are there."""
    gone = f"{_NAMED.format(_PLAIN.format('project_path'))} and {_PLAIN.format('project_path')} not in (select p from prj)"
    by_project = " union all ".join([
        f"select 'symbols' as src_table, {_PLAIN.format('project_path')} as k, loaded_at as t from (select distinct {_KEY.format('id')} as id, loaded_at, removed_at, project_path from symbols)",
        f"select 'symbol_snapshots', {_PLAIN.format('project_path')}, taken_at from first_snaps",
        f"select 'update_runs', {_PLAIN.format('project_path')}, started_at from (select *, row_number() over (partition by run_id order by started_at nulls last, project_path nulls first) as _r from update_runs where run_id is not null) where _r = 1",
        f"select 'git_changes', {_PLAIN.format('project_path')}, loaded_at from (select *, row_number() over (partition by project_path, commit_hash order by loaded_at nulls last) as _r from git_changes) where _r = 1",
    ])
    return f"""prj as (select {_PLAIN.format('path')} as p from {projects}),
mlives as materialized (select {_KEY.format('id')} as k, loaded_at as f, removed_at as u, coalesce({gone}, false) as sick from symbols where loaded_at is not null union all select {_KEY.format('id')}, loaded_at, null, false from system_symbols),
{_first('refs', 'ref_id', ['symbol_id', 'container_id'])}, {_first('call_relations', 'call_id', ['caller_id', 'callee_id'])},
first_snaps as (select * from (select *, row_number() over (partition by project_path, snapshot_no, doc_seq order by taken_at nulls last, {_KEY.format('id')} nulls first) as _r from symbol_snapshots) where _r = 1),
mvals as (select * from (select src_table, ref_field, k, t, false as any_time from vals_refs union all select src_table, ref_field, k, t, false from vals_call_relations
 union all select 'symbol_snapshots', 'id', {_KEY.format('id')}, taken_at, false from first_snaps union all select distinct 'function_nodes', 'id', {_KEY.format('id')}, null::timestamp, true from function_nodes) v where {_NAMED.format('k')}),
mnum as (select *, row_number() over () as n from mvals),
mseen as (select m.n, bool_and(l.sick) as all_sick from mnum m join mlives l on l.k = m.k and (m.any_time or (l.f <= m.t and (l.u is null or m.t < l.u))) group by m.n),
pvals as ({by_project}),
every as (select src_table, 'project_path' as ref_field, k, t, 'direct' as orphan_kind, 0 as depth from pvals where {_NAMED.format('k')} and k not in (select p from prj)
 union all select m.src_table, m.ref_field, m.k, m.t, case when s.n is null then 'direct' else 'inherited' end, case when s.n is null then 0 else 1 end from mnum m left join mseen s on s.n = m.n where s.n is null or s.all_sick)"""


_CONTENT = ", ".join([f"coalesce(trim({c}, ' \t'), '') as {c}" for c in SNAPSHOT_COLUMNS[:-1]] + ["coalesce(trim(definition.file_uri, ' \t'), '') as d0"] + [f"definition.{c} as {c}" for c in ("start_line", "start_column", "end_line", "end_column")])
_COMPARED = [*SNAPSHOT_COLUMNS[:-1], "d0", "start_line", "start_column", "end_line", "end_column"]
_CHANGES = f"""snaps as (select project_path, snapshot_no, {_KEY.format('id')} as id, {_CONTENT}, row_number() over (partition by project_path, snapshot_no, {_KEY.format('id')} order by doc_seq desc) as _r from symbol_snapshots),
one as (select * from snaps where _r = 1),
nos as (select project_path, snapshot_no, lag(snapshot_no) over (partition by project_path order by snapshot_no) as before from (select distinct project_path, snapshot_no from symbol_snapshots)),
cur as (select o.*, n.before from one o join nos n on o.project_path = n.project_path and o.snapshot_no = n.snapshot_no where n.before is not null),
old as (select o.*, n.snapshot_no as later from one o join nos n on o.project_path = n.project_path and o.snapshot_no = n.before),
changes as (
select c.project_path, c.snapshot_no, c.id, case when o.id is null then 'added' else 'changed' end as change_kind from cur c left join old o on o.project_path = c.project_path and o.later = c.snapshot_no and o.id = c.id
where o.id is null or {' or '.join(f'c.{x} is distinct from o.{x}' for x in _COMPARED)}
union all
select o.project_path, o.later, o.id, 'removed' from old o left join cur c on o.project_path = c.project_path and o.later = c.snapshot_no and o.id = c.id where c.id is null)"""

_CLAIMS = """ok as (select distinct run_id, project_path, started_at from update_runs where lower(trim(status, ' \t')) = 'ok' and finished_at is not null),
firsts as (select project_path, commit_hash, min(loaded_at) as t from git_changes group by 1, 2),
ranked as (select f.project_path, f.commit_hash, o.run_id, row_number() over (partition by f.project_path, f.commit_hash order by o.started_at, o.run_id) as _r from firsts f join ok o on o.project_path = f.project_path and o.started_at >= f.t),
claims as (select * from ranked where _r = 1)"""

_DOCS = """docs as (select doc_seq, body from index_docs where body is not null and json_valid(body)),
objects as (select doc_seq, upper(trim(json_extract_string(body, '$.ID'), ' \t')) as symbol_id, body from docs where json_type(body) = 'OBJECT')"""
_ELEMENTS = _DOCS + """, lists as (select doc_seq, symbol_id, body, json_type(body, '$.{field}') as rt from objects where symbol_id is not null),
elements as (select doc_seq, symbol_id, i as pos, json_extract(body, '$.{field}[' || i || ']') as e from (select doc_seq, symbol_id, body, unnest(range(cast(json_array_length(body, '$.{field}') as bigint))) as i from lists where rt = 'ARRAY') x
 union all select doc_seq, symbol_id, 0, json_extract(body, '$.{field}') from lists where rt = 'OBJECT')"""


def _place_sql(of: str, at: str, name: str) -> str:
    return ", ".join(f"json_extract_string({of}, '$.{at}.{p}') as {name}_{n}" for p, n in [("FileURI", "file_uri"), ("Start.Line", "start_line"), ("Start.Column", "start_column"), ("End.Line", "end_line"), ("End.Column", "end_column")])


ORACLE = {
    "p1_found": f"with {_ORPHANS} select src_table, ref_field, row_id, strftime(t, '%Y-%m') as month_key from orphans",
    "p1_report": f"""with {_all_orphans('project')}, firsts as (select k, min(f) as first_at from mlives group by k)
        select src_table, ref_field, strftime(t, '%Y-%m') as month_key, orphan_kind, case when orphan_kind = 'inherited' then 'parent_orphan' when f.k is null then 'never' when first_at > t or t is null then 'not_yet' else 'removed' end as reason, count(*) as n_refs, count(distinct o.k) as n_keys
        from every o left join firsts f on o.k = f.k group by 1, 2, 3, 4, 5""",
    "p1_cascade": f"""with {_all_orphans('(select path from project where path > (select min(path) from project))')}
        select src_table, ref_field, strftime(t, '%Y-%m') as month_key, orphan_kind, depth, count(*) as n_refs, count(distinct k) as n_keys from every group by 1, 2, 3, 4, 5""",
    "p2_found": f"with {_CHANGES} select * from changes",
    "p2_deliveries": f"with {_CHANGES} select * from changes",
    "p2_report": f"with {_CHANGES} select project_path, snapshot_no, change_kind, count(*) as n_keys from changes group by 1, 2, 3",
    "p3_found": f"""with {_CLAIMS}, paths as (select project_path, commit_hash, unnest(added) as path from git_changes union select project_path, commit_hash, unnest(modified) from git_changes)
        select distinct c.run_id, p.path from claims c join paths p on p.project_path = c.project_path and p.commit_hash = c.commit_hash where p.path is not null and p.path <> ''""",
    "p3_increments": """with ok as (select *, row_number() over () as r from git_changes where project_path is not null and commit_hash is not null and loaded_at is not null),
        paths as (select r, count(*) as n from (select r, unnest(added) as path from ok union select r, unnest(modified) from ok) p where path is not null and path <> '' group by r)
        select 'arrival-' || year(loaded_at) || case when month(loaded_at) <= 6 then 'a' else 'b' end as batch_id, sum(coalesce(n, 1))::bigint as n_rows, count(distinct (project_path, commit_hash)) as n_commits, 0::bigint as n_pending from ok left join paths on ok.r = paths.r group by 1""",
    "p3_unclaimed": f"with {_CLAIMS} select f.project_path, f.commit_hash from firsts f left join claims c on c.project_path = f.project_path and c.commit_hash = f.commit_hash where c.run_id is null",
    "p4_found": f"""with {_ELEMENTS.format(field='References')}
        select doc_seq, pos as ref_pos, symbol_id from elements where json_type(e) = 'OBJECT' and json_type(e, '$.Location') = 'OBJECT' and json_type(e, '$.Kind') is not null and json_type(e, '$.Kind') <> 'NULL'""",
    "p4_references": f"""with {_ELEMENTS.format(field='References')}
        select doc_seq, pos as ref_pos, symbol_id, json_extract_string(e, '$.Kind') as kind, json_extract_string(e, '$.Container.ID') as container_id, {_place_sql('e', 'Location', 'location')} from elements""",
    "p4_headers": f"""with {_ELEMENTS.format(field='IncludeHeaders')}
        select doc_seq, pos as header_pos, symbol_id, json_extract_string(e, '$.Header') as header, json_extract_string(e, '$.References') as n_refs from elements""",
    "p4_symbols": f"""with {_DOCS}
        select doc_seq, {_KEY.format("json_extract_string(body, '$.ID')")} as symbol_id, {', '.join(f"json_extract_string(body, '$.{p}') as {n}" for p, n in [('Name', 'name'), ('Scope', 'scope'), ('SymInfo.Kind', 'kind'), ('SymInfo.Lang', 'lang'), ('Flags', 'flags'), ('Signature', 'signature'), ('ReturnType', 'return_type'), ('Type', 'type'), ('Documentation', 'documentation')])},
        {_place_sql('body', 'CanonicalDeclaration', 'declaration')}, {_place_sql('body', 'Definition', 'definition')} from objects where symbol_id is not null and json_type(body, '$.SymInfo') = 'OBJECT'""",
}
