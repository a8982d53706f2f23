"""SQL twins of the graph queries."""

from __future__ import annotations

_T = "trim({}, ' \t')"
_KEY = "upper(trim({}, ' \t'))"
_TEXT = ["name", "kind", "lang", "scope", "signature", "return_type"]
_NUL = "chr(0)"


def _path(uri: str) -> str:
    """The decoded path of a file URI; the tables' URIs hold no query or host."""
    return f"case when starts_with({uri}, 'file://') then url_decode(replace(substr({uri}, 8), '+', '%2B')) else {uri} end"


def _parent(p: str) -> str:
    return f"case when instr({p}, '/') > 0 then regexp_replace({p}, '/[^/]*$', '') else '' end"


def _base(p: str) -> str:
    return f"regexp_extract({p}, '[^/]*$')"


def _symbols(where: str, name: str) -> str:
    """One row per symbol id of the rows that meet a condition: the latest load wins."""
    return f"""{name} as (select id, project_path, {', '.join(_TEXT)}, canonical_declaration, definition, loaded_at, removed_at from (
 select *, row_number() over (partition by id order by loaded_at desc, coalesce(removed_at, timestamp '9999-01-01') desc, {', '.join(f'{c} desc' for c in _TEXT)}) as _r from (
  select {_KEY.format('id')} as id, project_path, {', '.join(f"coalesce({_T.format(c)}, '') as {c}" for c in _TEXT)}, canonical_declaration, definition, loaded_at, removed_at from symbols where {where}) n) r where _r = 1)"""


SYM = _symbols("true", "sym")
ROWS = f"""placed as (select *, case when definition is not null then definition.file_uri else canonical_declaration.file_uri end as uri, case when definition is not null then definition.start_line else canonical_declaration.start_line end as l,
 case when definition is not null then definition.start_column else canonical_declaration.start_column end as c, definition is null and canonical_declaration is null as nowhere from sym where id <> '' and kind <> ''),
rws as (select project_path, id, name, kind, scope, lang as language, definition is not null as has_definition, case when not nowhere then substr({_path('uri')}, length(project_path) + 2) end as path,
 case when not nowhere then [l, c] end as name_location, signature, return_type, case when definition is not null and starts_with({_path('definition.file_uri')}, project_path || '/') then substr({_path('definition.file_uri')}, length(project_path) + 2) end as file_path
 from placed where nowhere or starts_with({_path('uri')}, project_path || '/'))"""
FILES = f"""uris as (select project_path, definition.file_uri as uri from sym union all select project_path, canonical_declaration.file_uri from sym),
fls as (select project_path, path, {_base('path')} as name, case when {_parent('path')} = '' then project_path else {_parent('path')} end as parent_path from (
 select distinct project_path, substr({_path('uri')}, length(project_path) + 2) as path from uris where uri is not null and starts_with({_path('uri')}, project_path || '/')) u)"""
FOLDERS = f"""parts as (select distinct project_path, string_split(path, '/') as p from fls),
fld as (select project_path, path, {_base('path')} as name, case when {_parent('path')} = '' then project_path else {_parent('path')} end as parent_path from (
 select distinct project_path, array_to_string(p[1:i], '/') as path from (select project_path, p, unnest(range(1, len(p))) as i from parts) e) u)"""
CONTAINS = """con as (select project_path, case when parent_path = project_path then 'PROJECT' else 'FOLDER' end as src_label, parent_path as src, 'FOLDER' as dst_label, path as dst from fld
 union all select project_path, case when parent_path = project_path then 'PROJECT' else 'FOLDER' end, parent_path, 'FILE', path from fls)"""
DEFINES = """def as (select distinct r.project_path, r.file_path, case when r.kind = 'Function' then 'FUNCTION' else 'DATA_STRUCTURE' end as dst_label, r.id from rws r
 join fls f on f.project_path = r.project_path and f.path = r.file_path where r.kind in ('Function', 'Struct', 'Class', 'Union', 'Enum'))"""
REFS = f"""rf as (select * from (select ref_id, {_KEY.format('symbol_id')} as symbol_id, coalesce({_KEY.format('container_id')}, '') as container_id, kind, location, row_number() over (partition by ref_id order by loaded_at, {_KEY.format('symbol_id')}, coalesce({_KEY.format('container_id')}, '')) as _r from refs) x where _r = 1)"""
SITES = f"""{REFS}, fn as (select id, name from sym where kind = 'Function'),
st as (select r.ref_id, r.container_id as caller_id, a.name as caller_name, r.symbol_id as callee_id, b.name as callee_name from rf r join fn b on b.id = r.symbol_id join fn a on a.id = r.container_id where r.kind in (20, 28) and not regexp_matches(r.container_id, '^0*$')),
cl as (select distinct caller_id, callee_id from st)"""
FNODES = "fnode as (select distinct * from function_nodes)"
CSITES = f"""cs as (select call_id as site_id, {_path('call_location.file_uri')} as file, call_location.start_line as line, call_location.start_column as col from (select *, row_number() over (partition by call_id order by loaded_at) as _r from call_relations) x where _r = 1 and call_location is not null),
bd as (select {_KEY.format('f.id')} as id, {_path('s.definition.file_uri')} as file, f.body_location[1] as l1, f.body_location[2] as c1, f.body_location[3] as l2, f.body_location[4] as c2 from fnode f join sym s on s.id = {_KEY.format('f.id')} where s.definition is not null and len(f.body_location) = 4),
mt as (select c.site_id, b.id, b.l1 from cs c join bd b on b.file = c.file and (c.line > b.l1 or (c.line = b.l1 and c.col >= b.c1)) and (c.line < b.l2 or (c.line = b.l2 and c.col <= b.c2)))"""
INC = f"""idoc as (select json_extract_string(body, '$.Definition.FileURI') as file, body, json_type(body, '$.IncludeHeaders') as rt from (select body from index_docs where body is not null and json_valid(body)) v where json_type(body) = 'OBJECT'),
ihdr as (select file, json_extract_string(body, '$.IncludeHeaders[' || i || '].Header') as header from (select file, body, unnest(range(cast(json_array_length(body, '$.IncludeHeaders') as bigint))) as i from idoc where rt = 'ARRAY') x
 union all select file, json_extract_string(body, '$.IncludeHeaders.Header') from idoc where rt = 'OBJECT'),
inc as (select distinct {_path('file')} as including, {_path('header')} as included from ihdr where file is not null and header is not null),
seeds as (select distinct included as seed from inc where included like '%.h')"""
REACH = f"{INC}, reach as (select s.seed, i.including as node from seeds s join inc i on i.included = s.seed union select r.seed, i.including from reach r join inc i on i.included = r.node)"
SEEDS = f"{FNODES}, sd as (select id from fnode where coalesce(code_summary, '') = '' and body_location is not null)"
_ITEM = "select project_path, commit_hash, '{0}' as change_type, unnest({0}) as path, null as original from git_changes"
_PAIR = "select project_path, commit_hash, '{0}' as change_type, e.\"new\" as path, e.original as original from (select project_path, commit_hash, unnest({0}) as e from git_changes) x"
_SRC = "regexp_matches({}, '\\.(c|h|cpp|cc|cxx)$')"
LISTED = f"""lst as (select distinct * from ({' union all '.join([_ITEM.format(x) for x in ('added', 'modified', 'deleted')] + [_PAIR.format(x) for x in ('renamed_exact', 'copied_exact')])}) u
 where path is not null and path <> '' and (change_type not in ('renamed_exact', 'copied_exact') or (original is not null and original <> '')))"""
FOLD = f"""{LISTED}, prs as (select * from lst where change_type in ('renamed_exact', 'copied_exact') and ({_SRC.format('path')} or {_SRC.format('original')})),
expl as (select project_path, commit_hash, path from prs where change_type = 'renamed_exact' union select project_path, commit_hash, original from prs where change_type = 'renamed_exact'),
sng as (select l.project_path, l.commit_hash, l.change_type, l.path from lst l left join expl e on e.project_path = l.project_path and e.commit_hash = l.commit_hash and e.path = l.path where l.change_type in ('added', 'modified', 'deleted') and {_SRC.format('l.path')} and e.path is null),
fold as (select * from sng union select project_path, commit_hash, 'added', path from prs union select project_path, commit_hash, 'deleted', original from prs where change_type = 'renamed_exact'),
del as (select distinct project_path, commit_hash, path from fold where change_type = 'deleted'),
dirty as (select distinct f.project_path, f.commit_hash, f.path from fold f left join del d on d.project_path = f.project_path and d.commit_hash = f.commit_hash and d.path = f.path where f.change_type in ('added', 'modified') and d.path is null)"""
UPDATE = f"""{FOLD}, {REACH}, hdr as (select distinct project_path, commit_hash, project_path || '/' || path as seed from fold where change_type in ('modified', 'deleted') and path like '%.h'),
imp as (select h.project_path, h.commit_hash, substr(r.node, length(h.project_path) + 2) as path from hdr h join reach r on r.seed = h.seed and starts_with(r.node, h.project_path || '/')),
udirty as (select * from dirty union (select * from imp except select * from del)),
uscope as (select * from udirty union select * from del)"""
UPDATE_GONE = f"{UPDATE}, ugonef as (select distinct project_path || '/' || path as path from uscope), ugone as (select d.id from def d where d.project_path || '/' || d.file_path in (select path from ugonef))"
SEEN = "cseeds as (select distinct project_path || '/' || path as seed from fold where change_type in ('modified', 'deleted') and path like '%.h')"
CHANGED_REACH = f"{FOLD}, {INC}, {SEEN}, reach as (select s.seed, i.including as node from cseeds s join inc i on i.included = s.seed union select r.seed, i.including from reach r join inc i on i.included = r.node)"
# the neighbours' code summaries, as the enrichment of a function collects them
CONTEXT = f"""fsum as (select distinct {_KEY.format('id')} as id, code_summary, summary from function_nodes),
around as (select c.callee_id as id, 'caller' as side, s.code_summary as said from cl c join fsum s on s.id = c.caller_id union select c.caller_id, 'callee', s.code_summary from cl c join fsum s on s.id = c.callee_id),
heard as (select id, string_agg(said, ' | ' order by said) filter (side = 'caller') as callers, string_agg(said, ' | ' order by said) filter (side = 'callee') as callees,
 string_agg(said, ', ' order by said) filter (side = 'caller') as caller_list, string_agg(said, ', ' order by said) filter (side = 'callee') as callee_list from around where coalesce(said, '') <> '' group by id)"""
GONE_FILES = f"{FOLD}, gonef as (select distinct project_path || '/' || path as path from del)"
GONE = f"{GONE_FILES}, gone as (select d.id from def d where d.project_path || '/' || d.file_path in (select path from gonef))"
SAID = f"""fsum as (select distinct {_KEY.format('id')} as id, summary from function_nodes), said as (select d.project_path, d.file_path, s.summary from def d join fsum s on s.id = d.id where d.dst_label = 'FUNCTION' and coalesce(s.summary, '') <> '')"""
CHILD = f"""{SAID}, sfiles as (select project_path, file_path as path, md5(string_agg(summary, '; ' order by summary)) as summary from said group by 1, 2),
sbelow as (select project_path, path, summary, string_split(path, '/') as p, unnest(range(1, len(string_split(path, '/')))) as i from sfiles),
sfolders as (select project_path, array_to_string(p[1:i], '/') as path, md5(string_agg(path || ' ' || summary, '; ' order by path || ' ' || summary)) as summary from sbelow group by project_path, array_to_string(p[1:i], '/')),
chd as (select project_path, 'File' as label, {_base('path')} as name, summary, {_parent('path')} as parent_path from sfiles union all select project_path, 'Folder', {_base('path')}, summary, {_parent('path')} from sfolders)"""
LINES = "ln as (select doc_id, i - 1 as line_no, p[i] as line from (select doc_id, p, unnest(range(1, len(p) + 1)) as i from (select doc_id, string_split(text, chr(10)) as p from documents where text is not null) a) b)"
_BASE, _GRAPH = f"with {SYM}, {ROWS}", f"with {SYM}, {ROWS}, {FILES}, {DEFINES}"

ORACLE = {
    "feature_flags": f"with {REFS} select bool_or(container_id <> '') as has_container, bool_or(container_id <> '') or bool_or(kind >= 16) as has_call_kind from rf",
    "last_wins_symbols": f"with {SYM} select id, project_path, name, kind, loaded_at from sym",
    "symbol_rows": f"{_BASE} select project_path, id, name, kind, scope, language, has_definition, path, signature, return_type, file_path, name_location[1] as name_line, name_location[2] as name_column from rws",
    "kind_routing": f"{_BASE} select case when kind = 'Function' then 'FUNCTION' when kind in ('Struct', 'Class', 'Union', 'Enum') then 'DATA_STRUCTURE' else 'none' end as label, count(*) as n, count(file_path) as n_defined from rws group by 1",
    "kind_histogram": f"with {SYM} select kind, count(*) as n from sym group by kind",
    "file_nodes": f"with {SYM}, {FILES} select * from fls",
    "folder_nodes": f"with {SYM}, {FILES}, {FOLDERS} select * from fld",
    "contains_edges": f"with {SYM}, {FILES}, {FOLDERS}, {CONTAINS} select * from con",
    "defines_edges": f"{_GRAPH} select * from def",
    "definitions_by_file": f"{_GRAPH} select project_path, count(distinct file_path) as n_files, count(*) as n_defined, round(count(*) / count(distinct file_path), 6) as mean_defined from def group by 1",
    "header_language": f"with {SYM}, {FILES} select project_path, {_parent('path')} as folder, count(*) filter (path like '%.h') as n_headers, case when bool_or(regexp_matches(path, '\\.(cpp|cc|cxx)$')) then 'C++' when bool_or(path like '%.c') then 'C' else 'unknown' end as language from fls group by 1, 2 having count(*) filter (path like '%.h') > 0",
    "schema_triples": f"{_GRAPH}, {FOLDERS}, {CONTAINS}, {SITES} select src_label, 'CONTAINS' as edge, dst_label, count(*) as n from con group by 1, 3 union all select 'FILE', 'DEFINES', dst_label, count(*) from def group by dst_label union all select 'FUNCTION', 'CALLS', 'FUNCTION', count(*) from cl",
    "folder_drawing": f"with {SYM}, {FILES}, {FOLDERS} select '  \"' || path || '\" [label=\"' || case when length(name) > 35 then left(name, 15) || ' ... ' || right(name, 15) else name end || '\"];' as line from fld union all select '  \"' || parent_path || '\" -> \"' || path || '\";' from fld",
    "span_listing": f"with {FNODES}, sp as (select distinct file_path as file, name, name_location[1] as l, name_location[2] as c, body_location as b from fnode where body_location is not null) select file, count(*) as n, string_agg(name || ' ' || b[1] || '-' || b[3], '; ' order by l, c, name, b[1], b[3]) as functions from sp group by file",
    "call_sites": f"with {SYM}, {SITES} select * from st",
    "call_edges": f"with {SYM}, {SITES} select * from cl",
    "call_edges_stored": f"{_BASE}, {SITES} select * from cl where caller_id in (select id from rws where kind = 'Function') and callee_id in (select id from rws where kind = 'Function')",
    "call_stats": f"""with {SYM}, {SITES}, {FNODES}, a as (select distinct caller_name as name from st), b as (select distinct callee_name as name from st), bodied as (select distinct upper(trim(id, ' \t')) as id from fnode where body_location is not null)
        select (select count(*) from fn) as n_functions, (select count(*) from fn where id in (select id from bodied)) as n_with_body, count(*) as n_calls, count(*) filter (caller_id = callee_id) as n_recursive_calls, count(distinct case when caller_id = callee_id then caller_id end) as n_recursive, (select count(*) from a) as n_callers, (select count(*) from b) as n_callees,
        (select count(*) from a join b on a.name = b.name) as n_both, (select count(*) from a left join b on a.name = b.name where b.name is null) as n_entry, (select count(*) from b left join a on a.name = b.name where a.name is null) as n_leaf, (select count(*) from (select name from a union select name from b) u) as n_names from st""",
    "call_fanout": f"with {SYM}, {SITES} select caller_id, count(*) as n_sites, count(distinct callee_id) as n_callees from st group by 1",
    "entry_functions": f"with {SYM}, {SITES} select distinct caller_name as name from st where caller_name not in (select callee_name from st)",
    "valid_refs": f"with {SYM}, {REFS} select kind, count(*) as n from rf where location is not null and kind is not null and symbol_id in (select id from sym) group by kind",
    "interval_all_matches": f"with {SYM}, {FNODES}, {CSITES} select site_id, id from mt",
    "interval_first_match": f"with {SYM}, {FNODES}, {CSITES} select site_id, id from (select *, row_number() over (partition by site_id order by l1, id) as _r from mt) x where _r = 1",
    "span_enrichment": f"""{_BASE}, {FNODES}, spans as (select * from (select f.name, y.project_path, f.file_path, f.name_location, f.body_location, row_number() over (partition by f.name, y.project_path, f.file_path, f.name_location order by f.id desc) as _r from fnode f join sym y on y.id = {_KEY.format('f.id')} where f.body_location is not null) x where _r = 1)
        select r.id, s.body_location[1] as first_line, s.body_location[3] as last_line from rws r left join spans s on s.name = r.name and s.project_path = r.project_path and s.file_path = r.file_path and s.name_location[1] = r.name_location[1] and s.name_location[2] = r.name_location[2] where r.kind = 'Function' and r.file_path is not null""",
    "includes_edges": f"with {SYM}, {FILES}, {INC}, nd as (select project_path || '/' || path as path from fls) select distinct including, included from inc where including in (select path from nd) and included in (select path from nd)",
    "include_groups": f"with {INC} select including, count(distinct included) as n, string_agg(distinct included, ',' order by included) as included from inc group by including",
    "reverse_includes": f"with {INC} select included, count(distinct including) as n_including from inc group by 1",
    "impact_transitive": f"with recursive {CHANGED_REACH} select seed, node from reach",
    "impact_no_seed": f"with recursive {CHANGED_REACH} select seed, node from reach where seed <> node",
    "impact_sources": f"with recursive {CHANGED_REACH} select s.seed, coalesce(string_agg(r.node, ',' order by r.node), '') as sources from cseeds s left join (select * from reach where seed <> node and regexp_matches(node, '\\.(c|cpp|cc|cxx)$')) r on r.seed = s.seed group by s.seed",
    "impact_all_headers": f"with recursive {REACH} select seed, count(*) as n_files from reach group by seed",
    "neighbours_one_hop": f"{_BASE}, {SITES}, {SEEDS} select id from sd union select callee_id from cl where caller_id in (select id from sd) union select caller_id from cl where callee_id in (select id from sd)",
    "call_context": f"with {SYM}, {SITES}, {CONTEXT} select f.id, coalesce(h.callers, '') as callers, coalesce(h.callees, '') as callees from (select distinct id from fsum) f left join heard h on h.id = f.id",
    "subset_one_hop": f"{_BASE}, {REFS}, {SEEDS} select id from sd union select container_id from rf where symbol_id in (select id from sd) and container_id <> '' union select symbol_id from rf where container_id in (select id from sd) and symbol_id <> ''",
    "files_of_symbols": f"{_GRAPH}, {SEEDS} select distinct project_path, file_path from def where id in (select id from sd)",
    "node_degrees": f"with {SYM}, {SITES} select node, count(*) as degree from (select caller_id as node from cl union all select callee_id from cl) u group by 1",
    "disconnected_functions": f"{_GRAPH}, {SITES} select id from rws where kind = 'Function' and id not in (select caller_id from cl) and id not in (select callee_id from cl) and id not in (select id from def)",
    "overlay_upsert": f"""with {_symbols("removed_at is not null", "o")}, {_symbols("removed_at is null", "n0")}, n as (select id, name, nullif(kind, '') as kind, nullif(signature, '') as signature from n0)
        select coalesce(n.id, o.id) as id, coalesce(n.name, o.name) as name, coalesce(n.kind, o.kind) as kind, coalesce(n.signature, o.signature) as signature, case when n.id is null then o.return_type end as return_type from o full outer join n on o.id = n.id""",
    "write_counts": f"with {_symbols('removed_at is not null', 'o')}, {_symbols('removed_at is null', 'n')} select count(*) filter (o.id is null) as n_created, count(o.id) as n_matched from n left join o on o.id = n.id",
    "purge_symbols": f"{_GRAPH}, {GONE} select id from rws where kind = 'Function' and id not in (select id from gone)",
    "purge_call_edges": f"{_GRAPH}, {GONE}, {SITES} select * from cl where caller_id not in (select id from gone) and callee_id not in (select id from gone)",
    "purge_includes": f"with {GONE_FILES}, {INC} select including, included from inc where including not in (select path from gonef)",
    "prune_folders": f"with {SYM}, {FILES}, {FOLDERS}, {GONE_FILES}, lft as (select path from (select project_path || '/' || path as path from fls) f where path not in (select path from gonef)) select distinct path from (select project_path || '/' || path as path from fld) f where exists (select 1 from lft l where starts_with(l.path, f.path || '/'))",
    "property_counts": f"with {FNODES} select 'FUNCTION' as label, count(summary) as n from fnode union all select 'PROJECT', count(summary) from project union all select 'FILE', 0",
    "duplicate_keys": "select id, count(*) as n from function_nodes group by id having count(*) > 1",
    "listed_changes": f"with {LISTED} select * from lst",
    "raw_diff_classes": f"with {LISTED} select change_type, count(*) as n from (select distinct commit_hash, change_type, path from lst) x group by 1",
    "rename_fold": f"with {FOLD} select * from fold",
    "changed_headers": f"with {FOLD} select distinct project_path, commit_hash, path from fold where change_type in ('modified', 'deleted') and path like '%.h'",
    "dirty_files": f"with {FOLD} select * from dirty",
    "purge_scope": f"with {FOLD} select project_path, commit_hash, path from dirty union select * from del",
    "dirty_symbols": f"with {SYM}, {FOLD} select id from sym where {_path('definition.file_uri')} in (select project_path || '/' || path from dirty)",
    "update_dirty_files": f"with recursive {UPDATE} select * from udirty",
    "update_purge_scope": f"with recursive {UPDATE} select * from uscope",
    "update_dirty_symbols": f"with recursive {SYM}, {UPDATE} select id from sym where {_path('definition.file_uri')} in (select project_path || '/' || path from udirty)",
    "update_purge_symbols": f"with recursive {_GRAPH[5:]}, {UPDATE_GONE} select id from rws where kind = 'Function' and id not in (select id from ugone)",
    "update_purge_call_edges": f"with recursive {_GRAPH[5:]}, {UPDATE_GONE}, {SITES} select * from cl where caller_id not in (select id from ugone) and callee_id not in (select id from ugone)",
    "update_purge_includes": f"with recursive {UPDATE} select including, included from inc where including not in (select project_path || '/' || path from uscope)",
    "needs_code_summary": f"with {FNODES} select id from fnode where coalesce(code_summary, '') = '' and body_location is not null",
    "needs_summary": f"with {FNODES} select id from fnode where coalesce(code_summary, '') <> '' and coalesce(summary, '') = ''",
    "needs_embedding": f"with {FNODES} select 'FUNCTION' as label, id as key, summary from fnode where coalesce(summary, '') <> '' and summary_embedding is null union all select 'PROJECT', path, summary from project where coalesce(summary, '') <> '' and summary_embedding is null",
    "file_prompts": f"{_GRAPH}, {SAID} select project_path, file_path, 'The file ' || {_base('file_path')} || ' holds functions that do this: ' || string_agg(summary, '; ' order by summary) || chr(10) || 'Say what the file is for.' as prompt from said group by project_path, file_path",
    "folder_prompts": f"{_GRAPH}, {CHILD} select project_path, parent_path, 'The folder ' || {_base('parent_path')} || ' holds: ' || string_agg(label || ' ' || name || ': ' || summary, '; ' order by label || ' ' || name || ': ' || summary) || chr(10) || 'Say what the folder is for.' as prompt from chd where parent_path <> '' group by project_path, parent_path",
    "project_prompt": f"{_GRAPH}, {CHILD} select project_path, 'The project ' || {_base('project_path')} || ' holds: ' || string_agg(label || ' ' || name || ': ' || summary, '; ' order by label || ' ' || name || ': ' || summary) || chr(10) || 'Say what the project is for.' as prompt from chd where parent_path = '' group by project_path",
    "context_prompts": f"with {SYM}, {SITES}, {CONTEXT} select f.id, 'The function does this: ' || f.code_summary || chr(10) || 'It is called by: ' || coalesce(h.caller_list, 'none') || chr(10) || 'It calls: ' || coalesce(h.callee_list, 'none') || chr(10) || 'Say what part it plays.' as prompt from fsum f left join heard h on h.id = f.id where coalesce(f.code_summary, '') <> '' and coalesce(f.summary, '') = ''",
    "summaries_changed": f"with {FNODES} select id, coalesce(code_summary, summary) as summary, summary_embedding is not null and (code_summary is null or code_summary is not distinct from summary) as embedded from fnode",
    "cosine_topk": """with q as (select vec_id as query_id, cast(embedding as double[]) as e from embeddings where vec_id % 100 = 0), a as (select vec_id as id, cast(embedding as double[]) as e from embeddings),
        s as (select q.query_id, a.id, round(list_cosine_similarity(q.e, a.e), 6) as score from q join a on a.id <> q.query_id) select query_id, id, score, rank from (select *, row_number() over (partition by query_id order by score desc, id) as rank from s) x where rank <= 5""",
    "uri_to_path": f"with u as (select distinct location.file_uri as uri from refs where location.file_uri is not null) select uri, {_path('uri')} as path, {_base(_path('uri'))} as name, len(string_split({_path('uri')}, '/')) - 1 as depth from u",
    "percent_decode": "select p_partkey, p_name || '+x' || p_type as name from part",
    "path_ancestors": f"with {SYM}, {FILES}, e as (select project_path, path, string_split(path, '/') as p, unnest(range(1, len(string_split(path, '/')))) as i from fls), g as (select project_path, path, string_agg(array_to_string(p[1:i], '/'), ':' order by i) as folders from e group by 1, 2) select f.project_path, f.path, coalesce(g.folders, '') as folders from fls f left join g on g.project_path = f.project_path and g.path = f.path",
    "short_labels": "select doc_id, case when length(text) > 35 then left(text, 15) || ' ... ' || right(text, 15) else text end as label from documents where text is not null",
    "line_slice": "select doc_id, coalesce(array_to_string(p[2:3], chr(10)), '') || case when len(p) > 3 then chr(10) else '' end as lines from (select doc_id, string_split(text, chr(10)) as p from documents where text is not null) x",
    "marker_lines": f"with {LINES} select line, count(distinct doc_id) as n_texts from ln where starts_with(line, '- ') group by 1",
    "marker_runs": f"""with {LINES}, m as (select *, case when line is not distinct from lag(line) over (partition by doc_id order by line_no) then 0 else 1 end as f from ln where starts_with(line, '- ')),
        r as (select *, sum(f) over (partition by doc_id order by line_no rows unbounded preceding) as run_no from m) select doc_id, run_no, line, count(*) as n from r group by 1, 2, 3""",
    "call_sites_old": f"""with {SYM}, {FNODES}, {CSITES}, {SITES}, ol as (select ref_id, symbol_id, {_path('location.file_uri')} as file, location.start_line as line, location.start_column as col from rf where container_id = '' and kind in (4, 12) and location is not null),
        om as (select o.ref_id, o.symbol_id, b.id, row_number() over (partition by o.ref_id order by b.l1, b.id) as _r from ol o join fn c on c.id = o.symbol_id join bd b on b.file = o.file and (o.line > b.l1 or (o.line = b.l1 and o.col >= b.c1)) and (o.line < b.l2 or (o.line = b.l2 and o.col <= b.c2)))
        select o.ref_id, o.id as caller_id, a.name as caller_name, o.symbol_id as callee_id, b.name as callee_name from om o join fn a on a.id = o.id join fn b on b.id = o.symbol_id where _r = 1""",
    "call_edge_script": f"with {SYM}, {SITES} select 'INSERT INTO calls (caller_id, callee_id) VALUES (' || chr(39) || caller_id || chr(39) || ', ' || chr(39) || callee_id || chr(39) || ');' as value from cl",
    "span_totals": f"""{_BASE}, {FNODES}, spans as (select distinct f.name, y.project_path, f.file_path, f.name_location from fnode f join sym y on y.id = {_KEY.format('f.id')} where f.body_location is not null)
        select count(*) as n_functions, count(s.name) as n_matched from rws r left join spans s on s.name = r.name and s.project_path = r.project_path and s.file_path = r.file_path and s.name_location[1] = r.name_location[1] and s.name_location[2] = r.name_location[2] where r.kind = 'Function' and r.file_path is not null""",
    "node_json": f"""{_BASE} select id, chr(123) || '"name":' || to_json(name) || ',"kind":' || to_json(kind) || ',"scope":' || to_json(scope) || ',"has_definition":' || has_definition || case when file_path is null then '' else ',"file_path":' || to_json(file_path) end || chr(125) as document from rws where kind = 'Function'""",
    "file_nodes_with_includes": f"""with {SYM}, {FILES}, {INC}, ends as (select p.path as project_path, i.including as f from inc i join project p on starts_with(i.including, p.path || '/') union select p.path, i.included from inc i join project p on starts_with(i.including, p.path || '/')),
        more as (select distinct project_path, substr(f, length(project_path) + 2) as path from ends where starts_with(f, project_path || '/'))
        select project_path, path, name, parent_path from fls union select project_path, path, {_base('path')}, case when {_parent('path')} = '' then project_path else {_parent('path')} end from more""",
    "top_included": f"with {INC} select included, count(distinct including) as n_including from inc group by 1 order by 2 desc, 1 limit 20",
    "similar_headers": f"with {FOLD}, {INC}, {SEEN}, tos as (select distinct included from inc) select s.seed, coalesce(string_agg(t.included, ',' order by t.included), '') as similar from cseeds s left join tos t on {_base('t.included')} = {_base('s.seed')} where s.seed not in (select included from tos) group by s.seed",
    "uncalled_symbols": f"{_BASE}, {SITES} select id, kind from rws where kind in ('Function', 'Struct', 'Class', 'Union', 'Enum') and id not in (select caller_id from cl) and id not in (select callee_id from cl)",
    "leaf_functions": f"with {SYM}, {SITES} select distinct callee_name as name from st where callee_name not in (select caller_name from st)",
    "overlay_structures": f"""with {_symbols("removed_at is not null", "o0")}, {_symbols("removed_at is null", "n0")}, o as (select id, name, nullif(scope, '') as scope from o0 where kind in ('Struct', 'Class', 'Union', 'Enum')), n as (select id, name, nullif(scope, '') as scope from n0 where kind in ('Struct', 'Class', 'Union', 'Enum'))
        select coalesce(n.id, o.id) as id, coalesce(n.name, o.name) as name, coalesce(n.scope, o.scope) as scope from o full outer join n on o.id = n.id""",
    "purge_counts": f"""{_GRAPH}, {GONE}, {SITES} select 'functions' as what, count(*) as n_before, count(*) filter (id not in (select id from gone)) as n_after from rws where kind = 'Function' union all select 'defines', count(*), count(*) filter (id not in (select id from gone)) from def
        union all select 'calls', count(*), count(*) filter (caller_id not in (select id from gone) and callee_id not in (select id from gone)) from cl""",
    "path_joins": f"with {SYM}, {FILES} select project_path, path, project_path || '/' || path as full, path as again, regexp_replace(project_path || '/' || path, '/[^/]*$', '') as folder, regexp_matches(path, '\\.(c|cpp|cc|cxx)$') as is_source from fls",
    "quoted_labels": r"""select doc_id, replace(replace(trim(regexp_replace('"' || regexp_replace(text, '[^\x20-\x7E\n\t]', '?', 'g') || chr(92), '[ \t\n]+', ' ', 'g')), chr(92), chr(92) || chr(92)), '"', chr(92) || '"') as label from documents where text is not null""",
}
