"""The code graph as one object: build, update, enrich, ask, save."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from symgraph.functions import paths as P
from symgraph.operators import calls, changes, enrich, nodes, store, traverse
from symgraph.session import cut, cut_all

#: Node tables with their keys, and edge tables with their ends.
NODE_KEYS = {"project": "path", "folder": "path", "file": "path", "function": "id", "data_structure": "id"}


@dataclass
class Inputs:
    """What a compiler index and a source tree give: symbols and refs as in ``sources.index_yaml``,
    spans (file, name, line, column, body, seq) and includes (including, included), absolute paths."""

    symbols: DataFrame
    refs: DataFrame
    spans: DataFrame
    includes: DataFrame


@dataclass
class CodeGraph:
    spark: SparkSession
    root: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    failures: DataFrame | None = None  # (label, key, error): prompts that the last enrichment has no answer to

    # Building

    @classmethod
    def build(cls, spark: SparkSession, root: str, inputs: Inputs, name: str | None = None, commit: str | None = None, keep_orphans: bool = False) -> CodeGraph:
        graph = cls(spark, root.rstrip("/"))
        project = spark.createDataFrame([(graph.root, name or graph.root.rsplit("/", 1)[-1] or "Project", commit, None, None)], store.schema_of("project"))
        graph.tables = {"project": project, **cut_all(graph._structure(inputs), "structure")}
        graph.tables["calls"] = cut(calls.call_edges(graph.call_sites(inputs.refs)), "calls")
        if not keep_orphans:
            graph._drop_orphans()
        return graph.materialized()

    def _symbol_rows(self, symbols: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = nodes.symbol_rows(symbols.withColumn("project_path", F.lit(self.root)))
        where = symbols.filter("definition is not null").select("id", P.uri_path(F.col("definition.file_uri")).alias("file"), F.col("definition.start_line").alias("line"), F.col("definition.start_column").alias("column"))
        functions = nodes.functions(rows).join(where, "id", "left")
        functions = self._typed(calls.with_bodies(functions, spans), "function")
        return functions, self._typed(nodes.structures(rows), "data_structure")

    @staticmethod
    def _typed(df: DataFrame, kind: str) -> DataFrame:
        """df with exactly the columns of a stored table; missing ones are null."""
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in store.schema_of(kind).fields])

    def _structure(self, x: Inputs) -> dict[str, DataFrame]:
        symbols = x.symbols.withColumn("project_path", F.lit(self.root))
        functions, structures = self._symbol_rows(x.symbols, x.spans)
        files = nodes.file_nodes(symbols, x.includes.withColumn("project_path", F.lit(self.root)))
        folders = nodes.folder_nodes(files)
        rows = functions.select("file_path", "id", "kind").unionByName(structures.select("file_path", "id", "kind")).withColumn("project_path", F.lit(self.root))
        inside = x.includes.filter(P.in_project("including", F.lit(self.root)) & P.in_project("included", F.lit(self.root)))
        pairs = inside.select(P.relative("including", F.lit(self.root)).alias("including"), P.relative("included", F.lit(self.root)).alias("included"))
        return {
            "folder": self._typed(folders, "folder"), "file": self._typed(files, "file"), "function": functions, "data_structure": structures,
            "contains": self._typed(nodes.contains_edges(files, folders), "contains"), "defines": self._typed(nodes.defines_edges(rows, files), "defines"),
            "includes": nodes.pair_edges(pairs, files, "including", "included", "path"),
        }

    def with_functions(self, x: Inputs) -> CodeGraph:
        """The graph with the index's functions and data structures alone, which is what calls need."""
        functions, structures = self._symbol_rows(x.symbols, x.spans)
        return CodeGraph(self.spark, self.root, {"function": cut(functions, "functions"), "data_structure": structures})

    def call_sites(self, refs: DataFrame, flags: Row | None = None) -> DataFrame:
        """Call sites between the graph's functions; flags: the format of the whole index, if refs are some of its references."""
        return calls.call_sites(refs, self.tables["function"], self.root, flags or calls.feature_flags(refs).head())

    def call_stats(self, refs: DataFrame) -> DataFrame:
        return calls.call_stats(self.call_sites(refs), self.tables["function"])

    def _drop_orphans(self) -> None:
        t = self.tables
        ends = [t["defines"].select("id", F.col("id").alias("_")), t["calls"]]
        held = ends[0].select("id").unionByName(t["calls"].select(F.col("caller_id").alias("id"))).unionByName(t["calls"].select(F.col("callee_id").alias("id"))).distinct()
        for kind in ("function", "data_structure"):
            t[kind] = t[kind].join(held, "id", "left_semi")

    def materialized(self) -> CodeGraph:
        """Every table written to the shared folder, so later steps start from files."""
        self.tables = cut_all(self.tables, "graph")
        return self

    # Storage

    def save(self, path: str) -> None:
        for name, df in self.tables.items():
            if name in NODE_KEYS:
                store.check_unique(df, NODE_KEYS[name])
            df.write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CodeGraph:
        tables = {name: spark.read.schema(store.schema_of(name)).parquet(f"{path}/{name}") for name in store.STORED}
        rows = tables["project"].limit(2).collect()
        if len(rows) != 1:
            raise ValueError(f"{path} holds {'no' if not rows else 'more than one'} project")
        return cls(spark, rows[0].path, tables)

    # Updating

    def dirty_files(self, changed: DataFrame) -> DataFrame:
        """(path), relative: what a change set (change_type, path) makes to be read again, files that include a changed header among it."""
        headers = changes.changed_headers(changed).select("path")
        impacted = traverse.impact(self.tables["includes"], headers, "including", "included").select(F.col("node").alias("path"))
        return changes.dirty_files(changed, [], impacted)

    def functions_in(self, files: DataFrame) -> DataFrame:
        """(id) of the functions that the given files (path) define."""
        inside = self.tables["defines"].filter("dst_label = 'FUNCTION'")
        return inside.join(files.select(F.col("path").alias("file_path")), "file_path", "left_semi").select("id").distinct()

    def update(self, inputs: Inputs, changed: DataFrame, commit: str | None = None) -> CodeGraph:
        """The graph after a change set (change_type, relative path), from the new index and the new
        spans and includes of at least the dirty files. Equals a new build; summaries of symbols in
        clean files are kept."""
        t = self.tables
        dirty = cut(self.dirty_files(changed), "dirty")
        deleted = cut(changed.filter("change_type = 'deleted'").select("path").distinct(), "deleted")
        stamp = lambda df: df.withColumn("commit_hash", F.coalesce(F.lit(commit), F.col("commit_hash")))
        if dirty.isEmpty() and deleted.isEmpty():
            return CodeGraph(self.spark, self.root, {**t, "project": stamp(t["project"])})
        scope = dirty.unionByName(deleted).distinct()
        root = F.lit(self.root)

        seeds = changes.dirty_symbols(inputs.symbols, dirty.select(P.joined(root, "path").alias("path"))).select("id")
        subset = cut(traverse.subset_one_hop(seeds, inputs.refs), "subset")
        near = Inputs(inputs.symbols.join(subset, "id", "left_semi"), inputs.refs, inputs.spans.join(dirty.select(P.joined(root, "path").alias("file")), "file", "left_semi"), inputs.includes.join(dirty.select(P.joined(root, "path").alias("including")), "including", "left_semi"))
        new = cut_all(self._structure(near), "near")

        gone = cut(t["defines"].join(scope.withColumnRenamed("path", "file_path"), "file_path", "left_semi").select("id").distinct(), "gone")
        keep = lambda name: store.without_keys(t[name], gone, "id", "id")
        functions = cut(store.overlay(keep("function"), new["function"], ["id"]), "functions")
        out = {
            "project": stamp(t["project"]),
            "function": self._typed(functions, "function"),
            "data_structure": self._typed(store.overlay(keep("data_structure"), new["data_structure"], ["id"]), "data_structure"),
            "includes": store.purge_includes(t["includes"], scope).unionByName(new["includes"]).distinct().join(deleted.withColumnRenamed("path", "included"), "included", "left_anti").select("including", "included"),
            "defines": store.without_keys(t["defines"], gone, "id", "id").unionByName(new["defines"]).distinct(),
        }
        files = store.overlay(store.without_keys(t["file"], deleted, "path", "path"), store.without_keys(new["file"], deleted, "path", "path"), ["path"])
        plain_files = files.select(root.alias("project_path"), "path", "name", "parent_path")
        folders = nodes.folder_nodes(plain_files)
        old_folders = t["folder"].select("path", "summary", "summary_embedding")
        out |= {"file": self._typed(files, "file"), "folder": self._typed(folders.join(old_folders, "path", "left"), "folder"), "contains": self._typed(nodes.contains_edges(plain_files, folders), "contains")}

        touched = seeds.unionByName(gone).distinct()
        old_calls = store.without_keys(store.without_keys(t["calls"], touched, "caller_id", "id"), touched, "callee_id", "id")
        near_refs = self._refs_near(inputs.refs, touched, dirty)
        flags = calls.feature_flags(inputs.refs).head()  # of the whole index: what lies near the changes may lack what tells its format
        graph = CodeGraph(self.spark, self.root, out)
        fresh = calls.call_edges(graph.call_sites(near_refs, flags))
        out["calls"] = cut(nodes.pair_edges(old_calls.unionByName(fresh), functions, "caller_id", "callee_id", "id"), "calls")
        graph._drop_orphans()
        return graph.materialized()

    def _refs_near(self, refs: DataFrame, touched: DataFrame, dirty: DataFrame) -> DataFrame:
        """References to or from touched symbols, or inside dirty files."""
        at = dirty.select(P.joined(F.lit(self.root), "path").alias("_at"))
        r = refs.withColumn("_at", P.uri_path(F.col("location.file_uri")))
        ids = touched.select("id")
        return r.join(at, "_at", "left_semi").unionByName(r.join(ids, r["symbol_id"] == ids["id"], "left_semi")).unionByName(r.join(ids, r["container_id"] == ids["id"], "left_semi")).drop("_at").dropDuplicates(["ref_id"])

    # Enrichment

    def enrich(self, sources: DataFrame, summarizer: enrich.Summarizer = enrich.constant_summaries, embedder: enrich.Embedder = enrich.hashed_embeddings, only: DataFrame | None = None, changed: DataFrame | None = None) -> CodeGraph:
        """Summaries from functions up to the project, then embeddings; each level is one job.

        sources: (path, text), relative paths. Without more, everything that lacks a summary gets
        one. After an update, only: (id) of functions to look at again, and changed: (change_type,
        path); then just these functions, those one call from a changed code summary, the files that
        define a changed function or changed themselves, and the folders above are looked at.
        """
        t, targeted, failed = dict(self.tables), only is not None or changed is not None, []
        seeds = only if only is not None else self.spark.createDataFrame([], "id string")

        def apply(name: str, prompts: DataFrame, column: str = "summary") -> DataFrame:
            """Writes new summaries; gives the keys whose text changed."""
            key = NODE_KEYS[name]
            before = t[name].select(key, F.col(column).alias("_old"))
            said = cut(enrich.summarize(prompts, [key], summarizer), "said")
            failed.append(said.filter("error is not null").select(F.lit(name).alias("label"), F.col(key).alias("key"), "error"))
            t[name] = cut(enrich.apply_summaries(t[name], said.select(key, "new_summary"), [key], column), "enrich")
            return cut(t[name].join(before, key).filter(~F.col(column).eqNullSafe(F.col("_old"))).select(key), "changed")

        todo = t["function"].join(seeds.select("id").distinct(), "id", "left_semi") if targeted else enrich.needs_code_summary(t["function"])
        recoded = apply("function", enrich.function_prompts(todo, sources), "code_summary")
        if targeted:
            near = seeds.select("id").unionByName(traverse.neighbours(recoded, t["calls"])).distinct()
            todo = t["function"].join(near, "id", "left_semi").filter("code_summary is not null")
        else:
            todo = enrich.needs_summary(t["function"])
        said = apply("function", enrich.context_prompts(todo, traverse.call_context(t["function"], t["calls"], todo)))

        files = enrich.file_prompts(t["function"], []).withColumnRenamed("file_path", "path")
        folders = None
        if targeted:
            touched = t["defines"].join(said, "id", "left_semi").select(F.col("file_path").alias("path"))
            gone = self.spark.createDataFrame([], "path string")
            if changed is not None:
                touched = touched.unionByName(changed.filter(F.col("change_type").isin("added", "modified")).select("path"))
                gone = changed.filter("change_type = 'deleted'").select("path")
            touched = cut(touched.distinct(), "touched")
            files = files.join(touched, "path", "left_semi")
            folders = cut(touched.unionByName(gone).select(F.explode(P.ancestors("path")).alias("path")).distinct(), "touched")
        apply("file", files)
        labelled = lambda df, label: df.select(F.lit(label).alias("label"), "name", "summary", "parent_path")
        deepest = t["folder"].agg(F.max(P.depth("path"))).head()[0]
        for level in range(deepest if deepest is not None else -1, -1, -1):  # children before parents
            children = labelled(t["file"], "File").unionByName(labelled(t["folder"], "Folder"))
            prompts = enrich.folder_prompts(children.filter((P.depth("parent_path") == level) & (F.col("parent_path") != self.root))).withColumnRenamed("parent_path", "path")
            apply("folder", prompts if folders is None else prompts.join(folders, "path", "left_semi"))
        if folders is None or not (folders.isEmpty() and touched.isEmpty()):
            top = labelled(t["file"], "File").unionByName(labelled(t["folder"], "Folder")).filter(F.col("parent_path") == self.root)
            apply("project", enrich.project_prompts(top.withColumn("path", F.lit(self.root)), "path", F.lit(t["project"].head().name)))
        labels = ("project", "folder", "file", "function")
        found = cut(enrich.embed(enrich.needs_embedding({x: (t[x], NODE_KEYS[x]) for x in labels}), embedder), "embeddings")
        for x in labels:
            mine = found.filter(F.col("label") == x).select(F.col("key").alias(NODE_KEYS[x]), F.col("embedding").alias("_new"))
            t[x] = t[x].join(mine, NODE_KEYS[x], "left").withColumn("summary_embedding", F.coalesce("_new", "summary_embedding")).select(*t[x].columns)
        graph = CodeGraph(self.spark, self.root, t).materialized()
        graph.failures = reduce(DataFrame.unionByName, failed)
        return graph

    # Questions

    def impact(self, headers: DataFrame) -> DataFrame:
        return traverse.impact(self.tables["includes"], headers, "including", "included")

    def impacted_sources(self, headers: DataFrame) -> DataFrame:
        return traverse.impacted_sources(self.tables["includes"], headers, "including", "included")

    def neighbours(self, ids: DataFrame) -> DataFrame:
        return traverse.neighbours(ids, self.tables["calls"])

    def _edge_types(self) -> DataFrame:
        t = self.tables
        edges = {"CONTAINS": (t["contains"], "src_label", "dst_label"), "DEFINES": (t["defines"].withColumn("src_label", F.lit("FILE")), "src_label", "dst_label"), "INCLUDES": (t["includes"], None, None), "CALLS": (t["calls"], None, None)}
        return store.edge_types(edges, {"INCLUDES": ("FILE", "FILE"), "CALLS": ("FUNCTION", "FUNCTION")})

    def schema(self) -> str:
        return store.schema_text({k.upper(): self.tables[k] for k in NODE_KEYS}, self._edge_types())

    def schema_json(self) -> str:
        """The same as JSON: node properties with their types, key and count, and edge types with counts."""
        nodes_ = {k.upper(): {"key": NODE_KEYS[k], "count": self.tables[k].count(), "properties": {n: t for _, n, t in store.property_types({k: self.tables[k]})}} for k in NODE_KEYS}
        return json.dumps({"nodes": nodes_, "edges": [r.asDict() for r in self._edge_types().orderBy("src_label", "edge", "dst_label").collect()]}, indent=2)  # one row per edge type

    # Vector index: the usable vectors of a label at unit length, beside the graph

    def write_vectors(self, path: str, label: str = "function", dims: int = 384) -> None:
        rows = self.tables[label].filter((F.size("summary_embedding") == dims) & ~F.exists("summary_embedding", lambda x: x.isNull() | F.isnan(x)))
        length = F.sqrt(F.aggregate("summary_embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
        unit = rows.select(NODE_KEYS[label], "summary_embedding", length.alias("_n")).filter("_n > 0")
        unit.select(NODE_KEYS[label], F.transform("summary_embedding", lambda x: (x / F.col("_n")).cast("float")).alias("summary_embedding")).write.mode("overwrite").parquet(f"{path}/vectors-{label}")

    def vectors(self, path: str, label: str = "function") -> DataFrame:
        return self.spark.read.parquet(f"{path}/vectors-{label}")

    def drop_vectors(self, path: str, label: str = "function") -> None:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/vectors-{label}")
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def search(self, queries: DataFrame, label: str = "function", k: int = 5, dims: int = 384) -> DataFrame:
        """The k nodes most similar to each query (same key column, summary_embedding)."""
        rows = self.tables[label].filter("summary_embedding is not null")
        return enrich.cosine_topk(queries, rows, NODE_KEYS[label], "summary_embedding", dims, k)
