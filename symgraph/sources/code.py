"""Source trees: files, function bodies and include pairs, by a pluggable extractor.

The built-in extractor is a scanner for C without a compiler: it blanks comments, strings
and preprocessor lines, finds top-level ``name(...) {`` and matches braces. Any function
``(path, text) -> (spans, includes)`` can take its place.
"""

from __future__ import annotations

import re
import shlex
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from symgraph.functions import paths as P
from symgraph.functions.text import blanked

Span = tuple[str, int, int, int, int, int, int]  # name, line and column of the name, first and last place of the body
#: (path, text) -> spans and the names that are included, '<...>' with their brackets.
Extractor = Callable[[str, str], tuple[list[Span], list[str]]]

SPANS = "file string, name string, line int, column int, body array<int>, seq long"
# Words that stand before brackets without being a function's name.
NOT_NAMES = {"if", "for", "while", "switch", "return", "sizeof", "defined", "else", "do"}


def read_files(paths: DataFrame) -> DataFrame:
    """(path, text) of the files named (path), read where the tasks run; what is not there or cannot be read has no row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for frame in frames:
            out = []
            for path in frame["path"]:
                where, name = (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
                try:
                    with where.open_input_stream(name) as stream:
                        out.append((path, stream.read().decode("utf-8", "replace")))
                except OSError:
                    continue
            yield pd.DataFrame(out, columns=["path", "text"])

    return paths.select("path").distinct().repartition("path").mapInPandas(run, "path string, text string")


def read_tree(spark: SparkSession, root: str, pattern: str = "*.{c,h,cpp,cc,cxx}") -> DataFrame:
    """(path, text) of the source files below root; bytes that are no UTF-8 are replaced."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select(F.regexp_replace("path", "^file:/*", "/").alias("path"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def scan_c(path: str, text: str) -> tuple[list[Span], list[str]]:
    """Function bodies (0-based places) and the names that are included."""
    includes = [q or f"<{a}>" for q, a in re.findall(r'^[ \t]*#[ \t]*include[ \t]*(?:"([^"\n]+)"|<([^>\n]+)>)', text, flags=re.M)]
    code, spans, at = blanked(text), [], 0
    starts = [0, *(m.end() for m in re.finditer("\n", code))]

    def place(i: int) -> tuple[int, int]:
        from bisect import bisect_right

        line = bisect_right(starts, i) - 1
        return line, i - starts[line]

    while (brace := code.find("{", at)) >= 0:
        depth, end = 1, brace + 1
        while depth and (m := re.compile(r"[{}]").search(code, end)):
            depth, end = depth + (1 if m.group() == "{" else -1), m.end()
        head = code[at:brace]
        name = None
        if head.rstrip().endswith(")") and "=" not in head.rsplit(";", 1)[-1]:
            close, level = len(head.rstrip()) - 1, 0
            for i in range(close, -1, -1):
                level += (head[i] == ")") - (head[i] == "(")
                if level == 0:
                    name = re.search(r"([A-Za-z_]\w*)\s*$", head[:i])
                    break
        if name and name.group(1) not in NOT_NAMES:
            start = at + name.start(1)
            declared = at + max(head[: name.start(1)].rfind(x) for x in ";}") + 1
            declared += len(code[declared:start]) - len(code[declared:start].lstrip())
            spans.append((name.group(1), *place(start), *place(declared), *place(end - 1)))
        elif head.strip().startswith("extern"):
            end = brace + 1  # a linkage block holds declarations at the top level
        at = end
    return spans, includes


def extract(sources: DataFrame, extractor: Extractor = scan_c, commands: DataFrame | None = None, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(spans, includes): SPANS rows and (including, included) pairs of absolute paths, each distinct.

    An included name is looked for in the including file's folder (if it is quoted) and then in the
    folders that the file's compile command names (commands: as of ``read_compile_commands``;
    a header takes those of all commands), and is the first that is there (known: (path) of all files; the
    sources if not given). A quoted name that is nowhere is taken from the folder of the file; one in
    angle brackets that is nowhere belongs to the system and is left out.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for path, text in zip(frame["path"], frame["text"]):
                try:
                    spans, includes = extractor(path, text or "")
                except Exception:  # noqa: BLE001
                    continue
                out += [(path, n, li, c, [a, b, y, z], None) for n, li, c, a, b, y, z in spans]
                out += [(path, None, None, None, None, i) for i in includes]
            yield pd.DataFrame(out, columns=["file", "name", "line", "column", "body", "included"]).astype({"line": "Int32", "column": "Int32"})

    both = sources.mapInPandas(run, "file string, name string, line int, column int, body array<int>, included string")
    spans = both.filter("included is null").select("file", "name", "line", "column", "body").distinct().withColumn("seq", F.xxhash64("file", "name", "line", "column"))
    named = both.filter("included is not null").select("file", "included").distinct()
    own = named.filter(~F.col("included").startswith("<")).select("file", "included", F.lit(0).alias("no"), normal_path(F.concat_ws("/", F.regexp_replace("file", "/[^/]*$", ""), "included")).alias("at"))
    if commands is None:
        return spans, own.select(F.col("file").alias("including"), F.col("at").alias("included")).distinct()
    folders = commands.select("file", F.posexplode(include_folders(F.col("arguments"), F.col("directory"))).alias("no", "folder"))
    every = folders.groupBy("folder").agg(F.min("no").alias("no"))
    bare = F.regexp_replace("included", "[<>]", "")
    files = (sources if known is None else known).select("path").distinct()
    by_command = named.join(folders, "file").select("file", "included", (F.col("no") + 1).alias("no"), normal_path(F.concat_ws("/", "folder", bare)).alias("at"))
    there = own.unionByName(by_command).join(files.withColumnRenamed("path", "at"), "at", "left_semi")
    # headers: what lies below any of the folders, by the name that it has from there
    below = files.select("path", F.explode(P.ancestors("path")).alias("folder")).join(every, "folder").select(P.relative("path", "folder").alias("_name"), (F.col("no") + 1).alias("no"), F.col("path").alias("at"))
    headers = named.join(commands.select("file").distinct(), "file", "left_anti").withColumn("_name", F.substring(normal_path(bare), 2, 1 << 30))
    there = there.unionByName(headers.join(below, "_name").select("file", "included", "no", "at"))
    first = there.groupBy("file", "included").agg(F.min(F.struct("no", "at")).alias("m")).select("file", "included", "m.at")
    nowhere = own.join(first, ["file", "included"], "left_anti").select("file", "included", "at")
    return spans, first.unionByName(nowhere).select(F.col("file").alias("including"), F.col("at").alias("included")).distinct()


def by_file(spans: DataFrame, includes: DataFrame) -> DataFrame:
    """(document): a JSON text per file with its functions and includes, each in order."""
    functions = spans.groupBy(F.col("file").alias("path")).agg(F.array_sort(F.collect_list(F.struct("line", "column", "name", "body"))).alias("functions"))
    headers = includes.groupBy(F.col("including").alias("path")).agg(F.array_sort(F.collect_set("included")).alias("includes"))
    return functions.join(headers, "path", "full_outer").select(F.to_json(F.struct("path", "functions", "includes")).alias("document"))


def normal_path(path: Column) -> Column:
    """An absolute path without '.', '..' and empty parts."""
    parts = F.filter(F.split(path, "/"), lambda x: (x != "") & (x != "."))
    step = lambda kept, x: F.when(x == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.concat(kept, F.array(x)))
    return F.concat(F.lit("/"), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"))


# Compiler flags that name a folder in which includes are looked for.
INCLUDE_FLAGS = ("-I", "-isystem", "-iquote")


def include_folders(arguments: Column, directory: Column) -> Column:
    """The folders of include flags, in order, absolute; the flag and its folder are one argument or two."""
    after = F.transform(arguments, lambda a, i: F.when(F.get(arguments, i - 1).isin(*INCLUDE_FLAGS), a).when(~a.isin(*INCLUDE_FLAGS) & a.rlike(f"^({'|'.join(INCLUDE_FLAGS)})."), F.regexp_replace(a, f"^({'|'.join(INCLUDE_FLAGS)})", "")))
    return F.transform(F.array_compact(after), lambda x: F.when(x.startswith("/"), x).otherwise(F.concat_ws("/", directory, x)))


@F.pandas_udf(T.ArrayType(T.StringType()))
def shell_words(commands: pd.Series) -> pd.Series:
    """The words of a command as a shell takes them apart; unbalanced quotes: split at blanks."""

    def words(x: str | None) -> list[str] | None:
        try:
            return None if x is None else shlex.split(x)
        except ValueError:
            return x.split()

    return commands.map(words)


# What stands in C++ only. Words of the language, scopes, references, casts and access labels.
CPP_ONLY = r"\b(?:namespace|template|class|typename|virtual|operator|using|friend|explicit|constexpr|nullptr|mutable|decltype|noexcept|static_cast|dynamic_cast|reinterpret_cast|const_cast)\b|\b(?:public|private|protected)\s*:|\w::|=\s*(?:default|delete)\s*;|\w\s*&\s*\w+\s*[,)]"


def has_cpp(text: str | None) -> bool:
    """Whether a text without comments, strings and preprocessor lines holds what C does not have."""
    return bool(text) and re.search(CPP_ONLY, blanked(text)) is not None


def header_languages(sources: DataFrame) -> DataFrame:
    """(path, language) of headers: C++ if C++ sources lie beside it, else C if C sources do, else by its text; unreadable ones are C."""
    folder = F.regexp_replace("path", "/?[^/]*$", "")
    beside = sources.select(folder.alias("folder"), F.col("path").rlike(r"(?i)\.(cpp|cc|cxx)$").alias("cpp"), F.col("path").rlike(r"(?i)\.c$").alias("c")).groupBy("folder").agg(F.bool_or("cpp").alias("cpp"), F.bool_or("c").alias("c"))
    headers = sources.filter(F.col("path").rlike(r"(?i)\.h$")).withColumn("folder", folder).join(beside, "folder")

    def by_text(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"path": frame["path"], "language": ["C++" if has_cpp(t) else "C" for t in frame["text"]]})

    known = headers.filter("cpp or c").select("path", F.when(F.col("cpp"), "C++").otherwise("C").alias("language"))
    return known.unionByName(headers.filter("not cpp and not c").select("path", "text").mapInPandas(by_text, "path string, language string"))


# Compiler flags that name an output and take an operand, and flags that only concern output.
WITH_OPERAND = ("-o", "-MF", "-MT", "-MQ")
WITHOUT_OPERAND = ("-c", "-MD", "-MMD", "-MP", "-fcolor-diagnostics", "-fdiagnostics-color")


def parse_arguments(arguments: Column, file: Column) -> Column:
    """The arguments of a compile command that matter for parsing: without compiler, outputs and the file itself."""
    name = F.substring_index(file, "/", -1)
    state = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(False).alias("skip"))

    def step(s: Column, a: Column) -> Column:
        drop = s["skip"] | a.isin(*WITH_OPERAND, *WITHOUT_OPERAND) | (F.substring_index(a, "/", -1) == name)
        return F.struct(F.when(drop, s["kept"]).otherwise(F.concat(s["kept"], F.array(a))).alias("kept"), (~s["skip"] & a.isin(*WITH_OPERAND)).alias("skip"))

    return F.aggregate(F.slice(arguments, 2, 1 << 20), state, step, lambda s: s["kept"])


def read_compile_commands(spark: SparkSession, path: str) -> DataFrame:
    """(file, directory, arguments) of a compilation database, the first command of a file; relative files are below their directory."""
    schema = "file string, directory string, arguments array<string>, command string"
    raw = spark.read.schema(schema).json(path, multiLine=True).withColumn("_seq", F.monotonically_increasing_id())
    words = F.coalesce("arguments", shell_words("command"))
    file = F.when(F.col("file").startswith("/"), F.col("file")).otherwise(F.concat_ws("/", "directory", "file"))
    rows = raw.filter("file is not null").select(file.alias("file"), "directory", words.alias("arguments"), "_seq")
    first = rows.groupBy("file").agg(F.min(F.struct("_seq", "directory", "arguments")).alias("m"))
    return first.select("file", "m.directory", parse_arguments(F.col("m.arguments"), F.col("file")).alias("arguments"))
