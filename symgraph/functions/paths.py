"""Column functions on file URIs and slash-separated paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SOURCE_SUFFIXES = (".c", ".cpp", ".cc", ".cxx")
TRACKED_SUFFIXES = (".c", ".h", ".cpp", ".cc", ".cxx")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percent_decoded(c: Column | str) -> Column:
    """Percent escapes decoded; a plus sign stays one. Text with broken escapes stays as it is."""
    c = _col(c)
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def uri_path(c: Column | str) -> Column:
    """The decoded absolute path of a file URI; anything that is no file URI stays as it is."""
    c = _col(c)
    return F.when(c.startswith("file:"), percent_decoded(F.regexp_extract(c, "^file:(?://[^/]*)?([^?#]*)", 1))).otherwise(c)


def path_uri(c: Column | str) -> Column:
    return F.concat(F.lit("file://"), _col(c))


def in_project(path: Column | str, root: Column | str) -> Column:
    """By path component, so a sibling that only starts with the same text is outside."""
    path, root = _col(path), _col(root)
    return (path == root) | path.startswith(F.concat(root, F.lit("/")))


def relative(path: Column | str, root: Column | str) -> Column:
    """The path below root; outside of root the absolute path stays."""
    path, root = _col(path), _col(root)
    return F.when(in_project(path, root), F.substring(path, F.length(root) + 2, F.length(path))).otherwise(path)


def joined(root: Column | str, path: Column | str) -> Column:
    return F.concat_ws("/", _col(root), _col(path))


def basename(c: Column | str) -> Column:
    return F.substring_index(_col(c), "/", -1)


def parent(c: Column | str) -> Column:
    """'' at the root level."""
    return F.regexp_replace(_col(c), "/?[^/]*$", "")


def depth(c: Column | str) -> Column:
    return F.size(F.split(_col(c), "/")) - 1


def ancestors(c: Column | str) -> Column:
    """All folders above a relative path, outermost first; an empty array at the root level."""
    parts = F.split(_col(c), "/")
    prefix = lambda i: F.concat_ws("/", F.slice(parts, 1, i))
    return F.when(F.size(parts) >= 2, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), prefix)).otherwise(F.array().cast("array<string>"))


def has_suffix(c: Column | str, suffixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for s in suffixes:
        out = out | _col(c).endswith(s)
    return out


def shortened(c: Column | str, longest: int = 35, ends: int = 15) -> Column:
    """The two ends of a long text around an ellipsis."""
    c = _col(c)
    return F.when(F.length(c) > longest, F.concat(F.left(c, F.lit(ends)), F.lit(" ... "), F.right(c, F.lit(ends)))).otherwise(c)


def dot_label(c: Column | str) -> Column:
    """A text as a label of a graph drawing: white space collapsed, quotes and backslashes escaped."""
    flat = F.trim(F.regexp_replace(_col(c), r"\s+", " "))
    return F.replace(F.replace(flat, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
