"""Fixed schemas: the fields of index documents."""

from __future__ import annotations

_PLACE = {"FileURI": None, "Start": {"Line": None, "Column": None}, "End": {"Line": None, "Column": None}}
#: The fields of the index documents, as ``operators.shred`` takes them.
INDEX_SCHEMA = {
    "ID": None, "Name": None, "Scope": None, "SymInfo": {"Kind": None, "Lang": None}, "CanonicalDeclaration": _PLACE, "Definition": _PLACE,
    "Flags": None, "Signature": None, "ReturnType": None, "Type": None, "Documentation": None,
    "IncludeHeaders": [{"Header": None, "References": None}],
    "References": [{"Kind": None, "Location": _PLACE, "Container": {"ID": None}}],
    "Subject": {"ID": None}, "Predicate": None, "Object": {"ID": None},
}


def place_columns(at: str, name: str) -> dict[str, str]:
    """Leaf paths of a place -> column names."""
    return {f"{at}.FileURI": f"{name}_file_uri", f"{at}.Start.Line": f"{name}_start_line", f"{at}.Start.Column": f"{name}_start_column", f"{at}.End.Line": f"{name}_end_line", f"{at}.End.Column": f"{name}_end_column"}
