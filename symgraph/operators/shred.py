"""Deeply nested records to flat tables by columnar shredding.

Each document becomes, for every leaf path of a declared schema, three sequences: values,
repetition levels (at which repeated ancestor an entry continues; 0 starts a document) and
definition levels (how far down the path the document is defined). ``assemble`` rebuilds the
table of a repeated ancestor from the level sequences alone, vectorised over a batch of
documents, and keeps the document, the position at every repeated level and, on request,
the definition level of a leaf, which tells a missing field from one whose parent is bad.

A schema is a dict: a leaf is None, a group is a dict, a repeated group is a list with one
dict. A single object in place of an array is its element 0. Elements that are null or no
object keep their position, with a definition level that stops at the element.

Defined results: bodies that are null, empty, not valid JSON or no object give a row with
valid = false and no entries. Leaf values are text: strings as they are, true and false,
numbers as written by JSON, nested values as JSON text. Half surrogates become '?'. Of a
repeated field name in one object the last counts. A body nested deeper than the parser
can follow is not valid.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

LEVELS = "struct<r: array<tinyint>, d: array<tinyint>, v: array<string>>"


def leaves(schema: dict, only: list[str] | None = None) -> dict[str, list[tuple[str, bool]]]:
    """Leaf path -> steps (name, repeated)."""
    out: dict[str, list[tuple[str, bool]]] = {}

    def walk(node: dict, steps: list[tuple[str, bool]]) -> None:
        for name, sub in node.items():
            here = [*steps, (name, isinstance(sub, list))]
            if sub is None:
                out[".".join(s for s, _ in here)] = here
            else:
                walk(sub[0] if isinstance(sub, list) else sub, here)

    walk(schema, [])
    return {p: s for p, s in out.items() if only is None or p in only}


def column(path: str) -> str:
    """The name of a leaf's column among the shredded ones."""
    return path.replace(".", "/")


def element_level(schema: dict, path: str) -> tuple[int, int]:
    """(repeated depth, definition level of an existing slot) of the repeated ancestor at ``path``."""
    node, depth, level = schema, 0, 0
    for name in path.split("."):
        sub = node[name]
        depth, level = (depth + 1, level + 1) if isinstance(sub, list) else (depth, level + 1)
        node = sub[0] if isinstance(sub, list) else sub
        if isinstance(sub, list) and name != path.split(".")[-1]:
            level += 1
    return depth, level


def _refuse(name: str) -> None:
    raise ValueError(name)


class _Number(str):
    """A number as the document writes it."""


_numbers = json.JSONDecoder(parse_constant=_refuse, parse_int=_Number, parse_float=_Number)


def _parse(body: str | None) -> dict | None:
    if not body:
        return None
    try:
        got = _numbers.decode(body)
    except (ValueError, RecursionError):
        return None
    return got if isinstance(got, dict) else None


def _dump(x: object) -> str:
    if isinstance(x, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_dump(v)}" for k, v in x.items()) + "}"
    if isinstance(x, list):
        return "[" + ",".join(map(_dump, x)) + "]"
    return str(x) if isinstance(x, _Number) else json.dumps(x, ensure_ascii=False)


def _text(x: object) -> str:
    s = x if isinstance(x, str) else "true" if x is True else "false" if x is False else _dump(x)
    return s if s.isascii() else s.encode("utf-8", "replace").decode()


def _shred_into(node: dict, value: dict | None, columns: dict, prefix: str, rep: int, level: int, depth: int) -> None:
    """Append the entries of one object (or of an undefined one: value None) to the columns below prefix."""
    for name, sub in node.items():
        path = f"{prefix}{name}"
        x = value.get(name) if value is not None else None
        if sub is None:
            c = columns.get(path)
            if c is not None:
                c[0].append(rep)
                if x is None:
                    # a field that is there but null is one level above one that is missing: not told apart, as in the format
                    c[1].append(level)
                    c[2].append(None)
                else:
                    c[1].append(level + 1)
                    c[2].append(_text(x))
        elif isinstance(sub, list):
            if path not in columns["groups"]:
                continue
            items = x if isinstance(x, list) else [x] if isinstance(x, dict) else []
            if not items:
                _shred_into(sub[0], None, columns, path + ".", rep, level, depth + 1)
            for i, item in enumerate(items):
                at = rep if i == 0 else depth + 1
                if isinstance(item, dict):
                    _shred_into(sub[0], item, columns, path + ".", at, level + 2, depth + 1)
                else:
                    _shred_into(sub[0], None, columns, path + ".", at, level + 1, depth + 1)
        elif path in columns["groups"]:
            ok = isinstance(x, dict)
            _shred_into(sub, x if ok else None, columns, path + ".", rep, level + ok, depth)


def _groups(paths: list[str]) -> set[str]:
    return {p.rsplit(".", i)[0] for p in paths for i in range(1, p.count(".") + 1)}


def shred(df: DataFrame, body: str, keep: list[str], schema: dict, only: list[str] | None = None) -> DataFrame:
    """keep columns, valid, and a LEVELS column per leaf path."""
    paths = list(leaves(schema, only))
    groups = _groups(paths)
    kept = [df.schema[k] for k in keep]
    out = T.StructType([*kept, T.StructField("valid", T.BooleanType()), *[T.StructField(column(p), T._parse_datatype_string(LEVELS)) for p in paths]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                cols: dict = {p: ([], [], []) for p in paths} | {"groups": groups}
                ends: dict[str, list[int]] = {p: [0] for p in paths}
                valid = []
                for text in part.column(len(keep)).to_pylist():
                    doc = _parse(text)
                    valid.append(doc is not None)
                    if doc is not None:
                        _shred_into(schema, doc, cols, "", 0, 0, 0)
                    for p in paths:
                        ends[p].append(len(cols[p][0]))
                arrays = [part.column(i) for i in range(len(keep))] + [pa.array(valid, pa.bool_())]
                for p in paths:
                    offsets = pa.array(ends[p], pa.int32())
                    r, d, v = cols[p]
                    arrays.append(pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(x, t)) for x, t in ((r, pa.int8()), (d, pa.int8()), (v, pa.string()))], ["r", "d", "v"]))
                yield pa.RecordBatch.from_arrays(arrays, out.names)

    return df.select(*keep, body).mapInArrow(run, out)


def assemble(shredded: DataFrame, schema: dict, ancestor: str, keep: list[str], columns: dict[str, str], document: dict[str, str] | None = None, levels: dict[str, str] | None = None) -> DataFrame:
    """The table of a repeated ancestor ('' is the document itself).

    keep: columns of the shredded rows; columns: leaf path below the ancestor -> output name;
    document: leaf path of the document -> output name, repeated on each row; levels: leaf
    path below the ancestor -> output name of its definition level. Positions of the repeated
    levels come out as pos_1, pos_2, ... (0-based).
    """
    document, levels = document or {}, levels or {}
    depth, slot = element_level(schema, ancestor) if ancestor else (0, 0)
    below = list(dict.fromkeys([*columns, *levels]))
    if ancestor and not below:
        raise ValueError("a repeated ancestor is rebuilt from at least one leaf below it")
    used = list(dict.fromkeys([*below, *document]))
    out = T.StructType([shredded.schema[k] for k in keep] + [T.StructField(f"pos_{i + 1}", T.IntegerType()) for i in range(depth)] + [T.StructField(n, T.StringType()) for n in [*document.values(), *columns.values()]] + [T.StructField(n, T.ByteType()) for n in levels.values()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            data = {}
            for i, p in enumerate(used):
                c = batch.column(len(keep) + i)
                r, d, v = c.flatten()  # with the batch's offset, which field() does not know
                counts = np.diff(r.offsets.to_numpy())
                owner = np.repeat(np.arange(n), counts)
                data[p] = (owner, r.flatten().to_numpy(zero_copy_only=False), d.flatten().to_numpy(zero_copy_only=False), v.flatten())
            lead = data[below[0]] if below else (np.arange(n),) * 3
            at = lead[1] <= depth if ancestor else np.ones(n, bool)
            there = (lead[2][at] >= slot) if ancestor else np.ones(n, bool)
            owner, r = lead[0][at], lead[1][at] if ancestor else np.zeros(n, np.int8)
            positions = []
            for level in range(1, depth + 1):
                step, reset = (r == level).cumsum(), np.nonzero(r < level)[0]
                base = np.zeros(len(r), np.int64)
                if len(reset):
                    base = step[reset][np.searchsorted(reset, np.arange(len(r)), side="right") - 1]
                positions.append((step - base).astype(np.int32)[there])
            rows = owner[there]
            arrays = [batch.column(i).take(pa.array(rows)) for i in range(len(keep))] + [pa.array(x) for x in positions]
            for p in document:
                own = np.full(n, -1)
                own[data[p][0]] = np.arange(len(data[p][0]))
                arrays.append(data[p][3].take(pa.array(own[rows], mask=own[rows] < 0)))
            for p in columns:
                arrays.append(data[p][3].filter(pa.array(data[p][1] <= depth)).filter(pa.array(there)) if ancestor else data[p][3])
            for p in levels:
                arrays.append(pa.array(data[p][2][data[p][1] <= depth][there].astype(np.int8)))
            yield pa.RecordBatch.from_arrays(arrays, out.names)

    source = shredded if "valid" not in shredded.columns else shredded.filter("valid")
    return source.select(*keep, *[column(p) for p in used]).mapInArrow(run, out)
