"""A small project in two versions, with the cases that are easy to get wrong."""

from symgraph.api import Inputs

PLACE = "struct<file_uri: string, start_line: int, start_column: int, end_line: int, end_column: int>"
SYMBOL = f"id string, name string, kind string, lang string, scope string, signature string, return_type string, type string, canonical_declaration {PLACE}, definition {PLACE}"
REF = f"ref_id long, symbol_id string, container_id string, kind int, location {PLACE}"
SPAN = "file string, name string, line int, column int, body array<int>, seq long"


def at(path, line, column=0):
    return (f"file://{path}", line, column, line, column + 1)


def symbol(i, name, kind="Function", definition=None, declaration=None):
    return (i, name, kind, "C", "", "()", "void", "", declaration, definition)


def inputs(spark, symbols, calls, spans, includes, containers=True, new_kinds=True):
    """calls: (callee, caller, path, line, column)"""
    refs = [(n, callee, (caller if containers else None), (20 if new_kinds else 4), at(p, line, c)) for n, (callee, caller, p, line, c) in enumerate(calls)]
    refs += [(900, "F", "0000000000000000" if containers else None, 2, at("/p/a/x.c", 1)), (901, "NONE", "F" if containers else None, 8, at("/p/a/x.c", 2))]
    body = [(p, n, line, c, [line, 0, end, 1], i) for i, (p, n, line, c, end) in enumerate(spans)]
    return Inputs(spark.createDataFrame(symbols, SYMBOL), spark.createDataFrame(refs, REF), spark.createDataFrame(body, SPAN), spark.createDataFrame(includes, "including string, included string"))


def version_a(spark, **kinds):
    symbols = [
        symbol("F", "f", definition=at("/p/a/x.c", 1), declaration=at("/p/b/k.h", 3)), symbol("G", "g", definition=at("/p/a/x.c", 7)),
        symbol("H1", "h", definition=at("/p/a/y.c", 0)), symbol("H2", "h", definition=at("/p/b/z.c", 0)), symbol("P", "odd", definition=("file:///p/a/sp%20ace+x.c", 0, 0, 0, 3)),
        symbol("S2", "other", definition=at("/p2/q.c", 0)), symbol("SYS", "printf", declaration=at("/usr/include/s.h", 9)), symbol("N", "nowhere"), symbol("D", "declared", declaration=at("/p/b/k.h", 5)),
        symbol("T", "t", "Struct", at("/p/b/k.h", 8)), symbol("E", "e", "Enum", at("/p/b/k.h", 12)), symbol("V", "v", "Variable", at("/p/a/x.c", 20)), symbol("", "noid", definition=at("/p/a/x.c", 30)), symbol("R", "root_level", definition=at("/p/r.c", 0)),
    ]
    calls = [("F", "G", "/p/a/x.c", 8, 2), ("F", "G", "/p/a/x.c", 9, 2), ("G", "G", "/p/a/x.c", 10, 2), ("F", "H2", "/p/b/z.c", 1, 2), ("H2", "F", "/p/a/x.c", 2, 0), ("P", "R", "/p/r.c", 2, 1), ("SYS", "F", "/p/a/x.c", 3, 2), ("H1", "R", "/p/r.c", 3, 1)]
    spans = [("/p/a/x.c", "f", 1, 0, 5), ("/p/a/x.c", "g", 7, 0, 12), ("/p/a/y.c", "h", 0, 0, 3), ("/p/b/z.c", "h", 0, 0, 3), ("/p/a/sp ace+x.c", "odd", 0, 0, 2), ("/p/r.c", "root_level", 0, 0, 4)]
    includes = [("/p/a/x.c", "/p/b/k.h"), ("/p/b/k.h", "/p/b/m.h"), ("/p/b/m.h", "/p/b/k.h"), ("/p/b/z.c", "/p/b/m.h"), ("/p/a/y.c", "/usr/include/s.h"), ("/p/a/y.c", "/p/b..h/w.h")]
    return inputs(spark, symbols, calls, spans, includes, **kinds)


def version_b(spark, **kinds):
    """x.c modified (g gone, n new), z.c deleted, y.c moved to c/, k.h modified (e gone)."""
    symbols = [
        symbol("F", "f", definition=at("/p/a/x.c", 2), declaration=at("/p/b/k.h", 3)), symbol("NEW", "n", definition=at("/p/a/x.c", 9)),
        symbol("H1", "h", definition=at("/p/c/y.c", 0)), symbol("P", "odd", definition=("file:///p/a/sp%20ace+x.c", 0, 0, 0, 3)),
        symbol("S2", "other", definition=at("/p2/q.c", 0)), symbol("D", "declared", declaration=at("/p/b/k.h", 5)), symbol("T", "t", "Struct", at("/p/b/k.h", 8)), symbol("R", "root_level", definition=at("/p/r.c", 0)),
    ]
    calls = [("F", "NEW", "/p/a/x.c", 10, 2), ("H1", "NEW", "/p/a/x.c", 11, 2), ("P", "R", "/p/r.c", 2, 1), ("H1", "R", "/p/r.c", 3, 1)]
    spans = [("/p/a/x.c", "f", 2, 0, 6), ("/p/a/x.c", "n", 9, 0, 12), ("/p/c/y.c", "h", 0, 0, 3), ("/p/a/sp ace+x.c", "odd", 0, 0, 2), ("/p/r.c", "root_level", 0, 0, 4)]
    includes = [("/p/a/x.c", "/p/b/k.h"), ("/p/b/k.h", "/p/b/m.h"), ("/p/b/m.h", "/p/b/k.h"), ("/p/c/y.c", "/p/b/m.h")]
    return inputs(spark, symbols, calls, spans, includes, **kinds)


CHANGES = [("modified", "a/x.c", None), ("deleted", "b/z.c", None), ("renamed_exact", "c/y.c", "a/y.c"), ("modified", "b/k.h", None), ("deleted", "b..h/w.h", None), ("modified", "README", None)]
