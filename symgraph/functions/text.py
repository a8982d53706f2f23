"""Column functions on identifiers and dirty text values."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

#: Blanks that do not count around a value.
BLANKS = " \t"


def trimmed(c: Column | str) -> Column:
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(BLANKS))


def symbol_key(c: Column | str) -> Column:
    """A symbol id as it compares: upper case, without surrounding blanks."""
    return F.upper(trimmed(c))


def is_reference(key: Column) -> Column:
    """Whether a compared id names anything: null, empty and all zeros do not."""
    return key.isNotNull() & (key != "") & ~key.rlike("^0+$")


def plain(c: Column | str) -> Column:
    """A value in which null equals '' and surrounding blanks do not count."""
    return F.coalesce(trimmed(c), F.lit(""))


def blanked(text: str) -> str:
    """C text with comments, strings and preprocessor lines as blanks, every place as it was."""
    keep_lines = lambda m: re.sub(r"[^\n]", " ", m.group())
    text = re.sub(r'/\*.*?(?:\*/|\Z)|//[^\n]*|"(?:\\.|[^"\\\n])*"|\'(?:\\.|[^\'\\\n])*\'', keep_lines, text, flags=re.S)
    return re.sub(r"^[ \t]*#(?:[^\n]*\\\n)*[^\n]*", keep_lines, text, flags=re.M)
