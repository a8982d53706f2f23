"""One form for texts that look the same.

Texts are exploded to positioned code points and joined with a broadcast mapping, which
gives for a code point what it looks like: nothing for characters without width, a space for
any blank, the plain characters behind widths, fonts and joined letters, the base letter and
marks behind an accented letter, the Latin letter of the same shape for letters of other
scripts, one sign for all hyphens. Marks behind a base are put in the order of their
combining classes, bases and marks are composed again, and the text is rebuilt.

The mapping is built by rule from the Unicode data of the running Python, so its size is
bounded by the number of characters that have a rule, whatever the texts hold. Texts in
ASCII are their own form, and pass by.

Kept apart, since a reader can tell them: other letters, case, digits, raised and lowered
digits, fractions, circled and squared signs, accents there or not, punctuation, dashes
that are no hyphens, tabs, the number of blanks, line breaks.

Defined results: null stays null; a text without any visible character has the form in
which its blanks are spaces, and takes no part in pairs.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from symgraph.session import cut

# Letters of other scripts that have the shape of a Latin letter.
LOOK_ALIKE = {
    # Cyrillic
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "Ѵ": "V", "Ԝ": "W", "Х": "X", "Ү": "Y", "Ԍ": "G", "Ӏ": "I",
    # Greek
    "ο": "o", "ϲ": "c", "ϳ": "j", "ν": "v",
    "Α": "A", "Β": "B", "Ϲ": "C", "Ε": "E", "Η": "H", "Ι": "I", "Ϳ": "J", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "Υ": "Y", "Ζ": "Z",
    # Armenian
    "օ": "o", "ս": "u", "հ": "h", "ց": "g", "Օ": "O", "Տ": "S",
}
# The hyphens, which look like the hyphen-minus.
HYPHENS = "‐‑﹣－"
# Compatibility forms that show the same signs in another width, font or joining.
SAME_LOOK = {"<wide>", "<narrow>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>", "<noBreak>"}
# Characters without width that are no format characters (joiner of graphemes, fillers, selectors), and blanks that are no space characters.
NO_WIDTH = "\u034f\u115f\u1160\u17b4\u17b5\u180b\u180c\u180d\u180f"
OTHER_BLANKS = "\u2800\u3164\uffa0"


def _without_width(c: str) -> bool:
    # Format characters are invisible, but for those that show a sign of their own (prepended marks, joiners of hieroglyphs).
    shown = "\u0600" <= c <= "\u0605" or c in "\u06dd\u070f\u08e2\u0890\u0891\U000110bd\U000110cd" or "\U00013430" <= c <= "\U0001345f"
    return unicodedata.category(c) == "Cf" and not shown or c in NO_WIDTH or "\ufe00" <= c <= "\ufe0f" or "\U000e0100" <= c <= "\U000e01ef"


def _joined(c: str, parts: list[str]) -> bool:
    """Whether a compatibility character shows just its parts: letters or signs set close together, or one letter coded twice."""
    kinds = {unicodedata.category(p)[0] for p in parts}
    if len(parts) == 1:
        return unicodedata.category(c) == "Nl" or c == "\u00b5" or "\u2135" <= c <= "\u2138" or "\u2e80" <= c <= "\u2fdf"
    return kinds <= {"L", "M"} and "L" in kinds or kinds == {"P"} or (kinds == {"S"} and len(set(parts)) == 1)


def looks_like(c: str) -> str:
    """What one character looks like, decomposed: '' for nothing."""
    if c in "\n\r\t" or unicodedata.category(c) == "Cc":
        return c
    if _without_width(c):
        return ""
    if unicodedata.category(c) == "Zs" or c in OTHER_BLANKS:
        return " "
    if c in HYPHENS:
        return "-"
    rule = unicodedata.decomposition(c)
    if rule:
        tag, *rest = rule.split()
        if not tag.startswith("<"):
            return "".join(looks_like(chr(int(x, 16))) for x in [tag, *rest])
        if c in LOOK_ALIKE:
            return LOOK_ALIKE[c]
        parts = [chr(int(x, 16)) for x in rest]
        if tag in SAME_LOOK or (tag == "<compat>" and _joined(c, parts)):
            return "".join(map(looks_like, parts))
        return c
    if "가" <= c <= "힣":
        return unicodedata.normalize("NFD", c)
    return LOOK_ALIKE.get(c, c)


@lru_cache(maxsize=1)
def rules() -> list[tuple[str, list[str], list[int]]]:
    """(character, the characters it looks like, their combining classes) where that is not just the character with class 0."""
    out = []
    for code in range(128, sys.maxunicode + 1):
        c = chr(code)
        if unicodedata.category(c) in ("Cn", "Cs", "Co"):
            continue
        to = looks_like(c)
        if to != c or unicodedata.combining(c):
            out.append((c, list(to), [unicodedata.combining(x) for x in to]))
    return out


def mapping(spark: SparkSession) -> DataFrame:
    """(c, parts): parts are the characters with their classes. Bounded by the character set, about 17,000 rows."""
    rows = [(c, list(zip(to, classes))) for c, to, classes in rules()]
    return spark.createDataFrame(rows, "c string, parts array<struct<x: string, k: int>>")


@F.pandas_udf(T.StringType())
def _compose(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: unicodedata.normalize("NFC", x))


def text_key(c: str) -> Column:
    return F.unhex(F.sha2(c, 256))


def _is_ascii(c: str) -> Column:
    return ~F.col(c).rlike("[^\\x00-\\x7F]")


def forms(texts: DataFrame) -> DataFrame:
    """(key, form) of distinct texts (key, text) that are not ASCII.

    Runs of ASCII characters, which have no rule, stay together as one positioned piece; every
    other code point is a piece of its own. The texts move once, by key; exploding, looking up,
    ordering and rebuilding keep that partitioning.
    """
    pieces = F.expr("regexp_extract_all(text, '(?s)[\\\\x00-\\\\x7F]+|.', 0)")
    at = texts.repartition("key").select("key", F.posexplode(pieces).alias("pos", "c"))
    looked_up = at.join(F.broadcast(mapping(texts.sparkSession)), "c", "left")
    own = F.array(F.struct(F.col("c").alias("x"), F.lit(0).alias("k")))
    each = looked_up.select("key", "pos", F.posexplode(F.coalesce("parts", own)).alias("j", "p")).select("key", "pos", "j", "p.x", "p.k")
    along = W.partitionBy("key").orderBy("pos", "j")
    clustered = each.withColumn("base", F.sum(F.when(F.col("k") == 0, 1).otherwise(0)).over(along))
    ordered = clustered.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("base", "k", "pos", "j", "x"))).alias("all"))
    rebuilt = ordered.select("key", F.concat_ws("", F.transform("all", lambda p: p["x"])).alias("form"))
    return texts.select("key").join(rebuilt, "key", "left").select("key", _compose(F.coalesce("form", F.lit(""))).alias("form"))


def one_form(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_col, form) of every row."""
    rows = df.select(F.col(id_col), F.col(text_col).alias("text"))
    plain = F.coalesce(_is_ascii("text"), F.lit(True))
    other = rows.filter(~plain).withColumn("key", text_key("text"))
    formed = forms(other.select("key", "text").dropDuplicates(["key"]))
    return rows.filter(plain).select(id_col, F.col("text").alias("form")).unionByName(other.select(id_col, "key").join(formed, "key").select(id_col, "form"))


def same_look_pairs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id_a, doc_id_b), a < b: rows whose texts are different strings of one form.

    Classes of equal texts are paired, not rows, so that a text copied many times costs no
    more than the pairs that come out.
    """
    rows = df.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    keyed = rows.select("id", text_key("text").alias("key")).distinct()
    plain = rows.filter(_is_ascii("text") & F.col("text").rlike("\\S")).select(text_key("text").alias("key")).distinct()
    other = rows.filter(~_is_ascii("text")).select(text_key("text").alias("key"), "text").dropDuplicates(["key"])
    formed = forms(other).filter(F.col("form").rlike("(?U)\\S")).select("key", text_key("form").alias("form"))
    classes = cut(plain.withColumn("form", F.col("key")).unionByName(formed), "forms")
    shared = classes.groupBy("form").agg(F.count("*").alias("n")).filter("n > 1").select("form")
    several = classes.join(shared, "form", "left_semi")
    a, b = several.select("form", F.col("key").alias("key_a")), several.select("form", F.col("key").alias("key_b"))
    pairs = a.join(b, "form").filter("key_a < key_b").select("key_a", "key_b")
    left = keyed.select(F.col("key").alias("key_a"), F.col("id").alias("x"))
    right = keyed.select(F.col("key").alias("key_b"), F.col("id").alias("y"))
    found = pairs.join(left, "key_a").join(right, "key_b").filter("x <> y")
    return found.select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b")).distinct()
