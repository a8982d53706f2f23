import unicodedata

from hypothesis import HealthCheck, given, settings, strategies as st

from symgraph.llm import visual

SCHEMA = "doc long, text string, key string, form string"
SAME = [
    ("Time", "Ｔｉｍｅ"), ("file", "ﬁle"), ("café", "café"), ("a b", "a b"), ("a b", "a　b"), ("word", "wo​r­d"), ("re-do", "re‐do"), ("re-do", "re‑do"),
    ("pace", "расе"), ("Zeta", "Ζeta"), ("bold", "𝐛𝐨𝐥𝐝"), ("x", "x͏︎"), ("ậ", "ậ"), ("ガ", "ｶﾞ"), ("K", "K"), ("Á", "Ά"), ("...", "…"), ("한", "한"), ("IV", "Ⅳ"), ("سلام", "ﺳﻼم"),
]
DIFFERENT = [("x2", "x²"), ("1/2", "½"), ("a b", "a  b"), ("a b", "a\nb"), ("a b", "a\tb"), ("cafe", "café"), ("O", "0"), ("I", "l"), ("a-b", "a–b"), ("ss", "ß"), ("oe", "œ"), ("(1)", "⑴"), ("1", "①"), ("a.b", "a,b"), ("A", "a"), ("θ", "ϑ"), ("s", "ſ"), ("d", "đ")]


def _one(t):
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", "".join(map(visual.looks_like, t))))


def _forms(spark, texts):
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], SCHEMA)
    return {r.doc: r.form for r in visual.one_form(df, "doc", "text").collect()}


def _pairs(spark, rows):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    return sorted(map(tuple, visual.same_look_pairs(df, "doc", "text").collect()))


def test_same_and_different(spark):
    forms = _forms(spark, [t for pair in SAME + DIFFERENT for t in pair])
    for n, pair in enumerate(SAME + DIFFERENT):
        assert (forms[2 * n] == forms[2 * n + 1]) == (n < len(SAME)), pair


def test_nulls_blanks_and_long_texts(spark):
    long = "ａ̣̂ b" * 20000
    forms = _forms(spark, [None, "", "​", " ", "plain\tascii\x00", long, "́x", "🚀"])
    assert forms == {0: None, 1: "", 2: "", 3: " ", 4: "plain\tascii\x00", 5: _one(long), 6: "́x", 7: "🚀"}
    assert _forms(spark, []) == {}


def test_pairs(spark):
    rows = [(1, "time"), (2, "ｔime"), (3, "time"), (4, "tıme"), (5, None), (6, ""), (7, "​"), (8, " "), (9, " "), (10, "tіme"), (2, "ｔime"), (None, "ｔime")]
    assert _pairs(spark, rows) == [(1, 2), (1, 10), (2, 3), (2, 10), (3, 10)]
    assert _pairs(spark, []) == []


def test_many_copies_of_one_text_pair_only_with_others(spark):
    rows = [(i, "ｘ y") for i in range(500)] + [(900, "x y"), (901, "other")]
    assert _pairs(spark, rows) == [(i, 900) for i in range(500)]


def test_the_form_is_its_own_form():
    for c, to, _ in visual.rules():
        form = _one(c)
        assert _one(form) == form, c


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30), min_size=1, max_size=20))
def test_against_brute_force(spark, texts):
    assert _forms(spark, texts) == {i: _one(t) if not t.isascii() else t for i, t in enumerate(texts)}
