import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from symgraph.llm import tokens

pytest.importorskip("tiktoken")


def _ids(spark, texts, **options):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc long, text string, key string")
    return {r.doc: r.ids for r in tokens.encode_column(df, ["doc"], "text", **options).collect()}


def _want(texts):
    path = tokens.vocabulary_path()
    return {i: tokens.encode(t, path) for i, t in enumerate(texts)}


def test_against_the_other_library(spark, data):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect()] + ["<|endoftext|> x", None, "", " ", "\n\n\n"]
    want = [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    assert _ids(spark, texts) == dict(enumerate(want))
    assert _ids(spark, texts, chunk_chars=100, overlap=24) == dict(enumerate(want))


def test_hard_seams(spark):
    texts = ["a" * 500, " " * 300 + "x", "\n\n" * 90 + "b", "it's we'll they've " * 40, "''s" * 120, "word \n\n\n word" * 30, "日本語テキスト" * 60, "🚀👩‍🔧 " * 50, "x" * 41 + " y" * 200, "12345 " * 60, "\t\r\n x" * 60, "a" * 90 + "'ll" + "b" * 300]
    assert _ids(spark, texts, chunk_chars=60, overlap=20) == _want(texts)


def test_a_bad_seam_joins_only_what_is_beside_it(spark):
    text = "some words " * 30 + "a" * 200 + " and more words" * 40
    df = spark.createDataFrame([(b"k", text)], "key binary, text string")
    got = [r.text for r in tokens.pieces(df, 60, 20).orderBy("piece").collect()]
    assert "".join(got) == text and max(map(len, got)) < 320 and len(got) > 15


def test_long_repeated_texts_are_encoded_once_and_kept(spark):
    texts = ["some words here " * 40] * 5 + [None]
    assert _ids(spark, texts, chunk_chars=100, overlap=24) == _want(texts)


def test_bounds(spark):
    with pytest.raises(ValueError):
        _ids(spark, ["x"], chunk_chars=20, overlap=20)
    assert _ids(spark, []) == {}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab'sl 1\n\t.é日", max_size=300), min_size=1, max_size=4))
def test_chunks_equal_the_whole(spark, texts):
    assert _ids(spark, texts, chunk_chars=60, overlap=20) == _want(texts)
    path = tokens.vocabulary_path()
    assert all(tokens.decode(tokens.encode(t, path), path) == t.encode() for t in texts)
