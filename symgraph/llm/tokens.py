"""Encoding of whole texts with a public tokenizer, in overlapping chunks.

A text longer than ``chunk_chars`` is cut into chunks that overlap. Every chunk is split into
pre-tokens by itself, in parallel. A chunk starts and ends anywhere, so its first and last
pre-tokens may be wrong; but splitting has no memory, so from the first boundary that two
neighbouring chunks share inside their overlap, the later chunk agrees with the whole text.
(Boundaries behind white space are left out, since white space is split by what follows.)
Text is cut at such shared boundaries, each piece is encoded by itself, and the ids of the
pieces are joined in order. Where two chunks share no boundary (a run of one kind of
character longer than the overlap) the pieces on both sides are joined and encoded as one,
so the result is always that of the whole text. Shorter texts are encoded in place, without
a shuffle. Decoding joins the raw bytes of the ids.

Defined results: null and empty texts have the empty list. Strings that look like special
tokens are ordinary text. Rows with a null id are kept; a repeated id is encoded per row.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

#: The pattern that splits text before the merges, as published with the vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters at the end of a chunk in which a boundary may still be wrong: the longest contraction.
MARGIN = 4
CHUNK_CHARS = 2048
OVERLAP_CHARS = 256


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where the installed tokenizer files lie; a parameter of every operator here."""
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return os.path.join("/opt/tokenizers", name)


@lru_cache(maxsize=4)
def encoder(path: str):
    """The encoder of a rank file, once per Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str | None, path: str) -> list[int]:
    return encoder(path).encode_ordinary(text) if text else []


def decode(ids: list[int], path: str) -> bytes:
    """The raw bytes of the ids; joined pieces give the bytes of the text."""
    return encoder(path).decode_bytes(ids)


def _encode_batches(path: str, keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(path).encode_ordinary
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                ids = pa.array([one(t) if t else [] for t in part.column(keep).to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(keep)), ids], [*part.schema.names[:keep], "ids"])

    return run


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk (key, no, start, head, tail, chunk): the boundaries in its head and in its tail, as places in the text."""
    import regex

    split = regex.compile(PATTERN)
    for batch in batches:
        heads, tails = [], []
        for start, head, tail, text in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
            # never behind white space: how it is split depends on what follows
            ends = [e for e in (m.end() for m in split.finditer(text)) if not text[e - 1].isspace()]
            heads.append([start + e for e in ends if e <= head])
            tails.append([start + e for e in ends if len(text) - tail <= e <= len(text) - MARGIN])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))], ["key", "no", "head", "tail"])


def pieces(texts: DataFrame, chunk_chars: int, overlap: int) -> DataFrame:
    """(key, piece, text) of distinct long texts (key, text), cut where neighbouring chunks share a boundary.

    Where two chunks share none there is no cut, and only what lies on both sides up to the next
    cuts is one piece. The chunk behind is right again before its own end, if it has a boundary there
    at all: wherever it starts, a run of letters, of numbers or of other signs ends for it where it
    ends for the whole text.
    """
    step = chunk_chars - overlap
    last = F.greatest(F.lit(0), F.ceil((F.char_length("text") - overlap) / F.lit(step)).cast("int") - 1)
    start = (F.col("no") * step).cast("int")
    chunks = texts.select("key", "text", F.explode(F.sequence(F.lit(0), last)).alias("no"))
    chunks = chunks.select("key", "no", start.alias("start"), F.when(F.col("no") == 0, 0).otherwise(overlap).alias("h"), F.lit(overlap).alias("l"), F.substring("text", start + 1, F.lit(chunk_chars)).alias("chunk"))
    edges = chunks.repartition("key", "no").mapInArrow(_edges, "key binary, no int, head array<int>, tail array<int>")
    shared = edges.withColumn("at", F.array_min(F.array_intersect("head", F.lag("tail").over(W.partitionBy("key").orderBy("no")))))
    cuts = shared.groupBy("key").agg(F.concat(F.array(F.lit(0)), F.sort_array(F.collect_list("at"))).alias("starts"))  # an int per chunk; seams without a boundary are null and fall out
    placed = texts.join(cuts, "key").select("key", "text", "starts", F.posexplode("starts").alias("piece", "at"))
    end = F.coalesce(F.get("starts", F.col("piece") + 1), F.char_length("text"))
    return placed.select("key", "piece", F.substring("text", F.col("at") + 1, end - F.col("at")).alias("text"))


def encode_column(df: DataFrame, keep: list[str], text: str, path: str | None = None, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """keep columns and ids (array<int>) of every row. Long texts are encoded once however often they repeat."""
    if overlap <= 2 * MARGIN or chunk_chars <= 2 * overlap:
        raise ValueError("chunks must be longer than two overlaps, and overlaps than the margin")
    path = path or vocabulary_path()
    names = [f"k{i}" for i in range(len(keep))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keep, names)], F.col(text).alias("text"))
    kinds = "".join(f"{n} {rows.schema[n].dataType.simpleString()}, " for n in names)
    is_long = F.coalesce(F.char_length("text") > chunk_chars, F.lit(False))
    short = rows.filter(~is_long).mapInArrow(_encode_batches(path, len(keep)), f"{kinds}ids array<int>")
    long = rows.filter(is_long).withColumn("key", F.unhex(F.sha2("text", 256)))
    cut_up = pieces(long.select("key", "text").dropDuplicates(["key"]), chunk_chars, overlap)
    encoded = cut_up.repartition("key", "piece").mapInArrow(_encode_batches(path, 2), "key binary, piece int, ids array<int>")
    joined = encoded.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("p")).select("key", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))
    both = short.unionByName(long.select(*names, "key").join(joined, "key").select(*names, "ids"))
    return both.select(*[F.col(n).alias(k) for n, k in zip(names, keep)], "ids")
