"""Byte-level BPE: encode texts to ids and ids back to bytes.

Texts of at most ``chunk_chars`` characters are encoded where they are read. Longer ones are cut into
chunks that overlap the next by ``overlap`` characters; chunks are pre-tokenised in parallel, each from its
own start. Two neighbours are stitched at the first pre-token boundary they share inside the overlap: from
a shared boundary on both see the same characters, and the pattern never looks back, so both go on alike.
Each piece between two stitches is then encoded for itself. Where two neighbours share no boundary (a run
without any break), the document is cut again into chunks and overlaps four times as long, until it is whole.

NULL and empty texts have no ids. Every input row, also a repeated one, gives its own result. Only the
named columns are read, so further columns may have any names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F

from rollcall.session import fresh_dir

from .batches import bounded, numbered, small_batches
from .scratch import left_behind

CHUNK_CHARS = 32_768
OVERLAP = 256
#: A match that ends so many characters before the end of a chunk does not depend on what follows:
#: the longest look ahead is an apostrophe with two letters.
MARGIN = 4
WIDEN = 4


def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file: a base64 token and its rank on each line."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def boundaries(text: str, pattern: regex.Pattern) -> np.ndarray:
    """Where pre-tokens begin when reading from the start of ``text``, as far as what follows can't change it."""
    ends = np.fromiter((m.end() for m in pattern.finditer(text)), np.int64)
    return np.concatenate([[0], ends[ends <= len(text) - MARGIN]])


def _cut(chunk: int, overlap: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            for row, key, text in zip(*(batch.column(c) for c in ("row", "id", "text"))):
                text = text.as_py()
                count = -(-len(text) // chunk)
                for part in range(count):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row.as_py()], pa.int64()), key_array(key), pa.array([part], pa.int32()),
                        pa.array([count], pa.int32()),
                        pa.array([text[part * chunk: (part + 1) * chunk + overlap]], pa.string()),
                    ], names=["row", "id", "part", "parts", "text"])

    return cut


def key_array(key: pa.Scalar) -> pa.Array:
    return pa.array([key.as_py()], key.type)


def _pre_tokenised(pattern: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in bounded(batches, "text"):
            found = [boundaries(t, compiled) for t in batch.column("text").to_pylist()]
            head = [b[b <= overlap] for b in found]
            tail = [b[b >= chunk] - chunk for b in found]
            for name, values in (("head", head), ("tail", tail)):
                batch = batch.append_column(name, pa.array([v.tolist() for v in values], pa.list_(pa.int64())))
            yield batch

    return run


def _encode(ranks_path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(ranks_path, pattern)
        for batch in bounded(batches, "text"):
            ids = [bpe.encode_to_numpy(t or "", disallowed_special=()).astype("<u4").tobytes()
                   for t in batch.column("text").to_pylist()]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(ids, pa.binary())], names=[*names, "ids"])

    return run


def _decode(ranks_path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(ranks_path, pattern)
        for batch in bounded(batches, "ids"):
            texts = [None if ids is None else bpe.decode_bytes(np.frombuffer(ids, "<u4").tolist())
                     for ids in batch.column("ids").to_pylist()]
            yield batch.append_column("bytes", pa.array(texts, pa.binary()))

    return run


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, *, id_column: str = "doc_id", text_column: str = "text",
    chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP,
) -> DataFrame:
    """row, id, part, parts, ids: the ids of each piece of each text, as little-endian unsigned 32-bit integers.

    ``row`` tells input rows apart (those of long texts are negative), ``part`` orders the pieces of a long text; shorter texts have part 0 of 1.
    """
    return reduce(DataFrame.unionByName, _encoded(docs, ranks_path, pattern, id_column, text_column, chunk_chars, overlap))


def _encoded(docs: DataFrame, ranks_path: str, pattern: str, id_column: str, text_column: str, chunk_chars: int,
             overlap: int) -> list[DataFrame]:
    """The encoded short texts, and the encoded pieces of the long ones."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"),
                       F.col(text_column).alias("text"))
    kind = _kind(rows, "id")
    long = F.coalesce(F.length("text"), F.lit(0)) > chunk_chars
    short = rows.where(~long).selectExpr("row", "id", "0 AS part", "1 AS parts", "text")
    long_rows = numbered(rows.where(long).drop("row"), "long-texts").withColumn("row", -1 - F.col("row")).select("row", "id", "text")
    pieces = long_pieces(long_rows, kind, pattern, chunk_chars, overlap)
    return [side.mapInArrow(_encode(ranks_path, pattern), f"row long, id {kind}, part int, parts int, ids binary")
            for side in (short, pieces)]


def long_pieces(rows: DataFrame, kind: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """row, id, part, parts, text: pieces of the long texts of ``rows`` that can be encoded one by one."""
    spark, done = rows.sparkSession, []
    in_doc = Window.partitionBy("row").orderBy("part")
    while True:
        schema = f"row long, id {kind}, part int, parts int, text string"
        cut = rows.mapInArrow(_cut(chunk, overlap), schema).repartition("row", "part")
        seen = cut.mapInArrow(_pre_tokenised(pattern, chunk, overlap), f"{schema}, head array<long>, tail array<long>")
        shared = F.array_min(F.array_intersect("head", F.lag("tail").over(in_doc)))
        begun = seen.withColumn("begin", F.when(F.col("part") == 0, F.lit(0)).otherwise(shared))
        stitched = begun.withColumn("end", F.lead("begin").over(in_doc) + F.lit(chunk)).withColumn(
            "apart", F.max(F.col("begin").isNull()).over(Window.partitionBy("row"))).drop("head", "tail")
        path = fresh_dir(spark, "bpe-pieces")
        left_behind(spark, path)
        stitched.write.parquet(path)
        stitched = spark.read.parquet(path)
        done.append(stitched.where("NOT apart").selectExpr(
            "row", "id", "part", "parts",
            f"substring(text, CAST(begin AS int) + 1, CAST(coalesce(end, {chunk + overlap}) - begin AS int)) AS text"))
        apart = stitched.where("apart").select("row").distinct()
        if apart.isEmpty():
            return reduce(DataFrame.unionByName, done)
        rows = rows.join(apart, "row", "left_semi")
        chunk, overlap = chunk * WIDEN, overlap * WIDEN


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``encoded`` with the bytes of its ids, joined token by token, in a column ``bytes``."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(_decode(ranks_path, pattern), f"{schema}, bytes binary")


def digests(
    docs: DataFrame, ranks_path: str, pattern: str, *, id_column: str = "doc_id", text_column: str = "text",
    chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row of ``docs``, after encoding and decoding.

    Only long texts move: their pieces are brought in order and hashed one after the other.
    """
    short, long = (decode(side, ranks_path, pattern) for side in _encoded(
        docs, ranks_path, pattern, id_column, text_column, chunk_chars, overlap))
    whole = short.select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                         F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
    ordered = long.repartition("row").sortWithinPartitions("row", "part")
    schema = f"doc_id {_kind(long, 'id')}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return whole.unionByName(ordered.mapInArrow(_hash_in_order, schema))


def _hash_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        for key, part, parts, ids, text in zip(*(batch.column(c) for c in ("id", "part", "parts", "ids", "bytes"))):
            if part.as_py() == 0:
                tokens, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
            tokens += len(ids.as_buffer()) // 4
            of_ids.update(ids.as_buffer())
            of_bytes.update(text.as_buffer())
            if part.as_py() == parts.as_py() - 1:
                yield pa.RecordBatch.from_arrays(
                    [key_array(key), pa.array([tokens], pa.int64()), pa.array([of_ids.hexdigest()]),
                     pa.array([of_bytes.hexdigest()])],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
