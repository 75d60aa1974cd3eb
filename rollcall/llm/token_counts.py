"""Token counts of whole texts, as a tokenizer file of the tokenizers library gives them.

Documents of more than ``chunk_chars`` characters are encoded in chunks that overlap the next, with the offsets
of the tokens. Two neighbours are spliced at the first common boundary inside the overlap that is proven stable: a
token that begins after white space. The tokenizer drops white space and no normalisation, special token
or merge reaches over it, so both chunks have the same tokens from there on. Where an overlap has no such
boundary, the document is encoded again with chunks and overlaps four times as long, until it is whole.

Shorter documents are counted where they are read. The same reasoning cuts them into units, at white space and
between an ASCII letter or digit and ASCII punctuation (but for the apostrophe): each distinct unit is
encoded once in a task, with ASCII letters in lower case as the tokenizer has them. Texts with the string
of a special token are encoded whole, for such a string is one token.

NULL and empty texts have no tokens. Repeated rows are counted each for itself; NULL ids stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from rollcall.session import fresh_dir

from .batches import bounded, numbered, raw, small_batches
from .bpe import _cut
from .scratch import left_behind
from .words import LOWER, Hasher, of_text

CHUNK_CHARS = 65_536
OVERLAP = 512
WIDEN = 4
#: Kind of each byte: white space, letter or digit, punctuation, and what is never cut off from its neighbours.
SPACE, WORD, MARK, GLUE = range(4)
_KIND = np.full(256, GLUE)
_KIND[list(b" \t\n\r\x0b\x0c")] = SPACE
_KIND[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = WORD
_KIND[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = MARK


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begins, ends, units of each text) of stretches that are tokenized one by one."""
    kind = _KIND[data]
    before = np.concatenate([[SPACE], kind[:-1]])[: len(kind)]
    begins = (kind != SPACE) & ((before == SPACE) | ((kind == WORD) & (before == MARK)) | ((kind == MARK) & (before == WORD)))
    filled = offsets[:-1][np.diff(offsets) > 0]
    begins[filled] |= kind[filled] != SPACE
    starts = np.flatnonzero(begins)
    # A unit ends where the next begins or where white space follows.
    spaces = np.flatnonzero(kind == SPACE)
    next_space = np.append(spaces, len(data))[np.searchsorted(spaces, starts)]
    ends = np.minimum(np.append(starts[1:], len(data))[: len(starts)], next_space)
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


class Counter:
    """Counts tokens of many texts; each distinct unit is encoded once."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._hasher = Hasher(np.ones(256, bool), LOWER)
        self._known, self._counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: pa.Array) -> np.ndarray:
        data, offsets = raw(texts)
        starts, ends, per_text = units(data, offsets)
        hashes, first, which = np.unique(self._hasher.hashes(data, starts, ends), return_index=True, return_inverse=True)
        new = np.flatnonzero(~np.isin(hashes, self._known))
        buffer = data.tobytes()
        found = self.whole([buffer[starts[f]: ends[f]].decode() for f in first[new]])
        at = np.searchsorted(self._known, hashes[new])
        self._known, self._counts = np.insert(self._known, at, hashes[new]), np.insert(self._counts, at, found)
        each = self._counts[np.searchsorted(self._known, hashes)][which]
        total = np.bincount(of_text(per_text), each, len(texts)).astype(np.int64)
        if any(s.encode() in buffer for s in self.special):
            odd = [i for i, t in enumerate(texts.to_pylist()) if t and any(s in t for s in self.special)]
            total[odd] = self.whole([texts[i].as_py() for i in odd])
        return total


def _short(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in bounded(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(counter.count(batch.column("text")))],
                names=["id", "n_bytes", "n_tokens"])

    return run


def stable(text: str, offsets: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(places, tokens before each) where a token begins after white space, from reading ``text`` alone."""
    begins = np.array([o[0] for o in offsets], np.int64)
    after = np.array([b == 0 or text[b - 1] in " \t\n\r\x0b\x0c" for b in begins], bool)
    places, count = np.unique(begins[after], return_index=True)
    return places, np.flatnonzero(after)[count]


def _encoded(path: str, chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.from_file(path)
        for batch in bounded(batches, "text"):
            for row, part, parts, text in zip(*(batch.column(c) for c in ("row", "part", "parts", "text"))):
                offsets = tokenizer.encode(text.as_py(), add_special_tokens=False).offsets
                places, before = stable(text.as_py(), offsets)
                head, tail = places <= overlap, places >= chunk
                lists = (places[head], before[head], places[tail] - chunk, before[tail])
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([s.as_py()], s.type) for s in (row, part, parts)), pa.array([len(offsets)], pa.int64()),
                     *(pa.array([x.tolist()], pa.list_(pa.int64())) for x in lists)],
                    names=["row", "part", "parts", "tokens", "head", "head_tokens", "tail", "tail_tokens"])

    return run


def _long(rows: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """row, n_tokens of the long texts of ``rows``."""
    spark, done = rows.sparkSession, []
    kind = rows.schema["id"].dataType.simpleString()
    in_doc = Window.partitionBy("row").orderBy("part")
    while True:
        cut = rows.mapInArrow(_cut(chunk, overlap), f"row long, id {kind}, part int, parts int, text string")
        encoded = cut.repartition("row", "part").mapInArrow(
            _encoded(path, chunk, overlap), "row long, part int, parts int, tokens long, head array<long>, "
            "head_tokens array<long>, tail array<long>, tail_tokens array<long>")
        shared = F.array_min(F.array_intersect("head", F.lag("tail").over(in_doc)))
        spliced = encoded.withColumn("begin", F.when(F.col("part") > 0, shared)).withColumn("end", F.lead("begin").over(in_doc))
        first = F.when(F.col("part") == 0, F.lit(0)).otherwise(F.map_from_arrays("head", "head_tokens")[F.col("begin")])
        last = F.when(F.col("part") == F.col("parts") - 1, F.col("tokens")).otherwise(
            F.map_from_arrays("tail", "tail_tokens")[F.col("end")])
        target = fresh_dir(spark, "token-splices")
        left_behind(spark, target)
        spliced.groupBy("row").agg(F.sum(last - first).alias("n_tokens"), F.max((last - first).isNull()).alias("apart")
                                   ).write.parquet(target)
        counted = spark.read.parquet(target)
        done.append(counted.where("NOT apart").select("row", "n_tokens"))
        apart = counted.where("apart").select("row")
        if apart.isEmpty():
            return reduce(DataFrame.unionByName, done)
        rows = rows.join(apart, "row", "left_semi")
        chunk, overlap = chunk * WIDEN, overlap * WIDEN


def count(
    docs: DataFrame, tokenizer_path: str, *, id_column: str = "doc_id", text_column: str = "text",
    chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP,
) -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens of each row."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    is_long = F.coalesce(F.length("text"), F.lit(0)) > chunk_chars
    short = rows.where(~is_long).select("id", "n_bytes", "text").mapInArrow(
        _short(tokenizer_path), f"id {kind}, n_bytes long, n_tokens long")
    long = numbered(rows.where(is_long), "long-texts")
    counted = _long(long.select("row", "id", "text"), tokenizer_path, chunk_chars, overlap)
    return short.unionByName(long.select("row", "id", "n_bytes").join(counted, "row").drop("row"))
