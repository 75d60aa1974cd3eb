"""Which words of training documents also stand in benchmark items.

The index is positional and lies in the shared folder: each row is a segment of some megabytes of documents
with, for every term, the sorted list of its word positions. Terms are 64-bit word hashes. A window of an
item is found by taking the list of its rarest term in a segment and intersecting it with the lists of the
next rarest ones, each adjusted by its offset in the window; this is the exact phrase. With ``slop`` (proximity
matches) there has to be a place in the document, which may reach over its ends, such that each term of a window laid
there stands at most that many words off its own; a word of the document is taken for one term only, the first that
fits. The words taken, at each such place, are the hit ones.

The benchmark is read in blocks of a bounded number of words; each block is sent to the tasks, which read
the index. If its vocabulary is small enough to be sent as well, only postings of its terms are stored.

NULL and empty texts have no words. An item of fewer words than a window is one window; an item without words
has none. Repeated documents are found each for itself, repeated items count with the ids they have. Rows with NULL
ids keep them. Without any item no word is hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rollcall.session import fresh_dir

from .batches import bounded, numbered, raw, small_batches
from .scratch import left_behind
from .words import LETTERS_DIGITS, LOWER, Hasher, of_text

WINDOW = 10
#: Benchmark words that are sent to the tasks at once, and terms up to which the index is limited to them.
BLOCK_WORDS = 1_000_000
VOCABULARY = 1_000_000


def hasher() -> Hasher:
    return Hasher(LETTERS_DIGITS, LOWER)


def item_words(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """item, words: the term hashes of each item that has any, little-endian."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_words = hasher()
        for batch in bounded(batches, "text"):
            found = hash_words.find(*raw(batch.column("text")))
            parts = np.split(found.hashes, np.cumsum(found.counts)[:-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), pa.array([p.astype("<u8").tobytes() for p in parts], pa.binary())],
                names=["item", "words"])

    rows = items.select(F.col(id_column).alias("item"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, f"item {rows.schema['item'].dataType.simpleString()}, words binary").where(
        "octet_length(words) > 0")


def index(docs: DataFrame, terms: np.ndarray | None, *, id_column: str = "doc_id", text_column: str = "text",
          row_column: str | None = None) -> DataFrame:
    """The stored index: segment, rows, ids, counts (words of each document), terms, ends, gaps (of positions).

    ``terms`` are the sorted terms to keep postings of; None keeps all. Without ``row_column`` rows are numbered here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_words = hasher()
        for batch in bounded(batches, "text"):
            found = hash_words.find(*raw(batch.column("text")))
            position = np.arange(len(found.hashes))
            if terms is None:
                own, term = np.unique(found.hashes, return_inverse=True)
            elif len(terms):
                term = np.minimum(np.searchsorted(terms, found.hashes), len(terms) - 1)
                position = position[terms[term] == found.hashes]
                own, term = terms, term[position]
            else:
                own, position, term = terms, position[:0], position[:0]
            order = np.argsort(term, kind="stable")
            sizes = np.bincount(term, minlength=len(own))
            gaps = np.diff(position[order], prepend=0).astype("<i4")
            yield pa.RecordBatch.from_arrays([
                pa.array([batch.column("row").to_pylist()], pa.list_(pa.int64())),
                pa.array([batch.column("id").to_pylist()], pa.list_(batch.column("id").type)),
                *(pa.array([x.tobytes()], pa.binary()) for x in (
                    found.counts.astype("<i8"), own[sizes > 0].astype("<u8"),
                    np.cumsum(sizes[sizes > 0]).astype("<i8"), gaps)),
            ], names=["rows", "ids", "counts", "terms", "ends", "gaps"])

    number = F.col(row_column) if row_column else F.monotonically_increasing_id()
    rows = docs.select(number.alias("row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    path = fresh_dir(docs.sparkSession, "postings")
    left_behind(docs.sparkSession, path)
    rows.mapInArrow(run, f"rows array<bigint>, ids array<{kind}>, counts binary, terms binary, ends binary, gaps binary").withColumn(
        "segment", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


class Segment:
    """The postings of one index row."""

    def __init__(self, counts: bytes, terms: bytes, ends: bytes, gaps: bytes) -> None:
        self.counts, self.terms = np.frombuffer(counts, "<i8"), np.frombuffer(terms, "<u8")
        self.ends = np.concatenate([[0], np.frombuffer(ends, "<i8")])
        self.positions = np.cumsum(np.frombuffer(gaps, "<i4"), dtype=np.int64)
        self.doc = of_text(self.counts)

    def rows_of(self, words: np.ndarray) -> np.ndarray:
        """The number of each word's list, -1 where the segment has none."""
        if not len(self.terms):
            return np.full(words.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return np.where(self.terms[at] == words, at, -1)

    def phrase(self, lists: np.ndarray) -> np.ndarray:
        """Where the words with these lists stand one after the other inside one document."""
        sizes = self.ends[lists + 1] - self.ends[lists]
        begins = None
        for offset in np.argsort(sizes, kind="stable"):
            own = self.positions[self.ends[lists[offset]]: self.ends[lists[offset] + 1]]
            if begins is None:
                begins = own - offset
                begins = begins[(begins >= 0) & (begins + len(lists) <= len(self.doc))]
                begins = begins[self.doc[begins] == self.doc[begins + len(lists) - 1]]
            else:
                nearest = np.searchsorted(own, begins + offset)
                there = own[np.minimum(nearest, len(own) - 1)]
                begins = begins[(nearest < len(own)) & (there == begins + offset)]
            if not len(begins):
                break
        return begins

    def near(self, lists: np.ndarray, slop: int) -> np.ndarray:
        """Positions of the words with these lists at each place where all stand at most ``slop`` words off, inside one document."""
        of = [self.positions[self.ends[at]: self.ends[at + 1]] for at in lists]
        rarest = int(np.argmin([len(own) for own in of]))
        places = of[rarest][:, None] - rarest + np.arange(-slop, slop + 1)
        begin, doc = np.unique(np.stack([places.ravel(), np.repeat(self.doc[of[rarest]], 2 * slop + 1)]), axis=1)
        upto = np.cumsum(self.counts)[doc]
        first, good, found = upto - self.counts[doc], np.ones(len(begin), bool), []
        free: dict[int, np.ndarray] = {}  # behind what earlier terms of the same word have taken
        for offset, (at, own) in enumerate(zip(lists.tolist(), of)):
            next_ = np.searchsorted(own, np.maximum(free.get(at, first), begin + offset - slop))
            there = own[np.minimum(next_, len(own) - 1)]
            good &= (next_ < len(own)) & (there <= begin + offset + slop) & (there < upto)
            free[at] = there + 1
            found.append(there)
        return np.stack(found, -1)[good]


def _search(block: pa.Table, window: int, slop: int):
    """Documents of a segment with hits: segment, at, spans of hit words, items."""
    texts = [np.frombuffer(w.as_buffer(), "<u8") for w in block.column("words").combine_chunks()]
    items: dict[bytes, set[int]] = {}
    for at, words in enumerate(texts):
        size = min(window, len(words))
        for begin in range(len(words) - size + 1):
            items.setdefault(words[begin: begin + size].tobytes(), set()).add(at)
    ids = block.column("item").combine_chunks()
    phrases = [(np.frombuffer(w, "<u8"), sorted(of)) for w, of in items.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_words = np.concatenate([w for w, _ in phrases]) if phrases else np.empty(0, np.uint64)
        cut = np.cumsum([0, *(len(w) for w, _ in phrases)])
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row["counts"], row["terms"], row["ends"], row["gaps"])
                lists = segment.rows_of(all_words)
                lacking = np.concatenate([[0], np.cumsum(lists < 0)])
                edges = np.zeros(len(segment.doc) + 1, np.int64)
                pairs = []
                for at in np.flatnonzero(lacking[cut[1:]] == lacking[cut[:-1]]):
                    own = lists[cut[at]: cut[at + 1]]
                    taken = segment.near(own, slop) if slop else None
                    begins = segment.phrase(own) if taken is None else taken[:, 0]
                    if len(begins):
                        np.add.at(edges, begins if taken is None else taken, 1)
                        np.add.at(edges, begins + len(own) if taken is None else taken + 1, -1)
                        of = np.array(phrases[at][1])
                        pairs.append(np.stack(np.broadcast_arrays(np.unique(segment.doc[begins])[:, None], of), -1).reshape(-1, 2))
                if pairs:
                    yield _hits(row["segment"], segment, np.cumsum(edges)[:-1] > 0, np.unique(np.concatenate(pairs), axis=0), ids)

    return run


def _hits(name: int, segment: Segment, hit: np.ndarray, pairs: np.ndarray, ids: pa.Array) -> pa.RecordBatch:
    first_word = np.cumsum(segment.counts) - segment.counts
    docs = np.unique(pairs[:, 0])
    spans = []
    for doc in docs:
        own = np.concatenate([[0], hit[first_word[doc]: first_word[doc] + segment.counts[doc]], [0]])
        edges = np.flatnonzero(np.diff(own))
        spans.append([{"begin": b, "end": e} for b, e in edges.reshape(-1, 2).tolist()])
    items = pa.ListArray.from_arrays(pa.array(np.searchsorted(pairs[:, 0], np.append(docs, docs[-1] + 1)), pa.int32()),
                                     ids.take(pa.array(pairs[:, 1])))
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(docs), name), pa.int64()), pa.array(docs, pa.int32()),
        pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), items,
    ], names=["segment", "at", "spans", "items"])


def matches(
    docs: DataFrame, items: DataFrame, *, window: int = WINDOW, slop: int = 0, id_column: str = "doc_id",
    text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
    block_words: int = BLOCK_WORDS, vocabulary: int = VOCABULARY, row_column: str | None = None,
) -> DataFrame:
    """row, id, n_words, n_hit, spans (of hit words), items (with a window in the document) for each document.

    ``row`` is the document's ``row_column``, or a number that it gets in the stored index.
    """
    small_batches(docs.sparkSession)
    path = fresh_dir(docs.sparkSession, "benchmark-words")
    left_behind(docs.sparkSession, path)
    item_words(items, item_column, item_text).write.parquet(path)
    wanted = docs.sparkSession.read.parquet(path)
    total = wanted.agg(F.coalesce(F.sum(F.octet_length("words")) / 8, F.lit(0)).cast("long")).first()[0]
    terms = _vocabulary(wanted, vocabulary)
    postings = index(docs, terms, id_column=id_column, text_column=text_column, row_column=row_column)
    kind = wanted.schema["item"].dataType.simpleString()
    blocks = max(1, -(-total // block_words))
    found = []
    for block in range(blocks):
        part = wanted.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block).distinct().toArrow()
        found.append(postings.mapInArrow(
            _search(part, window, slop),
            f"segment long, at int, spans array<struct<begin: long, end: long>>, items array<{kind}>"))
    hits = reduce(DataFrame.unionByName, found).groupBy("segment", "at").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(F.greatest(a.upto, x.end).alias("upto"),
                              (a.n + F.greatest(F.lit(0), x.end - F.greatest(a.upto, x.begin))).alias("n")), lambda a: a.n)
    return _documents(postings).join(hits, ["segment", "at"], "left").select(
        "row", "id", "n_words", F.coalesce(covered, F.lit(0)).alias("n_hit"), "spans",
        F.coalesce("items", F.array().cast(f"array<{kind}>")).alias("items"))


def _vocabulary(wanted: DataFrame, most: int) -> np.ndarray | None:
    """The sorted terms of all items, or None if there are more than ``most``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = np.unique(np.frombuffer(raw(batch.column("words"))[0], "<u8"))
            yield pa.RecordBatch.from_arrays([pa.array(terms.view("<i8"))], names=["term"])

    terms = wanted.select("words").mapInArrow(run, "term long").distinct().limit(most + 1).toArrow()
    if terms.num_rows > most:
        return None
    return np.sort(terms.column("term").to_numpy().view(np.uint64))


def _documents(postings: DataFrame) -> DataFrame:
    """segment, at, row, id, n_words of each document of the index."""
    kind = postings.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, rows, ids, counts in zip(*(batch.column(c) for c in ("segment", "rows", "ids", "counts"))):
                words = np.frombuffer(counts.as_buffer(), "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(words), segment.as_py()), pa.int64()),
                     pa.array(np.arange(len(words)), pa.int32()), rows.values, ids.values, pa.array(words, pa.int64())],
                    names=["segment", "at", "row", "id", "n_words"])

    return postings.select("segment", "rows", "ids", "counts").mapInArrow(
        run, f"segment long, at int, row long, id {kind}, n_words long")


def without_matches(docs: DataFrame, items: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no item has a window."""
    given = numbered(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")), "rows")
    doc = F.col("doc").getField
    texts = given.select("row", doc(id_column).alias("id"), doc(text_column).alias("text"))
    hit = matches(texts, items, id_column="id", text_column="text", row_column="row", **options).where("n_hit > 0").select("row")
    return given.join(hit, "row", "left_anti").select("doc.*")
