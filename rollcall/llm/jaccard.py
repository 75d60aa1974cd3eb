"""N-gram Jaccard join: classes of documents whose shingle sets are linked by a similarity of ``percent`` or more.

Size-aware, heavy and light. Two sets of n and m shingles link if they share at least c(n, m). Light sets (few
shingles) are joined by enumerating all their subsets of exactly c shingles: two sets link if and only if they have such
a subset in common. Heavy sets are joined by scanning inverted lists. The boundary is the largest size for which
enumerating costs no more than scanning, given how long the lists are on average.

Lists are kept for the first shingles of a set only, in an order from rare to frequent that comes from counts of hashed
shingles in a table of fixed size: a linked pair shares one of them, early enough in both sets. Sets are merged before
pairs are looked at: equal sets are one set; then each set is compared with the most central set of its lists. What is
linked by then needs no further pair, and only pairs of sets in different classes are compared. Each set has a sketch, a
bit for each residue of its hashes that says whether an odd number of them has it: two sketches differ in no more bits than
their sets differ in shingles, so that pairs whose sketches differ in too many are dropped without their texts. Links are
decided on the whole texts, and classes are the connected components of links.

ASCII letters are folded to lower case, words are runs of anything but ASCII white space, and shingles are 64-bit hashes.
A text with fewer words than a shingle has its whole sequence as its one shingle; NULL, empty and blank texts have
none and are a class of their own each. Repeated rows are linked to each other. A row with a NULL id has a place in
its class, which takes the smallest id that is not NULL. The input is read once and stored with a number for each row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .batches import bounded, raw, small_batches
from .bitmap import bit, bitmap
from .components import components
from .scratch import Scratch
from .words import LOWER, NOT_SPACE, Hasher, inside_text, mixed, of_text, windows

SHINGLE, PERCENT = 4, 85
#: Hashed shingles are counted in so many cells, which are sent around in so many slices.
CELLS, SLICES = 1 << 20, 64
#: Candidates that one task compares with one set.
PER_PART = 500
#: Enumerating more subsets of a set than this is dearer than any lists.
MOST_SUBSETS = 150


#: Made once in each task: functions travel with the plan, so nothing is kept in a module of the workers.
_made: list[Hasher] = []


def hasher() -> Hasher:
    if not _made:
        _made.append(Hasher(NOT_SPACE, LOWER))
    return _made[0]


def shared(n: int, m: int, percent: int) -> int:
    """How many shingles sets of n and m have in common at least if they link."""
    return -(-percent * (n + m) // (100 + percent))


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of each text."""
    words = hasher().find(*raw(texts))
    at = inside_text(words.counts, size)
    text, value = of_text(words.counts)[at], windows(words.hashes, size)[at] if len(at) else np.empty(0, np.uint64)
    first = np.cumsum(words.counts) - words.counts
    for n in range(1, size):  # short texts: the whole sequence
        own = np.flatnonzero(words.counts == n)
        if len(own):
            text = np.concatenate([text, own])
            value = np.concatenate([value, mixed(windows(words.hashes, n)[first[own]] + np.uint64(n))])
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]


def sketches(text: np.ndarray, value: np.ndarray, n: np.ndarray) -> pa.Array:
    """The parities of the hashes of each set by their lowest bits, in a power of two of bits, as many as it has shingles at least."""
    width = np.where(n > 0, 1 << np.ceil(np.log2(np.maximum(n, 64))).astype(np.int64), 0)
    ends = np.cumsum(width)
    at = (ends - width)[text] + (value.view(np.int64) & (width[text] - 1))
    odd = np.packbits(np.bincount(at, minlength=int(width.sum())) & 1, bitorder="little")
    offsets = np.concatenate([np.zeros(1, np.int64), ends // 8]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(odd)])


def _described(size: int):
    """For each row the size, a 128-bit name and the sketch of its set; at the end of the task the counts of hashed shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        for batch in bounded(batches, "text"):
            text, value = shingles(batch.column("text"), size)
            cells += np.bincount((value % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
            names = []
            for salt in (1, 2):
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(value ^ mixed(np.array([salt], np.uint64))))])
                edges = np.searchsorted(text, np.arange(batch.num_rows + 1))
                names.append(pa.array((sums[edges[1:]] - sums[edges[:-1]]).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(np.diff(edges), pa.int64()), *names,
                 sketches(text, value, np.diff(edges)), pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())],
                names=["row", "id", "n", "name_a", "name_b", "sketch", "slice", "cells"])
        parts = [p.astype("<i8").tobytes() for p in np.split(cells, SLICES)]
        nothing = [pa.nulls(SLICES, pa.int64()) for _ in range(5)]
        yield pa.RecordBatch.from_arrays(
            [*nothing, pa.nulls(SLICES, pa.binary()), pa.array(np.arange(SLICES), pa.int32()), pa.array(parts, pa.binary())],
            names=["row", "id", "n", "name_a", "name_b", "sketch", "slice", "cells"])

    return run


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, "<i8") for c in table.column("cells").to_pylist())
    return pa.table({"slice": table.column("slice")[:1], "cells": pa.array([total.astype("<i8").tobytes()], pa.binary())})


def partners(n: int, percent: int) -> range:
    """Sizes of sets that a set of n shingles can link with."""
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def boundary(list_length: float, percent: int) -> int:
    """The largest size at which enumerating subsets costs no more than scanning lists of this mean length."""
    size = 1
    while True:
        n = size + 1
        subsets = sum(comb(n, shared(n, m, percent)) for m in partners(n, percent))
        scanned = prefix(n, percent) * list_length
        if n > 6 and (subsets > MOST_SUBSETS or subsets > 8 * max(scanned, len(partners(n, percent)))):
            return size
        size = n


def prefix(n, percent: int):
    """How many of its first shingles a set of n keeps in lists."""
    return n - -(-percent * n // 100) + 1


def _listed(size: int, percent: int, cells: np.ndarray, light: int, wanted: np.ndarray):
    """For each wanted row: its first shingles in order of frequency, and the subsets of light sets."""
    sizes = range(-(-percent * (light + 1) // 100), light + 1)  # light sets that may link with heavy ones

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = (b.filter(pa.array(wanted[b.column("bit").to_numpy()])) for b in batches)
        for batch in bounded(chosen, "text"):
            text, value = shingles(batch.column("text"), size)
            order = np.lexsort((value, cells[(value % np.uint64(CELLS)).astype(np.int64)], text))
            text, value = text[order], value[order]
            edges = np.searchsorted(text, np.arange(batch.num_rows + 1))
            n = np.diff(edges)
            place = np.arange(len(text)) - edges[text]
            wide = (n > light) | np.isin(n, list(sizes))
            keep = (place < prefix(n, percent)[text]) & wide[text]
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.bincount(text[keep], minlength=batch.num_rows))]), pa.int32()),
                pa.array(value[keep].view(np.int64)))
            subsets = [_subsets(value[edges[i]: edges[i + 1]], light, percent) if 1 < n[i] <= light else []
                       for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n, pa.int64()), lists, pa.array(subsets, pa.list_(pa.struct(
                    [("few", pa.int32()), ("many", pa.int32()), ("key", pa.int64())])))],
                names=["row", "n", "first", "subsets"])

    return run


def _subsets(values: np.ndarray, light: int, percent: int) -> list[dict]:
    """Sums of the hashes of each subset that decides a link with a light set of another or the same size."""
    n, hashed, found = len(values), [int(v) for v in mixed(values)], []
    for m in partners(n, percent):
        c = shared(n, m, percent)
        if m > light or c > min(n, m) or (n == m and c == n):
            continue
        total = sum(hashed)
        for left in combinations(hashed, n - c):
            key = (total - sum(left)) % 2 ** 64
            found.append({"few": min(n, m), "many": max(n, m), "key": key - 2 ** 64 if key >= 2 ** 63 else key})
    return found


def _light_links(listed: DataFrame) -> DataFrame:
    """Links of light sets: those of one size with the smallest of the other size that has the subset."""
    keyed = listed.select("row", "n", F.explode("subsets").alias("s")).select("row", "n", "s.few", "s.many", "s.key").distinct()
    ends = keyed.groupBy("few", "many", "key").agg(
        F.min(F.when(F.col("n") == F.col("few"), F.col("row"))).alias("low"),
        F.min(F.when(F.col("n") == F.col("many"), F.col("row"))).alias("high"), F.count("*").alias("members")).where(
        "members > 1 AND low IS NOT NULL AND high IS NOT NULL")
    met = keyed.join(ends, ["few", "many", "key"])
    return met.select(F.col("row").alias("a"), F.when(F.col("n") == F.col("few"), F.col("high")).otherwise(
        F.col("low")).alias("b")).where("a <> b").distinct()


def differing(one: list[bytes], other: list[bytes]) -> np.ndarray:
    """In how many bits sketches differ, pair by pair; the longer one of a pair is folded to the width of the other."""
    found = np.zeros(len(one), np.int64)
    sizes = np.array([[len(x), len(y)] for x, y in zip(one, other)]).reshape(-1, 2)
    for size in np.unique(sizes, axis=0):
        at, least = np.flatnonzero((sizes == size).all(axis=1)), int(size.min()) // 8
        x, y = (np.bitwise_xor.reduce(np.frombuffer(b"".join(side[i] for i in at), "<u8").reshape(len(at), -1, least), axis=1)
                for side in (one, other))
        found[at] = np.bitwise_count(x ^ y).sum(axis=1)
    return found


def _close(percent: int):
    """Of pairs with sizes and sketches those that may link: sets that do differ in few shingles, sketches in no more bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = differing(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist())
            both = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array(bits * (100 + percent) <= (100 - percent) * both))

    return run


def _verified(pairs: DataFrame, sketched: DataFrame, texts: DataFrame, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) that link. The texts of b travel to a; a set with many partners is dealt out with its text."""
    a, b = (sketched.select(*[F.col(c).alias(name) for c, name in (("row", s), ("n", f"n_{s}"), ("sketch", f"sketch_{s}"))]) for s in "ab")
    pairs = scratch.store(pairs.join(a, "a").join(b, "b").mapInArrow(_close(percent), "a long, b long"), "close-pairs")
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PER_PART).alias("parts"))
    dealt = scratch.store(pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part")), "pairs")
    scratch.drop(pairs)
    members = dealt.select("a", "part", F.col("b").alias("row")).union(
        dealt.select("a", "part", F.col("a").alias("row")).distinct())
    wanted = bitmap(members, "row")

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Compressed, for they are shuffled twice."""
        compressor = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            some = batch.filter(pa.array(wanted[batch.column("bit").to_numpy()]))
            texts = [compressor.compress(t.as_py().encode()) for t in some.column("text")]
            yield pa.RecordBatch.from_arrays([some.column("row"), pa.array(texts, pa.binary())], names=["row", "text"])

    def unpacked(texts: pa.Array) -> pa.Array:
        return pa.array([zstandard.ZstdDecompressor().decompress(t.as_py()) for t in texts], pa.binary())

    def compare(table: pa.Table) -> pa.Table:
        name, found = table.column("a")[0].as_py(), [np.empty(0, np.int64)]
        rows = table.column("row").to_numpy()
        _, own = shingles(unpacked(table.column("text").take([int(np.flatnonzero(rows == name)[0])]).combine_chunks()), size)
        for batch in bounded(iter(table.to_batches()), "text"):
            text, value = shingles(unpacked(batch.column("text")), size)
            sizes = np.bincount(text, minlength=batch.num_rows)
            common = np.bincount(text[np.isin(value, own)], minlength=batch.num_rows)
            rows = batch.column("row").to_numpy()
            found.append(rows[(common * (100 + percent) >= percent * (sizes + len(own))) & (rows != name)])
        linked = np.concatenate(found)
        return pa.table({"a": np.full(len(linked), name), "b": linked})

    some = texts.withColumn("bit", bit("row")).mapInArrow(needed, "row long, text binary")
    found = members.join(some, "row").groupBy("a", "part").applyInArrow(compare, "a long, b long")
    linked = scratch.store(found, "linked")
    scratch.drop(dealt)
    return linked


def links(rows: DataFrame, scratch: Scratch, size: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(described, classes): row, id, n and name of the set of each of ``rows`` (row, id, text); set and class of each name.

    Sets are called by their smallest row; classes by the smallest set that links reach. Both results read tables of ``scratch``.
    """
    small_batches(rows.sparkSession)
    described = scratch.store(rows.mapInArrow(
        _described(size), "row long, id long, n long, name_a long, name_b long, sketch binary, slice int, cells binary"), "sets")
    counted = described.where("cells IS NOT NULL").select("slice", "cells").groupBy("slice").applyInArrow(
        _summed, "slice int, cells binary").orderBy("slice").toArrow()
    cells = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(c, "<i8") for c in counted.column("cells").to_pylist())])
    cells = cells if len(cells) else np.zeros(CELLS, np.int64)
    mean = cells.mean()
    excess = np.maximum(1, cells - mean - 4 * np.sqrt(mean))
    light = boundary(float((cells * excess).sum() / max(1, cells.sum())), percent)
    order = np.minimum(cells, 2 ** 31 - 1).astype(np.int32)

    sketched = described.where("n > 0").select("row", "n", "sketch")
    described = described.where("row IS NOT NULL").drop("sketch", "slice", "cells")
    name = ["n", "name_a", "name_b"]
    sets = scratch.store(described.where("n > 0").groupBy(*name).agg(F.min("row").alias("set")), "distinct-sets")
    texts = rows.where("text IS NOT NULL").select("row", "text")
    # One row of each set. A copy that the bitmap lets through changes no class: it links to its like.
    listed = scratch.store(texts.withColumn("bit", bit("row")).mapInArrow(
        _listed(size, percent, order, light, bitmap(sets, "set")),
        "row long, n long, first array<long>, subsets array<struct<few: int, many: int, key: long>>"), "first-shingles")
    posted = listed.select("row", "n", F.posexplode("first").alias("place", "shingle"))
    several = posted.groupBy("shingle").agg(F.count("*").alias("members")).where("members > 1").select("shingle")
    posted = scratch.store(posted.join(several, "shingle"), "postings")

    # Each set with the most central set of its lists: the one in which the shingle stands first.
    step = float(np.log(100 / percent))
    sized = posted.withColumn("bucket", F.floor(F.log("n") / step))
    centres = sized.groupBy("shingle", "bucket").agg(F.min(F.struct("place", "row")).alias("centre")).select(
        "shingle", "bucket", F.col("centre.row").alias("a"))
    met = sized.join(centres, ["shingle", "bucket"]).where("a <> row").groupBy("row", "a").count()
    nearest = met.groupBy("row").agg(F.max(F.struct("count", -F.col("a"))).alias("best")).select(
        (-F.col("best.col2")).alias("a"), F.col("row").alias("b"))
    near = _verified(nearest, sketched, texts, size, percent, scratch)
    light_links = scratch.store(_light_links(listed), "light-links")
    scratch.drop(listed)
    first = components(light_links.union(near), scratch)
    scratch.drop(light_links, near)

    # Then the pairs of sets in different classes, from the lists in which both stand early enough to link.
    placed = scratch.store(posted.join(first.withColumnRenamed("node", "row"), "row", "left").select(
        "shingle", "row", "n", "place", F.coalesce("root", "row").alias("root")), "placed")
    scratch.drop(posted)
    open_lists = placed.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("shingle")
    stored_places = placed
    placed = placed.join(open_lists, "shingle")
    low, high = (placed.select("shingle", *[F.col(c).alias(f"{c}_{s}") for c in ("row", "n", "place", "root")]) for s in "ab")
    needed = F.ceil(F.lit(percent) * (F.col("n_a") + F.col("n_b")) / (100 + percent) - F.lit(1e-9))
    early = low.where(F.col("n_a") - F.col("place_a") >= F.ceil(F.lit(2 * percent) * F.col("n_a") / (100 + percent) - F.lit(1e-9)))
    pairs = early.join(high, "shingle").where(
        (F.col("root_a") != F.col("root_b")) & (F.col("n_a") * 100 >= F.col("n_b") * percent)
        & ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("row_a") < F.col("row_b"))))
        & (F.col("n_a") - F.col("place_a") >= needed) & (F.col("n_b") - F.col("place_b") >= needed))
    pairs = pairs.select(F.col("row_a").alias("a"), F.col("row_b").alias("b")).distinct()
    more = _verified(pairs, sketched, texts, size, percent, scratch)
    scratch.drop(stored_places)
    classes = components(first.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more), scratch)
    scratch.drop(first, more)
    return described, sets.join(classes.withColumnRenamed("node", "set"), "set", "left").select(
        *name, "set", F.coalesce("root", "set").alias("class"))


def join(docs: DataFrame, *, size: int = SHINGLE, percent: int = PERCENT, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """row, id, n, class, component of each row of ``docs``: the size of its set, its class and the smallest id there.

    ``row`` is a number of the row; classes are called by a row of theirs.
    """
    with Scratch(docs.sparkSession) as scratch:
        rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
        rows = scratch.store(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
        found = scratch.store(_joined(rows, scratch, size, percent), "classes")
        scratch.keep(found)
    return found


def _joined(rows: DataFrame, scratch: Scratch, size: int, percent: int) -> DataFrame:
    described, classes = links(rows, scratch, size, percent)
    name = ["n", "name_a", "name_b"]
    smallest = described.where("n > 0").groupBy(*name).agg(F.min("id").alias("id")).join(classes, name)
    of_class = smallest.groupBy("class").agg(F.min("id").alias("component"))
    named = classes.join(of_class, "class").select(*name, "class", "component")
    return described.join(named, name, "left").select(
        "row", "id", "n", F.coalesce("class", "row").alias("class"), F.coalesce("component", "id").alias("component"))


def one_of_each(docs: DataFrame, *, size: int = SHINGLE, percent: int = PERCENT, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their class; of repeated rows one, and all rows without words."""
    with Scratch(docs.sparkSession) as scratch:
        given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
        given = scratch.store(given.withColumn("row", F.monotonically_increasing_id()), "rows")
        doc = F.col("doc").getField
        rows = given.select("row", doc(id_column).cast("long").alias("id"), doc(text_column).alias("text"))
        # Spark broadcasts by the size of files, and packed numbers look far smaller than they are.
        found = scratch.store(_joined(rows, scratch, size, percent), "classes", compression="uncompressed")
        scratch.keep(given, found)
    # NULL ids come last.
    order = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    kept = found.groupBy("class").agg(F.min(order).alias("least")).select(F.col("least.row").alias("row"))
    return given.join(kept, "row").select("doc.*")
