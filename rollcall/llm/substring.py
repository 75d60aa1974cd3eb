"""Substring dedup: words that stand in a run of ``window`` words which also occurs in an earlier document.

Windows are grouped by super-k-mers. The minimiser of a window is the smallest hash among its runs of
``MINIMISER`` words. Consecutive windows of a document with the same minimiser travel to a bucket as one packed string
of text, and all windows with one word sequence meet in one bucket, since they have the same minimiser. There the
windows are sorted and the smallest id of each sequence is found. Sorting is by hash; equal hashes are then
compared word by word, and what differs is told apart, so the result is exact.

Before the shuffle a piece of the input sends each of its distinct strings once, with the smallest id that has it: for
the other documents of the piece the whole string repeats an earlier one. A minimiser of too many windows is
hot; its windows are dealt out one by one, by their own hash. Buckets hold about ``per_bucket`` windows.

Ids are compared as numbers; a NULL id counts as larger than all others, and rows with equal ids remove nothing from
each other. NULL and empty texts have no words. Texts shorter than a window stay as they are. The input
is read once and stored with a number for each row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rollcall.session import fresh_dir

from .batches import bounded, numbered, raw, small_batches
from .bitmap import bit, bitmap
from .scratch import left_behind
from .words import Hasher, Words, inside_text, mixed, of_text, windows

WINDOW, MINIMISER = 13, 3
PER_BUCKET = 250_000
#: Windows of a super-k-mer at most, so that a document of one repeated word is no single string.
LONGEST = 2_048
#: Text of the input that is packed together.
PACKED_BYTES = 1 << 21
NO_ID = 2 ** 63 - 1


#: Made once in each task: functions travel with the plan, so nothing is kept in a module of the workers.
_made: list[Hasher] = []


def hasher() -> Hasher:
    if not _made:
        _made.append(Hasher())
    return _made[0]


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each ``size`` consecutive values."""
    have = 1
    while have < size:
        step = min(have, size - have)
        values = np.minimum(values[:-step], values[step:]) if len(values) > step else values[:0]
        have += step
    return values


def super_kmers(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first words, windows, minimisers) of the super-k-mers, and a hash of each window of the texts by first word."""
    at = inside_text(words.counts, window)
    least = sliding_min(windows(words.hashes, MINIMISER), window - MINIMISER + 1)[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(at)))
    pieces = -(-length // LONGEST)
    if len(pieces) and pieces.max() > 1:
        part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.repeat(first, pieces) + part * LONGEST
        length = np.minimum(np.repeat(length, pieces) - part * LONGEST, LONGEST)
    return at[first], length, least[first], least


def _minimiser_counts(window: int, least: int):
    """Minimisers with at least ``least`` windows in the task (NULL: all windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sizes, total = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
        for batch in bounded(batches, "text"):
            _, length, minimiser, _ = super_kmers(hasher().find(*raw(batch.column("text"))), window)
            own, which = np.unique(minimiser, return_inverse=True)
            names.append(own)
            sizes.append(np.bincount(which, length, len(own)).astype(np.int64))
            total += int(length.sum())
        own, which = np.unique(np.concatenate(names), return_inverse=True)
        count = np.bincount(which, np.concatenate(sizes), len(own)).astype(np.int64)
        own, count = own[count >= least], count[count >= least]
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *own.view(np.int64).tolist()], pa.int64()), pa.array([total, *count.tolist()], pa.int64())],
            names=["minimiser", "n"])

    return run


def _packed(window: int, buckets: int, hot: np.ndarray):
    """For each piece of input and bucket: the distinct strings with their smallest ids, and the words already known to repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=3)
        for batch in bounded(batches, "text", PACKED_BYTES):
            data, offsets = raw(batch.column("text"))
            words = hasher().find(data, offsets)
            first, length, minimiser, _ = super_kmers(words, window)
            if not len(first):
                continue
            is_hot = np.isin(minimiser, hot)
            if is_hot.any():  # windows one by one
                each = np.repeat(first[is_hot], length[is_hot])
                each += np.arange(len(each)) - np.repeat(np.cumsum(length[is_hot]) - length[is_hot], length[is_hot])
                own = mixed(windows(words.hashes, window)[each])
                first = np.concatenate([first[~is_hot], each])
                minimiser = np.concatenate([minimiser[~is_hot], own])
                length = np.concatenate([length[~is_hot], np.ones(len(each), np.int64)])
            bucket = (mixed(minimiser) % np.uint64(buckets)).astype(np.int64)
            doc = of_text(words.counts)[first]
            start = first - (np.cumsum(words.counts) - words.counts)[doc]
            key = batch.column("key").to_numpy()[doc]
            row = batch.column("row").to_numpy()[doc]
            begin, end = words.starts[first], words.ends[first + length + window - 2]
            # Equal strings of the piece: same length in windows and bytes, same first and last hash, then byte by byte.
            order = np.lexsort((start, row, key, words.hashes[first], end - begin, minimiser, bucket))
            buffer = data.tobytes()
            names = np.stack([bucket, minimiser.view(np.int64), end - begin, words.hashes[first].view(np.int64)])[:, order]
            maybe = np.zeros(len(order), bool)
            maybe[1:] = (names[:, 1:] == names[:, :-1]).all(axis=0)
            of_first = np.zeros(len(order), np.int64)
            _tell_apart(buffer, order, begin, end, maybe, of_first)
            kept = order[~maybe]
            again = order[maybe]
            # A repeat in the smallest document itself is no repeat of an earlier one: it has to travel too.
            same_id = key[again] == key[of_first[maybe]]
            kept = np.concatenate([kept, again[same_id]])
            again = again[~same_id]
            kept = kept[np.argsort(bucket[kept], kind="stable")]
            again = again[np.argsort(bucket[again], kind="stable")]
            own = np.unique(bucket)
            at, to = np.searchsorted(bucket[kept], own), np.searchsorted(bucket[kept], own, side="right")
            low, high = np.searchsorted(bucket[again], own), np.searchsorted(bucket[again], own, side="right")
            columns = [[] for _ in range(7)]
            for a, b, c, d in zip(at, to, low, high):
                use, gone = kept[a:b], again[c:d]
                for column, value in zip(columns, (
                        key[use], row[use], start[use].astype("<i4"), (end - begin)[use].astype("<i4"),
                        row[gone], start[gone].astype("<i4"))):
                    column.append(value.tobytes())
                columns[6].append((length[gone] + window - 1).astype("<i4").tobytes())
            texts = [compressor.compress(b"".join([buffer[x:y] for x, y in zip(begin[kept[a:b]].tolist(), end[kept[a:b]].tolist())]))
                     for a, b in zip(at, to)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int32()), *(pa.array(c, pa.binary()) for c in columns), pa.array(texts, pa.binary())],
                names=["bucket", *PACKED])

    return run


PACKED = ("keys", "rows", "starts", "sizes", "gone_rows", "gone_starts", "gone_words", "texts")


def _tell_apart(buffer: bytes, order: np.ndarray, begin: np.ndarray, end: np.ndarray, maybe: np.ndarray,
                of_first: np.ndarray) -> None:
    """Keep ``maybe`` only where the string equals that of the first of its run, and note that one."""
    lead, lead_text, before = -1, b"", -1
    for at in np.flatnonzero(maybe).tolist():
        if before != at - 1 or not maybe[before]:
            lead = order[at - 1]
            lead_text = buffer[begin[lead]: end[lead]]
        own, before = order[at], at
        of_first[at] = lead
        maybe[at] = buffer[begin[own]: end[own]] == lead_text


def _exact_words(data: np.ndarray, words: Words) -> np.ndarray:
    """A number for each word, equal for equal words only."""
    _, first, number = np.unique(words.hashes, return_index=True, return_inverse=True)
    size, lead = words.ends - words.starts, first[number]
    same = size == size[lead]
    if same.all():
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        same = data[np.repeat(words.starts, size) + inner] == data[np.repeat(words.starts[lead], size) + inner]
    if not same.all():  # two words with one hash
        buffer, numbers = data.tobytes(), {}
        texts = (buffer[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist()))
        number = np.fromiter((numbers.setdefault(t, len(numbers)) for t in texts), np.int64, len(size))
    return number


def repeated(data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, window: int):
    """(text, first word) of each window whose words also begin in a text with a smaller key."""
    words = hasher().find(data, offsets)
    at = inside_text(words.counts, window)
    text = of_text(words.counts)[at]
    hashes = windows(words.hashes, window)[at]
    order = np.argsort(hashes, kind="stable")
    new = np.ones(len(at), bool)
    new[1:] = hashes[order][1:] != hashes[order][:-1]
    lead = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    twice = np.diff(np.append(lead, len(at)))[group] > 1
    use = order[twice]
    if not len(use):
        return text[:0], at[:0]
    number = _exact_words(data, words)
    first = order[lead[group[twice]]]
    equal = np.ones(len(use), bool)
    for step in range(window):
        equal &= number[at[use] + step] == number[at[first] + step]
    group = group[twice]
    if not equal.all():  # different windows with one hash
        rows = np.stack([number[at[use] + step] for step in range(window)], axis=1)
        group = np.unique(rows, axis=0, return_inverse=True)[1].ravel()
    _, group = np.unique(group, return_inverse=True)
    least = np.full(group.max() + 1, NO_ID)
    np.minimum.at(least, group, keys[text[use]])
    gone = np.sort(use[keys[text[use]] > least[group]])
    return text[gone], at[gone] - (np.cumsum(words.counts) - words.counts)[text[gone]]


def _in_bucket(window: int):
    def run(table: pa.Table) -> pa.Table:
        columns = {n: table.column(n).to_pylist() for n in PACKED}
        columns["texts"] = [zstandard.ZstdDecompressor().decompress(t) for t in columns["texts"]]
        joined = {n: b"".join(c) for n, c in columns.items()}
        keys, rows, gone_rows = (np.frombuffer(joined[n], "<i8") for n in ("keys", "rows", "gone_rows"))
        starts, sizes, gone_starts, gone_words = (
            np.frombuffer(joined[n], "<i4").astype(np.int64) for n in ("starts", "sizes", "gone_starts", "gone_words"))
        text, first = repeated(np.frombuffer(joined["texts"], np.uint8), np.concatenate([[0], np.cumsum(sizes)]), keys, window)
        begin = starts[text] + first
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (first[1:] != first[:-1] + 1)
        lead = np.flatnonzero(new)
        last = np.append(lead[1:], len(text))[: len(lead)] - 1
        return pa.table({
            "row": np.concatenate([rows[text[lead]], gone_rows]), "begin": np.concatenate([begin[lead], gone_starts]),
            "end": np.concatenate([begin[last] + window, gone_starts + gone_words])})

    return run


def removals(rows: DataFrame, window: int = WINDOW, per_bucket: int = PER_BUCKET) -> DataFrame:
    """row, spans of words (begin, end) to remove, for rows (row, key, text) that have any."""
    texts = rows.where("text IS NOT NULL")
    tasks = max(1, texts.rdd.getNumPartitions())
    most = per_bucket // 4
    counts = texts.select("text").mapInArrow(_minimiser_counts(window, max(8, most // tasks)), "minimiser long, n long")
    sums = counts.groupBy("minimiser").agg(F.sum("n").alias("n")).where(
        F.col("minimiser").isNull() | (F.col("n") > most)).toPandas()
    total = int(sums["n"][sums["minimiser"].isna()].sum())
    hot = sums["minimiser"].dropna().astype("int64").to_numpy().view(np.uint64)
    buckets = max(1, -(-total // per_bucket))
    packed = texts.select("row", "key", "text").mapInArrow(
        _packed(window, buckets, np.sort(hot)), "bucket int, " + ", ".join(f"{n} binary" for n in PACKED))
    spans = packed.groupBy("bucket").applyInArrow(_in_bucket(window), "row long, begin long, end long")
    return spans.groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in bounded(batches, "text"):
        counts, gone, kept = [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            words = (text or "").encode().split()
            stays = np.ones(len(words), bool)
            for span in spans or ():
                stays[span["begin"]: span["end"]] = False
            counts.append(len(words))
            gone.append(int(len(words) - stays.sum()))
            kept.append(b" ".join(words if not gone[-1] else [words[i] for i in np.flatnonzero(stays)]).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
            names=["doc", "n_words", "n_removed", "kept"])


def dedupe(docs: DataFrame, *, window: int = WINDOW, per_bucket: int = PER_BUCKET, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """doc (the row of ``docs``), n_words, n_removed and kept (the other words, joined by one space).

    Only the texts that may lose words move to meet what they lose.
    """
    small_batches(docs.sparkSession)
    rows = numbered(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")), "rows")
    text = F.col("doc").getField(text_column)
    keyed = rows.select("row", F.coalesce(F.col("doc").getField(id_column), F.lit(NO_ID)).alias("key"), text.alias("text"))
    path = fresh_dir(docs.sparkSession, "removals")
    left_behind(docs.sparkSession, path)
    removals(keyed, window, per_bucket).write.parquet(path)
    found = docs.sparkSession.read.parquet(path)
    marked = bitmap(found, "row")

    def having(marks: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(marked[batch.column("bit").to_numpy()] == marks)).select(["row", "doc"])

        return run

    kind = StructType([rows.schema["row"], rows.schema["doc"]])
    still, moved = (rows.withColumn("bit", bit("row")).mapInArrow(having(marks), kind) for marks in (False, True))
    still = still.withColumn("spans", F.lit(None).cast(found.schema["spans"].dataType))
    sides = [side.select("doc", text.alias("text"), "spans") for side in (still, moved.join(found, "row", "left"))]
    return sides[0].unionByName(sides[1]).mapInArrow(_kept, StructType([
        rows.schema["doc"], StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())]))
