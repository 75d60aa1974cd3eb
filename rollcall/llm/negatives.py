"""Hard-negative mining by threshold joins: per anchor and positive, the best rows of other labels inside a window of scores.

Rows are packed into shards, anchors into blocks. A shard has an inverted index for a threshold: dimensions are put in
order of their weight there, and a row is listed under its first dimensions only, up to where the norm of the rest,
times that of any anchor, stays below the anchor's threshold. Rows are sorted by how many dimensions list them, so
the list of a dimension is the head of the shard, and a block adds up its partial scores list by list as products of
matrices. In between, rows drop out whose partial score and remaining norm reach no anchor's threshold. For pairs that
are left the rest is added from the rows themselves; what reaches the threshold is exact.

Thresholds are lowered until windows are full: a first join with high ones fills the windows of most anchors; the
others go on with lower ones, the last of which is the lower end of their window. The same join finds the positives,
in windows without ends. A task has one shard and takes the blocks one after the other; it hands on at most as many rows
per window as the window holds.

Components count as floor(scale * x). Vectors that are NULL or hold NULL, NaN or infinite components, and rows with a NULL
label or id take no part. Vectors of other lengths are neither positives nor negatives of an anchor. Scores are exact: floating
matrices while every sum is below 2^53, whole numbers of any size beyond (scores past 64 bits are held to the nearest). Ties go
to the smaller id. Rows that repeat an id are each an anchor and each a candidate, but not for one another. An anchor without
other rows of its label has no positives and no rows in the result. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from .scratch import Scratch
from .topk import products

SHARD_ROWS, BLOCK_ROWS = 4_096, 256
#: Dimensions that are added up between two looks at the remaining norms.
STEP = 8
#: Thresholds of the joins one after the other, as a part of the expected or highest wanted score; the last join has none.
POSITIVE_LEVELS, NEGATIVE_LEVELS = (0.5, 0.25, 0.0), (0.75, 0.5)
LOWEST, HIGHEST = -(2 ** 63), 2 ** 63 - 1
#: Pairs whose remaining dimensions are added at once.
PAIRS_AT_ONCE = 1 << 16


def _blob(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string; whole numbers in the smallest type that holds them."""
    parts = []
    for array in arrays:
        for kind in ("<i2", "<i4"):
            if array.dtype != np.dtype(kind) and array.size and np.abs(array).max() < 2 ** (8 * np.dtype(kind).itemsize - 1) \
                    and np.array_equal(array, small := array.astype(kind)):
                array = small
                break
        data = np.ascontiguousarray(array).tobytes()
        parts += [array.dtype.str.encode().ljust(4), np.int64(len(data)).tobytes(), data]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _arrays(blob: bytes) -> list[np.ndarray]:
    data, at, found = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(data):
        kind, size = data[at: at + 4].decode().strip(), int(np.frombuffer(data, "<i8", 1, at + 4)[0])
        found.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at + 12))
        at += 12 + size
    return found


def _matrix(table: pa.Table, scale: int) -> np.ndarray:
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.floor(scale * flat.astype(np.float64)).reshape(table.num_rows, -1)


def _norms(values: np.ndarray) -> np.ndarray:
    return np.sqrt((values * values).sum(axis=1))


def _shards(rows: DataFrame, size: int, scale: int) -> DataFrame:
    """dim, shard, shards, rows, norms (their sum), data: rows dealt out by a hash of their number, each group as one matrix."""
    counts = rows.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("int").alias("shards"))
    dealt = rows.join(counts, "dim").withColumn("shard", F.pmod(F.xxhash64("row"), F.col("shards")).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        values = _matrix(table, scale)
        ids, labels = (table.column(c).to_numpy() for c in ("id", "label"))
        return pa.table({
            "dim": table.column("dim")[:1], "shard": table.column("shard")[:1], "shards": table.column("shards")[:1],
            "rows": pa.array([table.num_rows], pa.int64()), "norms": pa.array([float(_norms(values).sum())]),
            "data": pa.array([_blob(ids, labels, values.ravel())], pa.binary())})

    return dealt.select("dim", "shard", "shards", "id", "label", "vector").groupBy("dim", "shard").applyInArrow(
        pack, "dim int, shard int, shards int, rows long, norms double, data binary")


def _blocks(anchors: DataFrame, size: int, scale: int) -> DataFrame:
    """dim, block, data: anchors with their thresholds and windows, dealt out like rows."""
    counts = anchors.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    dealt = anchors.join(counts, "dim").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        windows = table.column("windows").combine_chunks()
        flat = windows.flatten()
        sizes = np.diff(windows.offsets.to_numpy())
        columns = [table.column(c).to_numpy() for c in ("row", "id", "label", "least")]
        return pa.table({
            "dim": table.column("dim")[:1], "block": table.column("block")[:1],
            "data": pa.array([_blob(*columns, _matrix(table, scale).ravel(), sizes, *[
                flat.field(c).to_numpy(zero_copy_only=False) for c in ("window", "low", "high")])], pa.binary())})

    return dealt.select("dim", "block", "row", "id", "label", "least", "windows", "vector").groupBy("dim", "block").applyInArrow(
        pack, "dim int, block int, data binary")


class Index:
    """Inverted lists of a shard: ``listed[j]`` rows, the first ones, are listed under the j-th dimension in ``order``."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray, threshold: float) -> None:
        """``threshold``: an anchor's threshold over its norm is never lower."""
        squares = values * values
        order = np.argsort(-squares.sum(axis=0), kind="stable")
        rest = np.sqrt(np.cumsum(squares[:, order][:, ::-1], axis=1)[:, ::-1])
        rest = np.concatenate([rest, np.zeros((len(values), 1))], axis=1)
        # Norms fall from dimension to dimension, so this counts the dimensions before the rest is covered.
        kept = (rest >= threshold * (1 - 1e-9) if threshold > 0 else np.ones_like(rest, bool))[:, :-1].sum(axis=1)
        kept = np.minimum(-(-kept // STEP) * STEP, values.shape[1])
        place = np.argsort(-kept, kind="stable")
        self.order, self.ids, self.labels = order, ids[place], labels[place]
        self.values, self.rest, self.kept = values[place][:, order], rest[place], kept[place]
        self.listed = np.searchsorted(-self.kept, -np.arange(values.shape[1]), side="left")

    def pairs(self, queries: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of all pairs that reach the query's threshold ``least``, and maybe others; scores are exact."""
        dims = queries.shape[1]
        most = float(np.abs(queries).max(initial=0)) * float(np.abs(self.values).max(initial=0)) * max(1, dims)
        queries = queries[:, self.order]
        if not most < 2.0 ** 52:
            found = products(queries, self.values)
            query, row = np.divmod(np.arange(found.size), max(1, len(self.ids)))
            return query, row, found.ravel()
        rest = np.concatenate([np.sqrt(np.cumsum((queries * queries)[:, ::-1], axis=1)[:, ::-1]), np.zeros((len(queries), 1))], axis=1)
        slack = least - 1e-9 * np.abs(least) - 0.5
        alive = np.arange(self.listed[0] if dims else len(self.ids))
        partial = np.zeros((len(queries), len(alive)))
        done = []
        for begin in range(0, dims, STEP):
            end = min(begin + STEP, dims)
            # Rows that are not listed any further have their partial scores.
            over = int(np.searchsorted(alive, self.listed[begin]))
            if over < len(alive):
                done.append((alive[over:], partial[:, over:]))
                alive, partial = alive[:over], partial[:, :over]
            if not len(alive):
                break
            partial = partial + queries[:, begin:end] @ self.values[alive, begin:end].T
            reach = (partial + rest[:, end, None] * self.rest[alive, end] >= slack[:, None]).any(axis=0)
            if not reach.all():
                alive, partial = alive[reach], partial[:, reach]
        done.append((alive, partial))
        found = [self._finished(queries, rest, slack, rows, scores) for rows, scores in done if len(rows)]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else tuple(np.empty(0, np.int64) for _ in range(3))

    def _finished(self, queries: np.ndarray, rest: np.ndarray, slack: np.ndarray, rows: np.ndarray, partial: np.ndarray):
        """Pairs that may still reach the threshold, with the dimensions added under which the rows are not listed."""
        kept = self.kept[rows]
        query, at = np.nonzero(partial + rest[:, kept] * self.rest[rows, kept] >= slack[:, None])
        scores = partial[query, at]
        if kept.min() < queries.shape[1]:
            first = int(kept.min())
            mask = np.arange(first, queries.shape[1]) >= kept[:, None]
            tails = self.values[rows, first:] * mask
            for begin in range(0, len(query), PAIRS_AT_ONCE):
                part = slice(begin, begin + PAIRS_AT_ONCE)
                scores[part] += np.einsum("ij,ij->i", queries[query[part], first:], tails[at[part]])
            keep = scores >= slack[query]
            query, at, scores = query[keep], at[keep], scores[keep]
        return query, rows[at], scores.astype(np.int64)


def _joined(threshold: float, need: int, alike: bool):
    """For each block the best ``need`` rows of the shard in each window, of the anchor's label or of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, shard = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] is None:
                    ids, labels, values = _arrays(row["data"])
                    index = Index(ids.astype(np.int64), labels, values.astype(np.float64).reshape(len(ids), -1), threshold)
                    shard = row["dim"], row["shard"]
                elif shard == (row["dim"], row["shard"]):
                    yield _filled(index, _arrays(row["data"]), need, alike)

    return run


def _filled(index: Index, block: list[np.ndarray], need: int, alike: bool) -> pa.RecordBatch:
    anchors, ids, labels, least, values, sizes, window, low, high = block
    queries = values.astype(np.float64).reshape(len(anchors), -1)
    query, row, score = index.pairs(queries, least.astype(np.float64))
    fits = (index.labels[row] == labels[query]) == alike
    fits &= index.ids[row] != ids[query]
    query, row, score = query[fits], row[fits], score[fits]
    order = np.lexsort((index.ids[row], -score, query))
    query, row, score = query[order], row[order], score[order]
    owner = np.repeat(np.arange(len(anchors)), sizes)
    begin, end = np.searchsorted(query, owner, side="left"), np.searchsorted(query, owner, side="right")
    taken = []
    for b, e, lo, hi in zip(begin, end, low, high):
        own = score[b:e][::-1]  # ascending
        first, last = e - int(np.searchsorted(own, hi, side="right")), e - int(np.searchsorted(own, lo, side="left"))
        taken.append(np.arange(first, min(last, first + need)))
    counts = [len(t) for t in taken]
    at = np.concatenate([*taken, np.empty(0, np.int64)]).astype(np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(np.repeat(anchors[owner], counts).astype(np.int64)), pa.array(np.repeat(window, counts).astype(np.int32)),
        pa.array(index.ids[row[at]]), pa.array(score[at])], names=["row", "window", "other", "score"])


def _best(found: DataFrame, need: int) -> DataFrame:
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= need)


def threshold_join(anchors: DataFrame, windows: DataFrame, shards: DataFrame, need: int, alike: bool, levels: tuple[float, ...],
                   scratch: Scratch, *, block_rows: int, scale: int) -> DataFrame:
    """row, window, other, score, rank: the ``need`` best candidates of each window, of the anchor's label if ``alike``.

    ``windows`` has row, window, low, high and hope, the score that levels are parts of.
    """
    pending, found = scratch.store(windows, "windows"), []
    for level in (*levels, None):
        if pending.isEmpty():
            break
        start = F.col("low").cast("double")
        if level is not None:
            start = F.greatest(start, F.col("hope") * F.lit(float(level)))
        of_anchor = pending.withColumn("start", start).groupBy("row").agg(
            F.min("start").alias("least"), F.collect_list(F.struct("window", "low", "high")).alias("windows"))
        asked = scratch.store(anchors.join(of_anchor, "row"), "asked")
        ratio = asked.agg(F.min(F.when(F.col("norm") > 0, F.col("least") / F.col("norm")).otherwise(F.lit(float("-inf"))))).first()[0]
        sides = shards.groupBy("dim").agg(F.max("shards").alias("shards"))
        everywhere = _blocks(asked, block_rows, scale).join(sides, "dim").select(
            "dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "block", "data")
        tiles = shards.select("dim", "shard", F.lit(None).cast("int").alias("block"), "data").unionByName(everywhere)
        tiles = tiles.repartition("dim", "shard").sortWithinPartitions("dim", "shard", F.asc_nulls_first("block"))
        lists = tiles.mapInArrow(_joined(float(ratio), need, alike), "row long, window int, other long, score long")
        best = scratch.store(_best(lists, need), "filled")
        if level is not None:
            full = best.where(F.col("rank") == need).select("row", "window")
            found.append(best.join(full, ["row", "window"], "left_semi"))
            pending = scratch.store(pending.join(full, ["row", "window"], "left_anti"), "windows")
        else:
            found.append(best)
    if not found:
        return scratch.store(_best(windows.select("row", "window", F.lit(0).cast("long").alias("other"), F.col("low").alias("score")), 0), "joined")
    joined = found[0]
    for more in found[1:]:
        joined = joined.unionByName(more)
    return scratch.store(joined.select("row", "window", "other", "score", "rank"), "joined")


def mine(
    vectors: DataFrame, anchors: Column, *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    label: Column | None = None, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256,
    shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For every row for which ``anchors`` holds: its best rows of the same label, and for each of these the best rows of other
    labels that score from ``low`` to ``high`` per cent of what the positive scores.
    """
    spark = vectors.sparkSession
    fine = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), (F.col("label") if label is None else label).cast("long").alias("label"),
        F.when(fine, F.col(vector_column)).alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").withColumn("dim", F.size("vector"))
    with Scratch(spark) as scratch:
        rows = scratch.store(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
        shards = scratch.store(_shards(rows, shard_rows, scale), "shards")
        total = shards.agg(F.sum("norms"), F.sum("rows")).first()
        mean = total[0] / total[1] if total[1] else 0.0
        whole = F.transform("vector", lambda x: F.pow(F.floor(x.cast("double") * F.lit(float(scale))).cast("double"), F.lit(2.0)))
        norm = F.sqrt(F.aggregate(whole, F.lit(0.0), lambda a, x: a + x))
        asking = scratch.store(rows.where("asks").withColumn("norm", norm).drop("asks"), "anchors")
        open_ended = asking.select(
            "row", F.lit(1).alias("window"), F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high"),
            (F.col("norm") * F.lit(float(mean))).alias("hope"))
        sizes = {"block_rows": block_rows, "scale": scale}
        found = threshold_join(asking, open_ended, shards, positives, True, POSITIVE_LEVELS, scratch, **sizes)
        exact = F.col("score").cast("decimal(38,0)")
        own = found.select(
            "row", F.col("rank").alias("window"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"),
            F.ceil(exact * low / 100).cast("long").alias("low"), F.floor(exact * high / 100).cast("long").alias("high"))
        bounded = own.where("low <= high").select("row", "window", "low", "high", F.col("high").cast("double").alias("hope"))
        hard = threshold_join(asking, bounded, shards, negatives, False, NEGATIVE_LEVELS, scratch, **sizes)
        scratch.keep(found, hard, asking)
    named = own.join(asking.select("row", F.col("id").alias("anchor_id")), "row")
    return hard.join(named, ["row", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
