"""Exact top-k search by inner product.

Queries and candidates are packed into matrices: blocks of queries and shards of candidates. Each tile
(block, shard) is one matrix product, from which every query keeps its k best. A task works through the
tiles of one block and merges their lists as it goes; the lists of the tasks meet in a window per query, of
which Spark already keeps only the first k of each task before the shuffle.

Components count as floor(scale * x). Vectors that are NULL or hold NULL, NaN or infinite components (also after scaling)
take no part. Vectors of other lengths are no candidates for a query. Products
are exact: floating matrices while every sum is below 2^53, whole numbers of any size beyond (scores past 64 bits
are held to the nearest). Ties go to the smaller id. Rows with a NULL id take no part; of rows with one id each is
a candidate, and none of them is a candidate for the others. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK_ROWS = 2_048
SHARD_ROWS = 16_384
#: Shards that one task works through for one block before its list is handed on.
SHARDS_PER_TASK = 64


def _scaled(vector: str, scale: int) -> Column:
    # Spark's floor gives a 64-bit number; components beyond 2^53 are whole anyway.
    def floor(x: Column) -> Column:
        return F.when(F.abs(x) < F.lit(2.0 ** 53), F.floor(x).cast("double")).otherwise(x)

    whole = F.transform(vector, lambda x: floor(x.cast("double") * F.lit(float(scale))))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (
        F.abs(x.cast("double") * F.lit(float(scale))) < F.lit(float("inf"))))
    return F.when(fine & F.col(vector).isNotNull(), whole)


def _packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows dealt by a hash of id and vector into groups of about ``size``, each packed as one matrix: dim, group, groups, ids, values."""
    counts = rows.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("int").alias(f"{name}s"))
    dealt = rows.join(counts, "dim").withColumn(
        name, F.pmod(F.xxhash64("id", "vector"), F.col(f"{name}s")).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        if table.num_rows == 0:
            return table.select([])
        ids = table.column("id").to_numpy()
        values = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        first = {c: table.column(c)[0].as_py() for c in ("dim", name, f"{name}s")}
        return pa.table({**{c: pa.array([v], pa.int32()) for c, v in first.items()},
                         "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                         "values": pa.array([values.astype("<f8").tobytes()], pa.binary())})

    return dealt.select("dim", name, f"{name}s", "id", "vector").groupBy("dim", name).applyInArrow(
        pack, f"dim int, {name} int, {name}s int, ids binary, values binary")


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Inner products of whole-numbered rows, exact."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(shard).max(initial=0)) * max(1, queries.shape[1])
    if bound < 2.0 ** 53:
        return (queries @ shard.T).astype(np.int64)
    exact = queries.astype(object) if bound >= 2.0 ** 62 else queries.astype(np.int64)
    other = shard.astype(object) if bound >= 2.0 ** 62 else shard.astype(np.int64)
    if bound >= 2.0 ** 62:
        as_int = np.frompyfunc(int, 1, 1)
        found = np.clip(as_int(exact) @ as_int(other).T, -(2 ** 63), 2 ** 63 - 1)
        return found.astype(np.int64)
    return exact @ other.T


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, score) of the k highest of each row, ties to the smaller id; ids are one row or as many as scores."""
    ids = np.broadcast_to(ids, scores.shape)
    if scores.shape[1] > k:
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1: k]
        row, col = np.nonzero(scores >= least)
    else:
        row, col = np.nonzero(np.ones(scores.shape, bool))
    order = np.lexsort((ids[row, col], -scores[row, col], row))
    row, col = row[order], col[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    keep = rank < k
    return row[keep], ids[row[keep], col[keep]], scores[row[keep], col[keep]]


def _tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if block != (row["dim"], row["block"]):
                    if held is not None:
                        yield _lists(query_ids, *held)
                    block, held = (row["dim"], row["block"]), None
                    query_ids = np.frombuffer(row["query_ids"], "<i8")
                    queries = np.frombuffer(row["query_values"], "<f8").reshape(len(query_ids), -1)
                ids = np.frombuffer(row["ids"], "<i8")
                scores = products(queries, np.frombuffer(row["values"], "<f8").reshape(len(ids), -1))
                held = merged(held, own_out(query_ids, ids, scores, k), k)
        if held is not None:
            yield _lists(query_ids, *held)

    return run


def own_out(query_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """The best of a tile, without the rows that carry the query's own id."""
    same = np.isin(query_ids, ids)
    found = [best(scores[~same], ids, k)]
    rows = [np.flatnonzero(~same)[found[0][0]]]
    for at in np.flatnonzero(same):
        other = ids != query_ids[at]
        found.append(best(scores[at: at + 1, other], ids[other], k))
        rows.append(np.full(len(found[-1][0]), at))
    return np.concatenate(rows), np.concatenate([f[1] for f in found]), np.concatenate([f[2] for f in found])


def merged(held, more, k: int):
    """Two sets of (row, id, score) lists as one, the k best of each row."""
    if held is None:
        held = tuple(np.empty(0, np.int64) for _ in range(3))
    row, ids, score = (np.concatenate([a, b]) for a, b in zip(held, more))
    order = np.lexsort((ids, -score, row))
    row, ids, score = row[order], ids[order], score[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], ids[keep], score[keep]


def _lists(query_ids, row, ids, score) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query_ids[row]), pa.array(ids), pa.array(score)],
                                      names=["query_id", "vec_id", "score"])


def search(
    vectors: DataFrame, queries: Column, k: int = 5, *, id_column: str = "vec_id", vector_column: str = "embedding",
    scale: int = 256, block_rows: int = BLOCK_ROWS, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows for every row for which ``queries`` holds."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), _scaled(vector_column, scale).alias("vector"),
                          F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = rows.where("id IS NOT NULL AND vector IS NOT NULL").withColumn("dim", F.size("vector"))
    shards = _packed(rows.select("dim", "id", "vector"), shard_rows, "shard")
    blocks = _packed(rows.where("asks").select("dim", "id", "vector"), block_rows, "block").withColumnsRenamed(
        {"ids": "query_ids", "values": "query_values"})
    per_block = shards.join(blocks.groupBy("dim").agg(F.max("blocks").alias("of")), "dim").select(
        "dim", "shard", "ids", "values", F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("block"))
    tiles = per_block.join(blocks, ["dim", "block"]).withColumn(
        "run", (F.col("shard") / SHARDS_PER_TASK).cast("int"))
    tiles = tiles.repartition("dim", "block", "run").sortWithinPartitions("dim", "block", "run")
    lists = tiles.mapInArrow(_tiles(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
