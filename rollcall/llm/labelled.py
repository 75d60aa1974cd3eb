"""Bounded samples of labelled documents, and the folds that labels are learned from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Labelled documents that a model is fitted on at most.
SAMPLE_ROWS = 20_000


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.encode(F.col(id_column).cast("string"), "UTF-8")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, *, id_column: str = "doc_id",
           text_column: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """id, text, label of at most ``rows`` labelled documents for which ``train`` holds, the same ones each time.

    Rows with a NULL id or label are left out; of several labels of one id the largest counts.
    """
    chosen = labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull() & train).groupBy(
        F.col(id_column).alias("id")).agg(F.max(label).alias("label")).orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id")
