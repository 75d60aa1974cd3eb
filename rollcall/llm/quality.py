"""Quality classifier: gradient-boosted trees over statistics of a document.

The statistics are shares of kinds of characters, word and line lengths, and repetition. Each is cut into
bins by quantiles of the sample; trees are grown level by level from histograms of gradients, and stored as
arrays in which a node's children follow from its number, so that all documents of a batch descend at once.
The trees are fitted on a bounded sample of labelled documents.

NULL and empty texts are scored like any other, from statistics that are all 0. Without labels of both
kinds every score is 0.5. Rows that repeat are scored each for itself; NULL ids stay. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .batches import bounded, raw, small_batches
from .labelled import SAMPLE_ROWS, sample
from .words import NOT_SPACE, Hasher, of_text

BINS, TREES, DEPTH, RATE, LAMBDA, LEAST_HESSIAN = 64, 80, 4, 0.15, 1.0, 2.0

#: Kind of each byte: other, lower case, upper case, digit, blank, line end, sentence mark, quote or bracket,
#: other punctuation, beyond ASCII (first byte), beyond ASCII (further byte).
KINDS = 11
_KIND = np.zeros(256, np.int64)
for _number, _bytes in enumerate(
        (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n", b".,;:", b"'\"()[]{}",
         b"!?#$%&*+-/<=>@\\^_`|~", bytes(range(0xC0, 0x100)), bytes(range(0x80, 0xC0))), 1):
    _KIND[list(_bytes)] = _number
LOWER_CASE, UPPER_CASE, DIGIT, BLANK, LINE_END, SENTENCE, QUOTE, SYMBOL, WIDE = range(1, 10)


def statistics(hash_words: Hasher, texts: pa.Array) -> np.ndarray:
    """A row of numbers for each text."""
    data, offsets = raw(texts)
    rows, size = len(texts), np.maximum(np.diff(offsets), 1)
    of_byte = np.repeat(np.arange(rows), np.diff(offsets))
    kinds = np.bincount(of_byte * KINDS + _KIND[data], minlength=rows * KINDS).reshape(rows, KINDS)
    found = hash_words.find(data, offsets)
    doc, words = of_text(found.counts), np.maximum(found.counts, 1)
    long = (found.ends - found.starts).astype(float)
    mean = np.bincount(doc, long, rows) / words
    spread = np.sqrt(np.maximum(np.bincount(doc, long ** 2, rows) / words - mean ** 2, 0))
    order = np.lexsort((found.hashes, doc))
    same = np.zeros(len(doc), bool)
    same[1:] = (found.hashes[order][1:] == found.hashes[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    runs = np.flatnonzero(~same)
    longest = np.zeros(rows)
    np.maximum.at(longest, doc[order][runs], np.diff(np.append(runs, len(doc))))
    next_same = np.zeros(len(doc), bool)
    next_same[1:] = (found.hashes[1:] == found.hashes[:-1]) & (doc[1:] == doc[:-1])
    last = _KIND[data[found.ends - 1]] if len(doc) else np.empty(0, np.int64)
    first = _KIND[data[found.starts]] if len(doc) else np.empty(0, np.int64)
    alone = (long == 1) & (first == SYMBOL)
    letters = np.maximum(kinds[:, LOWER_CASE] + kinds[:, UPPER_CASE] + kinds[:, WIDE], 1)
    per_word = lambda mask: np.bincount(doc[mask], minlength=rows) / words
    return np.stack([
        np.log1p(np.diff(offsets)), np.log1p(found.counts), mean, spread,
        kinds[:, UPPER_CASE] / letters, kinds[:, DIGIT] / size, kinds[:, BLANK] / size, kinds[:, LINE_END] / size,
        kinds[:, SENTENCE] / words, kinds[:, QUOTE] / words, kinds[:, SYMBOL] / words, kinds[:, 0] / size, kinds[:, WIDE] / letters,
        per_word(~same[np.argsort(order)]) if len(doc) else np.zeros(rows), longest / words, per_word(next_same),
        per_word(last == SENTENCE), per_word(last == SYMBOL), per_word(first == UPPER_CASE), per_word(alone),
        found.counts / (kinds[:, LINE_END] + 1), per_word(long <= 2), per_word(long >= 15),
    ], axis=1).astype(float)


@dataclass(frozen=True)
class Trees:
    """Complete trees: node n has children 2n + 1 and 2n + 2; a value above the threshold goes right."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1] if len(self.feature) else 0
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-np.clip(total, -60, 60)))


def grow(x: np.ndarray, y: np.ndarray, *, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Trees:
    """Boosted trees for labels 0 and 1, by second-order gradients of the log loss."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base, inner = float(np.log(share / (1 - share))), 2 ** depth - 1
    total, grown = np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, curve = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            best = np.zeros(count)
            for f, edge in enumerate(edges):
                if not len(edge):
                    continue
                cell = (node - first) * (bins + 1) + binned[:, f]
                g, h = (np.cumsum(np.bincount(cell, w, count * (bins + 1)).reshape(count, -1), axis=1) for w in (slope, curve))
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g ** 2 / (h + LAMBDA) + (all_g - g) ** 2 / (all_h - h + LAMBDA) - all_g ** 2 / (all_h + LAMBDA)
                gain[(h < LEAST_HESSIAN) | (all_h - h < LEAST_HESSIAN)] = 0
                gain = gain[:, : len(edge)]
                at = gain.argmax(axis=1)
                better = gain[np.arange(count), at] > best + 1e-9
                best[better] = gain[np.arange(count), at][better]
                feature[first: first + count][better] = f
                threshold[first: first + count][better] = edge[at[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaves = node - inner
        g, h = (np.bincount(leaves, w, inner + 1) for w in (slope, curve))
        leaf = -RATE * g / (h + LAMBDA)
        total += leaf[leaves]
        grown.append((feature, threshold, leaf))
    return Trees(*(np.stack(part) for part in zip(*grown)), base)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hash_words = Hasher(NOT_SPACE)
    for batch in bounded(batches, "text"):
        found = statistics(hash_words, batch.column("text"))
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(batch.num_rows + 1) * found.shape[1], pa.int32()), pa.array(found.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("label").cast(pa.int32()), lists], names=["label", "statistics"])


def fit(docs: DataFrame, labels: DataFrame, train: Column, *, label: str = "quality", id_column: str = "doc_id",
        text_column: str = "text", rows: int = SAMPLE_ROWS) -> Trees:
    """Trees from at most ``rows`` labelled documents for which ``train`` (a condition on ``labels``) holds."""
    small_batches(docs.sparkSession)
    chosen = sample(docs, labels, label, train, id_column=id_column, text_column=text_column, rows=rows)
    table = chosen.select("text", "label").mapInArrow(_measured, "label int, statistics array<double>").toArrow()
    y = table.column("label").to_numpy() > 0
    if y.all() or not y.any():
        return Trees(np.zeros((0, 0), np.int64), np.zeros((0, 0)), np.zeros((0, 0)), 0.0)
    x = table.column("statistics").combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    order = np.lexsort((*x.T, y))  # the order of rows from Spark is not fixed
    return grow(x[order], y[order].astype(float))


def score(docs: DataFrame, model: Trees, *, text_column: str = "text", output: str = "score") -> DataFrame:
    """``docs`` with a column ``output``; a column of that name is replaced."""
    given = docs.drop(output)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_words = Hasher(NOT_SPACE)
        for batch in bounded(batches, text_column):
            scores = model.scores(statistics(hash_words, batch.column(text_column)))
            yield batch.append_column(output, pa.array(scores))

    return given.mapInArrow(run, StructType([*given.schema.fields, StructField(output, DoubleType())]))
