"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A document is toxic if at least one of its sentences is: its score is one minus the product of what the
sentences lack to certainty (noisy-or). A sentence's score is a logistic function of the terms in it, words
and beginnings of words, hashed. The weights are fitted to document labels through the noisy-or, on a bounded
sample of labelled documents; terms that are no more frequent in toxic documents get no weight.

NULL and empty texts have no sentence and score 0. Without labels of both kinds every score is 0. Rows that
repeat are scored each for itself; NULL ids stay. Whole texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.session import fresh_dir

from .batches import bounded, raw, small_batches
from .labelled import SAMPLE_ROWS, sample
from .words import LETTERS_DIGITS, LOWER, Hasher, mixed, of_text

#: Hashed terms: words, and their first bytes.
TERMS = 1 << 19
PREFIXES = (4, 5, 6, 7)
#: A sentence ends at one of these bytes.
ENDS = np.isin(np.arange(256), list(b".!?\n"))
#: A term is kept with so many toxic documents of the sample, and so many times its share among the others.
LEAST_DOCS, LEAST_LIFT = 3, 4.0
PASSES, RATE, DECAY = 300, 0.1, 1e-4


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, totals: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(totals + self.bias, -60, 60)))


def sentences(hash_words: Hasher, texts: pa.Array):
    """(term of each occurrence, its sentence, document of each sentence, begin and end byte of each sentence)."""
    data, offsets = raw(texts)
    found = hash_words.find(data, offsets)
    stops = np.concatenate([[0], np.cumsum(ENDS[data])])
    doc = of_text(found.counts)
    # Sentences with words, numbered in order: a new one begins after a stop and with a document.
    new = np.concatenate([[True], (np.diff(stops[found.starts]) > 0) | (np.diff(doc) > 0)])[: len(doc)]
    number = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(doc) - 1]])[: len(first)]
    kinds = [found.hashes, *(mixed(hash_words.prefixes(data, found, n) + np.uint64(n)) for n in PREFIXES)]
    terms = np.concatenate([h % np.uint64(TERMS) for h in kinds]).astype(np.int64)
    begins, ends = found.starts[first], found.ends[last]
    return (terms, np.tile(number, len(kinds)), doc[first],
            begins - offsets[doc[first]], ends - offsets[doc[first]])


def _hasher() -> Hasher:
    return Hasher(LETTERS_DIGITS, LOWER)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and other documents that have each term."""
    hash_words, counts = _hasher(), np.zeros((2, TERMS), np.int64)
    for batch in bounded(batches, "text"):
        terms, sentence, doc_of, _, _ = sentences(hash_words, batch.column("text"))
        pairs = np.unique(doc_of[sentence] * TERMS + terms) if len(terms) else np.empty(0, np.int64)
        toxic = batch.column("label").to_numpy(zero_copy_only=False)[pairs // TERMS] > 0
        for kind in (0, 1):
            counts[kind] += np.bincount(pairs[toxic == kind] % TERMS, minlength=TERMS)
    some = np.flatnonzero(counts.sum(0))
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0, some]), pa.array(counts[1, some])],
                                     names=["term", "others", "toxic"])


def _bags(kept: np.ndarray):
    """id, label, sentence, terms: the sentences that have kept terms, and the number of all of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_words = _hasher()
        for batch in bounded(batches, "text"):
            terms, sentence, doc_of, _, _ = sentences(hash_words, batch.column("text"))
            use = kept[terms] if len(terms) else np.empty(0, bool)
            order = np.argsort(sentence[use], kind="stable")
            own, starts = np.unique(sentence[use][order], return_index=True)
            bag = np.searchsorted(doc_of[own], np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, int(use.sum())), pa.int32()),
                                             pa.array(terms[use][order], pa.int64()))
            yield pa.RecordBatch.from_arrays([
                batch.column("label").cast(pa.int32()),
                pa.array(np.bincount(doc_of, minlength=batch.num_rows)[: batch.num_rows], pa.int64()),
                pa.ListArray.from_arrays(pa.array(bag, pa.int32()), lists),
            ], names=["label", "n_sentences", "bags"])

    return run


def fit(docs: DataFrame, labels: DataFrame, train: Column, *, label: str = "toxic", id_column: str = "doc_id",
        text_column: str = "text", rows: int = SAMPLE_ROWS) -> Model:
    """A model of at most ``rows`` labelled documents for which ``train`` (a condition on ``labels``) holds."""
    spark = docs.sparkSession
    small_batches(spark)
    path = fresh_dir(spark, "toxicity-sample")
    sample(docs, labels, label, train, id_column=id_column, text_column=text_column, rows=rows).write.parquet(path)
    chosen = spark.read.parquet(path)
    n = dict.fromkeys((0, 1), 0) | {int(r[0]): r[1] for r in chosen.groupBy((F.col("label") > 0).cast("int")).count().collect()}
    if not (n[0] and n[1]):
        return Model(np.zeros(TERMS), -60.0)
    counts = chosen.select("text", "label").mapInArrow(_term_counts, "term long, others long, toxic long")
    lift = (F.col("toxic") / n[1]) / ((F.col("others") + 0.5) / n[0])
    kept = counts.groupBy("term").agg(F.sum("others").alias("others"), F.sum("toxic").alias("toxic")).where(
        (F.col("toxic") >= LEAST_DOCS) & (lift >= LEAST_LIFT)).select("term").toPandas()["term"].to_numpy()
    use = np.zeros(TERMS, bool)
    use[kept] = True
    bags = chosen.select("text", "label").mapInArrow(
        _bags(use), "label int, n_sentences long, bags array<array<bigint>>").toPandas()
    return _descend(bags, kept)


def _descend(bags, kept: np.ndarray) -> Model:
    """Adam on the log loss of the noisy-or, over all sampled documents at once."""
    place = np.zeros(TERMS, np.int64)
    place[kept] = np.arange(len(kept))
    label = bags["label"].to_numpy() > 0
    per_doc = [[np.asarray(s, np.int64) for s in b] for b in bags["bags"]]
    flat = [s for b in per_doc for s in b]
    doc = np.repeat(np.arange(len(label)), [len(b) for b in per_doc])
    sentence = np.repeat(np.arange(len(flat)), [len(s) for s in flat])
    terms = place[np.concatenate(flat)] if flat else np.empty(0, np.int64)
    plain = bags["n_sentences"].to_numpy() - np.bincount(doc, minlength=len(label))
    theta = np.zeros(len(kept) + 1)
    theta[-1] = -6.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, PASSES + 1):
        z = theta[-1] + np.bincount(sentence, theta[terms], len(flat))
        p, rest = _sigmoid(z), _sigmoid(theta[-1])
        log_lack = np.bincount(doc, np.log1p(-p), len(label)) + plain * np.log1p(-rest)
        score = np.clip(-np.expm1(log_lack), 1e-12, 1)
        # d loss / d log_lack, times d log_lack / dz = -p
        pull = np.where(label, np.exp(log_lack) / score, -1.0)
        by_sentence = -pull[doc] * p
        slope = np.append(np.bincount(terms, by_sentence[sentence], len(kept)), by_sentence.sum() - (pull * plain * rest).sum())
        slope = slope / len(label)
        slope[:-1] += DECAY * theta[:-1]
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope ** 2
        theta -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
        theta[:-1] = np.maximum(theta[:-1], 0)  # no term makes a sentence less toxic
    weights = np.zeros(TERMS)
    weights[kept] = theta[:-1]
    return Model(weights, float(theta[-1]))


def _sigmoid(z):
    return np.clip(1 / (1 + np.exp(-np.clip(z, -60, 60))), 1e-12, 1 - 1e-12)


def score(docs: DataFrame, model: Model, *, id_column: str = "doc_id", text_column: str = "text",
          least: float = 0.5) -> DataFrame:
    """id, score, sentences: with begin and end (UTF-8 bytes) and score of the sentences that reach ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_words = _hasher()
        for batch in bounded(batches, "text"):
            terms, sentence, doc_of, begins, ends = sentences(hash_words, batch.column("text"))
            p = model.scores(np.bincount(sentence, model.weights[terms], len(doc_of)))
            lack = np.bincount(doc_of, np.log1p(-np.minimum(p, 1 - 1e-12)), batch.num_rows)
            bad = np.flatnonzero(p >= least)
            spans = pa.StructArray.from_arrays([pa.array(x[bad]) for x in (begins, ends, p)], ["begin", "end", "score"])
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(doc_of[bad], np.arange(batch.num_rows + 1)), pa.int32()), spans)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(-np.expm1(lack)), lists],
                                             names=["id", "score", "sentences"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"id {kind}, score double, sentences array<struct<begin: long, end: long, score: double>>")
