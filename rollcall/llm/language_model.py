"""Language-model scores of documents: a hierarchical Pitman-Yor model of words after words.

Every word (and the beginning of a text) is the context of a restaurant in which the words after it are seated at
tables; all these restaurants share one parent, in which each of their tables is a customer, and the parent's base is
even over the known words and one unknown. Seatings are sampled by Gibbs sweeps over the whole corpus: the parent's
customers are the tables of all restaurants, its tables are drawn given them, and then the tables of each word in a
restaurant are drawn again, given the tables of all others there and the word's probability in the parent. The
predictive probabilities, under the same discounts, are averaged over the sweeps after the first ones.

The text is worked on in segments of some megabytes. Each segment sends the counts of its words to buckets of words,
where they are summed over the corpus, and the counts of its pairs to buckets of contexts, where the restaurants are
seated; both send back what the segment asked for, in its order. So a word or pair that stands everywhere reaches a
bucket once for each segment. A context with more than ``hot`` tokens is split over buckets by the word that follows;
its number of tables is summed after each sweep. The parent is dealt out by words: in each sweep the buckets of
contexts send it the numbers of tables of their words and get back the words' customers and tables there. A bucket
adds up the probabilities of its pairs itself, so that a sweep needs the last one only, and older ones are deleted. The
discount of the restaurants and that of the parent come from the counts of pairs and words seen once and twice. More than
``EXACT`` customers of one word are seated in blocks.

Tokens are ASCII lower-cased words between ASCII white space, then one end of text. NULL and empty texts have the end only.
Repeated rows count and are scored each for itself. Rows for which ``train`` is not true, NULL included, are scored but not
learned from. Words are told apart by 64-bit hashes. Segments are cut and numbered once and stored. The result reads stored
segments and replies, which stay until ``scratch.release`` is called.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .batches import bounded, raw, small_batches
from .scratch import Scratch
from .words import LOWER, NOT_SPACE, Hasher, mixed, of_text

SEGMENT_BYTES = 1 << 22
HOT = 1_000_000
STRENGTH = 1.0
BURN_IN, SAMPLES = 2, 4
EXACT = 16
#: Buckets of contexts for one bucket of the parent.
PER_PARENT = 8
END, BEGIN = np.uint64(1), np.uint64(2)
ADD = 0.1


#: Made once in each task: functions travel with the plan, so nothing is kept in a module of the workers.
_made: list[Hasher] = []


def hasher() -> Hasher:
    if not _made:
        _made.append(Hasher(NOT_SPACE, LOWER))
    return _made[0]


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string, each behind its size; first bytes of all numbers, then second ones, as these are alike."""
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T for a in arrays)
    parts = [p for a, plane in zip(arrays, planes) for p in (np.int64(a.nbytes).tobytes(), plane.tobytes())]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    data, at, found = zstandard.ZstdDecompressor().decompress(data), 0, []
    for kind in map(np.dtype, kinds):
        size = int(np.frombuffer(data, "<i8", 1, at)[0])
        planes = np.frombuffer(data, np.uint8, size, at + 8).reshape(kind.itemsize, -1)
        found.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += 8 + size
    return found


class Segment:
    """Tokens of some documents: distinct words, the word of each token, and pairs of context and word."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, train: np.ndarray) -> None:
        """hashes: of the words of all documents, counts: words of each, train: which documents are learned from."""
        self.counts = counts + 1
        ends = np.cumsum(self.counts) - 1
        tokens = np.empty(len(hashes) + len(counts), np.uint64)
        tokens[np.arange(len(hashes)) + of_text(counts)] = hashes
        tokens[ends] = END
        self.words, self.token = np.unique(tokens, return_inverse=True)
        context = np.concatenate([[0], self.token[:-1]])
        context[np.concatenate([[0], ends[:-1] + 1])] = len(self.words)
        self.doc, self.learned = of_text(self.counts), np.repeat(train, self.counts)
        size = len(self.words)
        code, self.pair = np.unique(context.astype(np.int64) * size + self.token, return_inverse=True)
        self.context, self.word = code // size, code % size
        self.pair_counts = np.bincount(self.pair, self.learned, len(code)).astype(np.int64)
        self.contexts = np.append(self.words, BEGIN)

    def word_order(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words in order of their buckets, and these buckets."""
        bucket = mixed(self.words) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        return order, bucket[order].astype(np.int64)

    def pair_order(self, buckets: int, hot: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs in order of their buckets, and these buckets; hot contexts are split by the word."""
        split = np.ones(len(self.contexts), np.uint64)
        at = np.searchsorted(hot, self.contexts)
        is_hot = (at < len(hot)) & (np.append(hot, 0)[at] == self.contexts)
        split[is_hot] = parts[at[is_hot]]
        part = mixed(self.words)[self.word] % split[self.context]
        bucket = mixed(self.contexts[self.context] + mixed(part) * (part > 0)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        return order, bucket[order].astype(np.int64)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Segment]]:
    """(number, segment) of each stored piece of the input."""
    for batch in bounded(batches, "data", SEGMENT_BYTES):
        for number, data in zip(batch.column("segment").to_pylist(), batch.column("data")):
            yield number, Segment(*_payload(data.as_py()))


def _slices(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, begins = np.unique(buckets, return_index=True)
    return own, np.append(begins, len(buckets))


def _word_counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, segment in _segments(batches):
            order, bucket = segment.word_order(buckets)
            count = np.bincount(segment.token, segment.learned, len(segment.words))[order].astype("<i4")
            words = segment.words[order].astype("<u8")
            own, cut = _slices(bucket)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int32()), pa.array(np.full(len(own), number), pa.int64()),
                 pa.array([packed(words[a:b], count[a:b]) for a, b in zip(cut, cut[1:])], pa.binary())],
                names=["bucket", "segment", "data"])

    return run


def seated(random: np.random.Generator, count: np.ndarray, pull: np.ndarray, discount: float) -> np.ndarray:
    """Tables after seating ``count`` customers of each word; ``pull`` is the weight of a new table.

    One customer after the other, beyond EXACT in blocks of a sixteenth of those seated, for which the weights stay.
    """
    tables, sitting = np.minimum(count, 1).astype(float), 1
    left = np.flatnonzero(count > 1)
    while len(left):
        block = max(1, sitting // EXACT)
        new = pull[left] / (pull[left] + np.maximum(sitting - discount * tables[left], 1e-9))
        tables[left] += random.binomial(np.minimum(count[left] - sitting, block), new)
        sitting += block
        left = left[count[left] > sitting]
    return np.minimum(tables, count)


WORDS = "bucket int, segment long, data binary, v long, n long, hot array<long>, hot_n array<long>"


def _sum_words(hot_size: int):
    """The counts that each segment asked for, and a row of figures of the bucket."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        parts = [unpacked(d, "<u8", "<i4") for d in table.column("data").to_pylist()]
        sizes = np.cumsum([len(p[0]) for p in parts])[:-1]
        own, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        count = np.bincount(which, np.concatenate([p[1] for p in parts]), len(own)).astype(np.int64)
        hot = np.flatnonzero(count > hot_size)
        replies = [packed(count[w].astype("<i8")) for w in np.split(which, sizes)]
        rows = [{"bucket": bucket, "segment": s, "data": d} for s, d in zip(table.column("segment").to_pylist(), replies)]
        figures = {"v": int((count > 0).sum()), "n": int(count.sum()), "hot": own[hot].view(np.int64).tolist(), "hot_n": count[hot].tolist()}
        return pa.Table.from_pylist([*rows, {"bucket": bucket, **figures}], pa.schema(
            [("bucket", pa.int32()), ("segment", pa.int64()), ("data", pa.binary()), ("v", pa.int64()), ("n", pa.int64()),
             ("hot", pa.list_(pa.int64())), ("hot_n", pa.list_(pa.int64()))]))

    return run


def _pair_counts(buckets: int, hot: np.ndarray, parts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, segment in _segments(batches):
            order, bucket = segment.pair_order(buckets, hot, parts)
            context, word = segment.context[order], segment.words[segment.word[order]].astype("<u8")
            count = segment.pair_counts[order].astype("<i4")
            own, cut = _slices(bucket)
            data = []
            for a, b in zip(cut, cut[1:]):
                names, runs = _slices(context[a:b])
                data.append(packed(segment.contexts[names].astype("<u8"), np.diff(runs).astype("<i4"), word[a:b], count[a:b]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int32()), pa.array(np.full(len(own), number), pa.int64()), pa.array(data, pa.binary())],
                names=["bucket", "segment", "data"])

    return run


#: What buckets of contexts and of the parent keep and send each other. ``kind`` is one of those below.
SENT = "kind int, bucket int, parent int, segment long, data binary, once long, twice long, customers long, tables long, hot array<long>, hot_tables array<long>"
SENT_SCHEMA = pa.schema([
    ("kind", pa.int32()), ("bucket", pa.int32()), ("parent", pa.int32()), ("segment", pa.int64()),
    ("data", pa.binary()), ("once", pa.int64()), ("twice", pa.int64()), ("customers", pa.int64()), ("tables", pa.int64()),
    ("hot", pa.list_(pa.int64())), ("hot_tables", pa.list_(pa.int64()))])
#: Pairs of a bucket; what a segment asked it for; its words in a bucket of the parent, and where these stand there; the
#: bucket's tables for each pair, and for each of these words; customers and tables of these words in the parent; figures;
#: the sum so far of each pair's predictive probabilities.
PAIRS, ASKED, NAMES, PLACES, TABLES, SUMS, ANSWER, FIGURES, CHANCES = range(9)


def _sent(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, SENT_SCHEMA)


def steps(places: np.ndarray) -> np.ndarray:
    """Places as differences, which are small and pack well."""
    return np.diff(places, prepend=0).astype("<i4")


class Pairs:
    """The restaurants of one bucket: count, context and word of each pair; words are in order of the parent's buckets."""

    def __init__(self, data: bytes) -> None:
        self.contexts, runs, word, self.count, self.edges = unpacked(data, "<u8", "<i4", "<i4", "<i4", "<i8")
        self.context, self.word = np.repeat(np.arange(len(self.contexts)), runs), word

    def totals(self, values: np.ndarray, split: dict[int, int]) -> np.ndarray:
        """Sums for each context; ``split`` are those of contexts that lie in several buckets."""
        total = np.bincount(self.context, values, len(self.contexts))
        for name, whole in split.items():
            total[self.contexts == np.uint64(name)] = whole
        return total

    def chances(self, tables: np.ndarray, split: dict[int, int], visits: dict[int, int], parent: np.ndarray, discount: float) -> np.ndarray:
        """Predictive probability of each pair; ``parent``: of each word in the parent, ``visits``: customers of split contexts."""
        served = np.maximum(self.count - discount * tables, 0)
        anew = (STRENGTH + discount * self.totals(tables, split)[self.context]) * parent[self.word]
        return (served + anew) / (STRENGTH + self.totals(self.count, visits)[self.context])

    def sent(self, bucket: int, tables: np.ndarray, hot: np.ndarray) -> list[dict]:
        """The tables, their sums for the parent and those of split contexts."""
        sums = np.bincount(self.word, tables, int(self.edges[-1])).astype("<i4")
        here = np.flatnonzero(np.isin(self.contexts, hot))
        local = np.bincount(self.context, tables, len(self.contexts)).astype(np.int64)
        return [{"kind": TABLES, "bucket": bucket, "data": packed(tables.astype("<i4"))},
                {"kind": FIGURES, "bucket": bucket, "hot": self.contexts[here].view(np.int64).tolist(), "hot_tables": local[here].tolist()},
                *({"kind": SUMS, "bucket": bucket, "parent": p, "data": packed(sums[a:b])}
                  for p, (a, b) in enumerate(zip(self.edges, self.edges[1:])) if b > a)]


def _sum_pairs(parents: int, hot: np.ndarray):
    """Pairs over the corpus, each with one table if it was learned."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        blobs = [unpacked(d, "<u8", "<i4", "<u8", "<i4") for d in table.column("data").to_pylist()]
        contexts, context = np.unique(np.concatenate([np.repeat(c, n) for c, n, _, _ in blobs]), return_inverse=True)
        words, word = np.unique(np.concatenate([b[2] for b in blobs]), return_inverse=True)
        own, which = np.unique(context.astype(np.int64) * len(words) + word, return_inverse=True)
        count = np.bincount(which, np.concatenate([b[3] for b in blobs]), len(own)).astype("<i4")
        parent = (mixed(words) % np.uint64(parents)).astype(np.int64)
        order = np.argsort(parent, kind="stable")
        place = np.empty(len(words), "<i4")
        place[order] = np.arange(len(words))
        edges = np.searchsorted(parent[order], np.arange(parents + 1)).astype("<i8")
        state = packed(contexts.astype("<u8"), np.bincount(own // len(words), minlength=len(contexts)).astype("<i4"),
                       place[own % len(words)], count, edges)
        asked = np.split(which, np.cumsum([len(b[2]) for b in blobs])[:-1])
        named = words[order].astype("<u8")
        return _sent([
            {"kind": PAIRS, "bucket": bucket, "data": state, "once": int((count == 1).sum()), "twice": int((count == 2).sum())},
            *({"kind": ASKED, "bucket": bucket, "segment": s, "data": packed(steps(w))}
              for s, w in zip(table.column("segment").to_pylist(), asked)),
            *({"kind": NAMES, "bucket": bucket, "parent": p, "data": packed(named[a:b])}
              for p, (a, b) in enumerate(zip(edges, edges[1:])) if b > a),
            *Pairs(state).sent(bucket, np.minimum(count, 1), hot)])

    return run


def _place_words(table: pa.Table) -> pa.Table:
    """Where the words of each bucket of contexts stand among those of a bucket of the parent; how many have 1 or 2 customers."""
    rows = table.to_pylist()
    names = {r["bucket"]: unpacked(r["data"], "<u8")[0] for r in rows if r["kind"] == NAMES}
    sums = {r["bucket"]: unpacked(r["data"], "<i4")[0] for r in rows if r["kind"] == SUMS}
    own, which = np.unique(np.concatenate(list(names.values())), return_inverse=True)
    customers = np.bincount(which, np.concatenate([sums[b] for b in names]), len(own))
    parts = np.split(which, np.cumsum([len(w) for w in names.values()])[:-1])
    parent = rows[0]["parent"]
    return _sent([*({"kind": PLACES, "bucket": b, "parent": parent, "data": packed(steps(w))} for b, w in zip(names, parts)),
                  {"kind": FIGURES, "parent": parent, "once": int((customers == 1).sum()), "twice": int((customers == 2).sum())}])


def _seat_parent(known: int, before: int, discount: float, sweep: int, seed: int):
    """The parent seated once more: its customers are the tables of all restaurants; ``before`` tables stood there."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parent = rows[0]["parent"]
        places = {r["bucket"]: np.cumsum(unpacked(r["data"], "<i4")[0]) for r in rows if r["kind"] == PLACES}
        sums = {r["bucket"]: unpacked(r["data"], "<i4")[0] for r in rows if r["kind"] == SUMS}
        order = sorted(places)
        customers = np.bincount(np.concatenate([places[b] for b in order]), np.concatenate([sums[b] for b in order])).astype(np.int64)
        random = np.random.Generator(np.random.PCG64([seed, 0, parent, sweep]))
        pull = np.full(len(customers), (STRENGTH + discount * before) / (known + 1))
        tables = seated(random, customers, pull, discount)
        return _sent([
            *({"kind": ANSWER, "bucket": b, "parent": parent,
               "data": packed(customers[places[b]].astype("<i8"), tables[places[b]].astype("<i8"))} for b in order),
            {"kind": FIGURES, "parent": parent, "customers": int(customers.sum()), "tables": int(tables.sum())}])

    return run


@dataclass(frozen=True)
class Sweep:
    """What holds for the whole corpus in one sweep.

    ``customers`` and ``tables`` of the parent, tables and visits of split contexts, the discounts and the number of known words.
    """

    customers: int
    tables: int
    split: dict[int, int]
    visits: dict[int, int]
    discount: float
    parent_discount: float
    known: int

    def parent(self, answers: list[dict]) -> np.ndarray:
        """Probability in the parent of each word of a bucket, from the answers in order of the parent's buckets."""
        customers, tables = _joined(sorted(answers, key=lambda r: r["parent"]), "<i8", "<i8")
        anew = (STRENGTH + self.parent_discount * self.tables) / (self.known + 1)
        return (customers - self.parent_discount * tables + anew) / (STRENGTH + self.customers)

    def opened(self, rows: list[dict]) -> tuple[Pairs, np.ndarray, np.ndarray, np.ndarray | None]:
        """Pairs, their tables, the parent's probabilities and the sum of chances, if there is one, of a bucket."""
        data = {r["kind"]: r["data"] for r in rows if r["kind"] in (PAIRS, TABLES, CHANCES)}
        chances = unpacked(data[CHANCES], "<f4")[0] if CHANCES in data else None
        return Pairs(data[PAIRS]), unpacked(data[TABLES], "<i4")[0], self.parent([r for r in rows if r["kind"] == ANSWER]), chances

    def added(self, pairs: Pairs, tables: np.ndarray, parent: np.ndarray, before: np.ndarray | None) -> np.ndarray:
        now = pairs.chances(tables, self.split, self.visits, parent, self.discount)
        return now if before is None else before + now


def _seat_pairs(state: Sweep, sweep: int, hot: np.ndarray, seed: int):
    """The restaurants seated once more under the parent's probabilities, after their chances are added up."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        bucket = rows[0]["bucket"]
        pairs, tables, parent, chances = state.opened(rows)
        summed = []
        if sweep > BURN_IN:
            summed = [{"kind": CHANCES, "bucket": bucket, "data": packed(state.added(pairs, tables, parent, chances).astype("<f4"))}]
        total = pairs.totals(tables, state.split)
        random = np.random.Generator(np.random.PCG64([seed, 1, bucket, sweep]))
        pull = (STRENGTH + state.discount * total[pairs.context]) * parent[pairs.word]
        return _sent([*pairs.sent(bucket, seated(random, pairs.count, pull, state.discount), hot), *summed])

    return run


def _chances(state: Sweep):
    """For each segment the mean predictive probability of the pairs that it asked for."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        mean = state.added(*state.opened(rows)) / SAMPLES
        asked = [r for r in rows if r["kind"] == ASKED]
        return pa.table({
            "bucket": pa.array([r["bucket"] for r in asked], pa.int32()), "segment": pa.array([r["segment"] for r in asked], pa.int64()),
            "data": pa.array([packed(mean[np.cumsum(unpacked(r["data"], "<i4")[0])].astype("<f4")) for r in asked], pa.binary())})

    return run


def _discount(once: int, twice: int) -> float:
    return float(np.clip(once / max(1, once + 2 * twice), 0.1, 0.98))


def _scored(buckets: int, known: int, tokens: int, hot: np.ndarray, parts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(*_payload(row["data"]))
                yield _scores(segment, row, buckets, known, tokens, hot, parts, batch.schema.field("ids").type)

    return run


def _payload(data: bytes) -> list[np.ndarray]:
    words, token, counts, train = unpacked(data, "<u8", "<i4", "<i8", "?")
    return [words[token], counts, train]


def _joined(rows: list[dict], *kinds: str) -> list[np.ndarray]:
    return [np.concatenate(p) for p in zip(*(unpacked(r["data"], *kinds) for r in rows))]


def _scores(segment: Segment, row: dict, buckets: int, known: int, tokens: int, hot: np.ndarray, parts: np.ndarray, ids) -> pa.RecordBatch:
    replies = {name: sorted(row[name], key=lambda r: r["bucket"]) for name in ("words", "pairs")}
    count, chance = np.empty(len(segment.words)), np.empty(len(segment.context))
    count[segment.word_order(buckets)[0]] = _joined(replies["words"], "<i8")[0]
    chance[segment.pair_order(buckets, hot, parts)[0]] = _joined(replies["pairs"], "<f4")[0]
    rows = len(segment.counts)
    base = np.log10((count + ADD) / (tokens + ADD * (known + 1)))
    by_doc = lambda values: np.bincount(segment.doc, values, rows)
    return pa.RecordBatch.from_arrays([
        pa.array(row["ids"], ids.value_type), pa.array(segment.counts), pa.array(by_doc(count[segment.token] > 0).astype(np.int64)),
        pa.array(np.full(rows, tokens), pa.int64()), pa.array(by_doc(base[segment.token])),
        pa.array(by_doc(np.log10(chance)[segment.pair])),
    ], names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment with its ids, distinct words, tokens, counts and folds."""
    first = TaskContext.get().partitionId() << 32
    for number, batch in enumerate(bounded(batches, "text", SEGMENT_BYTES)):
        found = hasher().find(*raw(batch.column("text")))
        words, token, often = np.unique(found.hashes, return_inverse=True, return_counts=True)
        # Frequent words first: small numbers pack well.
        order = np.argsort(-often, kind="stable")
        place = np.empty(len(order), "<i4")
        place[order] = np.arange(len(order))
        words, token = words[order], place[token]
        train = batch.column("train").fill_null(False).to_numpy(zero_copy_only=False)
        data = packed(words.astype("<u8"), token.astype("<i4"), found.counts.astype("<i8"), train)
        yield pa.RecordBatch.from_arrays(
            [pa.array([first + number], pa.int64()), pa.array([batch.column("id").to_pylist()], pa.list_(batch.column("id").type)),
             pa.array([data], pa.binary())], names=["segment", "ids", "data"])


def _of(sent: DataFrame, *kinds: int) -> DataFrame:
    return sent.where(F.col("kind").isin(*kinds)).select("kind", "bucket", "parent", "segment", "data")


def _split_tables(sent: DataFrame) -> dict[int, int]:
    found = sent.where(F.col("kind") == FIGURES).select(F.explode(F.arrays_zip("hot", "hot_tables")).alias("x")).groupBy("x.hot").agg(
        F.sum("x.hot_tables").alias("t")).collect()
    return {int(r.hot) % 2 ** 64: r.t for r in found}


def _chance_replies(
    scratch: Scratch, counted: DataFrame, parents: int, known: int, visits: dict[int, int], hot: np.ndarray, seed: int,
) -> DataFrame:
    """bucket, segment, data: the mean predictive probabilities of the pairs of each segment, after all sweeps."""
    store = lambda df, label: scratch.store(df, label, compression="none")
    pairs = store(counted.groupBy("bucket").applyInArrow(_sum_pairs(parents, hot), SENT), "pairs")
    places = store(_of(pairs, NAMES, SUMS).groupBy("parent").applyInArrow(_place_words, SENT), "places")
    discount, parent_discount = (_discount(*(x or 0 for x in df.agg(F.sum("once"), F.sum("twice")).first())) for df in (pairs, places))
    seating, before = pairs, known
    for sweep in range(BURN_IN + SAMPLES + 1):
        answer = store(_of(places, PLACES).union(_of(seating, SUMS)).groupBy("parent").applyInArrow(
            _seat_parent(known, before, parent_discount, sweep, seed), SENT), "parent")
        customers, before = (x or 0 for x in answer.agg(F.sum("customers"), F.sum("tables")).first())
        split = _split_tables(seating) if len(hot) else {}
        state = Sweep(customers, before, split, visits, discount, parent_discount, known)
        here = _of(seating, TABLES, CHANCES).union(_of(answer, ANSWER))
        if sweep == BURN_IN + SAMPLES:
            return store(_of(pairs, PAIRS, ASKED).union(here).groupBy("bucket").applyInArrow(
                _chances(state), "bucket int, segment long, data binary"), "chances")
        seats = store(_of(pairs, PAIRS).union(here).groupBy("bucket").applyInArrow(_seat_pairs(state, sweep, hot, seed), SENT), "seated")
        scratch.drop(answer)
        if seating is not pairs:
            scratch.drop(seating)
        seating = seats
    raise AssertionError("the last sweep returns")


def score(docs: DataFrame, train: Column, *, id_column: str = "doc_id", text_column: str = "text", hot: int = HOT,
          bucket_bytes: int = SEGMENT_BYTES, seed: int = 1) -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score, score of each row; ``train`` tells the rows to learn from.

    ``base_score`` is the log10 probability of the tokens by their counts alone, each raised by a tenth.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), train.alias("train"))
    kind = rows.schema["id"].dataType.simpleString()
    small_batches(docs.sparkSession)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, -(-size // bucket_bytes))
    sent = "bucket int, segment long, data binary"
    with Scratch(docs.sparkSession) as scratch:
        bodies = scratch.store(rows.mapInArrow(_bodies, f"segment long, ids array<{kind}>, data binary"), "segments", compression="none")
        segments = bodies.select("segment", "data")
        words = scratch.store(segments.mapInArrow(_word_counts(buckets), sent).groupBy("bucket").applyInArrow(
            _sum_words(hot), WORDS), "words", compression="none")
        stats = words.where("segment IS NULL")
        v, n = (x or 0 for x in stats.agg(F.sum("v"), F.sum("n")).first())
        known = {int(h) % 2 ** 64: c for r in stats.where(F.size("hot") > 0).select("hot", "hot_n").collect() for h, c in zip(*r)}
        if int(END) in known:
            known[int(BEGIN)] = known[int(END)]
        names = np.array(sorted(known), np.uint64)
        parts = np.array([-(-known[int(h)] // hot) for h in names], np.uint64)
        counted = segments.mapInArrow(_pair_counts(buckets, names, parts), sent)
        pairs = _chance_replies(scratch, counted, -(-buckets // PER_PARENT), v, known, names, seed)
        scratch.keep(bodies, words, pairs)

    def gathered(replies: DataFrame, name: str) -> DataFrame:
        return replies.where("segment IS NOT NULL").groupBy("segment").agg(
            F.collect_list(F.struct("bucket", "data")).alias(name))

    joined = bodies.join(gathered(words, "words"), "segment").join(gathered(pairs, "pairs"), "segment")
    return joined.mapInArrow(
        _scored(buckets, v, n, names, parts),
        f"id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
