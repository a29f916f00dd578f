"""Quality grades by ordinal cumulative-link regression on hashed text.

A labelled document has a grade: 0 toxic, 1 of low quality, 2 good.  One
weight per feature is shared by all grades; with ordered thresholds t,
P(grade <= k) = sigmoid(t[k] - w.x).  Features are the 64-bit hashes of the
words of a document (``WORD_PATTERN``, A-Z lower-cased), of beginnings of its
words, as an inflected word is rare in each of its forms, and of its shape: bins of the shares of capitals, digits, other signs and line feeds, of
the share of distinct words and of the length of words.  Only features that
depend on the grade beyond chance have a weight.

The model is fitted on at most ``LABELLED`` labelled documents, chosen by the
hash of their id.  Spark counts their features and picks the ``FEATURES`` that
depend on the grade most; the weights are fitted on the driver.  Scoring covers
every document.

A document is kept if its tail probability P(grade 2) reaches ``KEEP``.  Null
and empty texts have no words and the lowest bins.  Labels with a null in
them do not count; of several labels of an id the lowest grade counts, and
rows with a labelled id are all labelled.  If fewer than two grades are
labelled, nothing can be learnt: every document has the only grade (or 2) and
is kept.  Repeated rows are scored each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import pin

from .shared import share, shared
from .textbytes import MULTIPLIERS, SpanHashes, chunks, lower_table, mix, word_spans, word_table

#: Most labelled documents that the model is fitted on, and most features that get a weight.
LABELLED, FEATURES = 8000, 1024

#: Labelled documents that a feature must occur in, and how unlikely its link with the grade must be by chance.
LEAST_DOCS, CHANCE = 5, 18.0

#: Tail probability from which a document is kept.
KEEP = 0.5

GRADES = 3

#: Bytes of the beginnings of words.
BEGINNINGS = (4, 6, 8)
RIDGE, STEPS = 1e-5, 500

#: Upper edges of the bins of shares of bytes, of distinct words and of bytes per word.
_SHARES = np.array([0.001, 0.003, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.5, 0.8])
_DISTINCT = np.array([0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])
_WORD_BYTES = np.array([1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 8.0, 10.0, 15.0, 30.0])


@dataclass
class Model:
    """Sorted feature hashes with their weights, and the thresholds; at most ``FEATURES`` weights."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    fixed: int | None = None

    def below(self, scores: np.ndarray) -> np.ndarray:
        """P(grade <= k) for every score and threshold."""
        return 1.0 / (1.0 + np.exp(np.clip(scores[:, None] - self.thresholds, -60, 60)))

    def judge(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and probability of the highest grade."""
        if self.fixed is not None:
            return np.full(len(scores), float(self.fixed)), np.ones(len(scores))
        below = self.below(scores)
        return (1.0 - below).sum(axis=1), 1.0 - below[:, -1]


class Features:
    """Distinct features of texts."""

    def __init__(self) -> None:
        self.hashes, self.lower, self.words = SpanHashes(MULTIPLIERS[0]), lower_table(), word_table()
        byte = np.arange(256)
        capital = (byte >= 65) & (byte <= 90)
        digit = (byte >= 48) & (byte <= 57)
        feed = byte == 10
        blank = np.isin(byte, [9, 11, 12, 13, 32])
        sign = (byte < 128) & ~(capital | digit | feed | blank | ((byte >= 97) & (byte <= 122)) | np.isin(byte, list(b".,'-")))
        self.kinds = [capital, digit, feed, sign]

    def of(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Text and feature; a pair may come several times, in groups of one kind of feature."""
        n = len(offsets) - 1
        lower = self.lower[data]
        starts, ends, bounds = word_spans(lower, offsets, self.words)
        text = np.repeat(np.arange(n), np.diff(bounds))
        hashes = self.hashes.load(lower)
        words = hashes.of(starts, ends)
        yield text, words
        for size in BEGINNINGS:
            long = np.flatnonzero(ends - starts >= size)
            yield text[long], mix(hashes.of(starts[long], starts[long] + size) + np.uint64(size))
        size, count = np.maximum(np.diff(offsets), 1), np.maximum(np.diff(bounds), 1)
        bins = [
            np.searchsorted(_SHARES, np.diff(np.concatenate(([0], np.cumsum(kind[data])))[offsets]) / size) for kind in self.kinds
        ]
        owner, _ = distinct(text, words)
        bins.append(np.searchsorted(_DISTINCT, np.bincount(owner, minlength=n) / count))
        spelled = np.concatenate(([0], np.cumsum(ends - starts)))[bounds]
        bins.append(np.searchsorted(_WORD_BYTES, np.diff(spelled) / count))
        for k, b in enumerate(bins):
            yield np.arange(n), mix((b + 64 * (k + 1)).astype(np.uint64))


def distinct(text: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every pair once, text by text."""
    order = np.lexsort((feature, text))
    text, feature = text[order], feature[order]
    new = np.ones(len(order), bool)
    new[1:] = (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])
    return text[new], feature[new]


def grades_of(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``grade`` of labels (``doc_id``, ``quality``, ``toxic``)."""
    grade = F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).otherwise(1)
    sound = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    return sound.groupBy("doc_id").agg(F.min(grade).alias("grade"))


def _sample(docs: DataFrame, grades: DataFrame, labelled: int) -> DataFrame:
    """Text and grade of the documents that the model is fitted on."""
    chosen = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    # at most ``labelled`` rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # the limit only acts where ids are repeated
    return pin(rows.select("text", F.col("grade").cast("long").alias("grade")).limit(labelled))


def _links(rows: DataFrame, per_grade: list[int]) -> DataFrame:
    """Features by how their presence depends on the grade, as twice the log likelihood ratio."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            grades = batch.column("grade").to_numpy()
            for row, end, data, offsets in chunks(batch.column("text")):
                text, feature = distinct(*map(np.concatenate, zip(*features.of(data, offsets), strict=True)))
                known, column = np.unique(feature, return_inverse=True)
                grade = grades[row:end][text]
                seen = [np.bincount(column[grade == k], minlength=len(known)) for k in range(GRADES)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(known.view(np.int64)), *map(pa.array, seen)], names=["feature", *_SEEN]
                )

    counted = rows.mapInArrow(run, "feature long, " + ", ".join(f"{c} long" for c in _SEEN))
    counted = counted.groupBy("feature").agg(*[F.sum(c).alias(c) for c in _SEEN])
    total, n = sum(F.col(c) for c in _SEEN), sum(per_grade)
    link = F.lit(0.0)
    for c, of_grade in zip(_SEEN, per_grade, strict=True):
        share, absent = of_grade / n, of_grade - F.col(c)
        link += F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (total * share))).otherwise(0.0)
        link += F.when(absent > 0, absent * F.log(absent / ((n - total) * share))).otherwise(0.0)
    return counted.filter(total >= LEAST_DOCS).select("feature", (2 * link).alias("link"))


_SEEN = [f"seen_{k}" for k in range(GRADES)]


def train(docs: DataFrame, grades: DataFrame, labelled: int = LABELLED) -> Model:
    """Fit the model on documents (``doc_id``, ``text``) with a grade (``doc_id``, ``grade``)."""
    rows = _sample(docs, grades, labelled)
    counts = {r["grade"]: r["count"] for r in rows.groupBy("grade").count().collect()}
    if len(counts) < 2:
        only = next(iter(counts), GRADES - 1)
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(GRADES - 1), only)
    links = _links(rows, [counts.get(k, 0) for k in range(GRADES)]).filter(F.col("link") > CHANCE)
    best = links.orderBy(F.desc("link"), "feature").limit(FEATURES).collect()
    known = np.sort(np.array([r["feature"] for r in best], np.int64).view(np.uint64))
    plain = Model(known, np.zeros(len(known)), np.zeros(GRADES - 1))
    block = share(docs.sparkSession, plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared(block))
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column("text")):
                text, slot = scorer.known(data, offsets)
                bounds = np.searchsorted(text, np.arange(end - row + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(slot.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("grade").slice(row, end - row), lists], names=["grade", "slots"])

    # at most ``labelled`` rows of at most ``FEATURES`` small numbers
    table = rows.mapInArrow(run, "grade long, slots array<int>").toArrow()
    grade = table.column("grade").to_numpy()
    lists = table.column("slots")
    x = np.zeros((len(grade), len(known)), np.float32)
    x[np.repeat(np.arange(len(grade)), pc.list_value_length(lists).to_numpy()), pc.list_flatten(lists).to_numpy()] = 1.0
    weights, thresholds = _descend(x, grade)
    return Model(known, weights, thresholds)


def _descend(x: np.ndarray, grade: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Adam on the mean negative log likelihood with a ridge; thresholds stay ordered as a start and positive gaps."""
    n, width = x.shape
    share = np.clip(np.cumsum(np.bincount(grade, minlength=GRADES))[:-1] / n, 0.01, 0.99)
    start = np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(start), 0.1))
    params = np.concatenate((np.zeros(width), start[:1], gaps))
    first, second = np.zeros_like(params), np.zeros_like(params)
    rows = np.arange(n)
    for step in range(1, STEPS + 1):
        weights, edges = params[:width], np.exp(params[width + 1 :])
        thresholds = params[width] + np.concatenate(([0.0], np.cumsum(edges)))
        scores = x @ weights.astype(np.float32)
        below = 1.0 / (1.0 + np.exp(np.clip(scores[:, None] - thresholds, -60, 60)))
        below = np.concatenate((np.zeros((n, 1)), below, np.ones((n, 1))), axis=1)
        slope = below * (1 - below)
        mass = np.maximum(below[rows, grade + 1] - below[rows, grade], 1e-12)
        by_score = (slope[rows, grade + 1] - slope[rows, grade]) / mass / n
        by_threshold = np.zeros((n, GRADES + 1))
        by_threshold[rows, grade + 1] -= slope[rows, grade + 1] / mass / n
        by_threshold[rows, grade] += slope[rows, grade] / mass / n
        by_threshold = by_threshold[:, 1:GRADES].sum(axis=0)
        gradient = np.concatenate(
            (
                x.T @ by_score.astype(np.float32) + RIDGE * weights,
                [by_threshold.sum()],
                np.cumsum(by_threshold[::-1])[::-1][1:] * edges,
            )
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        rate = 0.2 if step < STEPS * 2 // 3 else 0.03
        params = params - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    edges = np.exp(params[width + 1 :])
    return params[:width], params[width] + np.concatenate(([0.0], np.cumsum(edges)))


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.features = model, Features()
        self.heads = np.zeros(1 << 16, bool)  # first 16 bits of the known features: most others end here
        self.heads[(model.features >> np.uint64(48)).astype(np.int64)] = True

    def known(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and number of the known features in it, each pair once."""
        known = self.model.features
        if not len(known):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        texts, slots = [], []
        for text, feature in self.features.of(data, offsets):
            near = np.flatnonzero(self.heads[(feature >> np.uint64(48)).astype(np.int64)])
            slot = np.searchsorted(known, feature[near])
            slot[slot == len(known)] = 0
            same = known[slot] == feature[near]
            texts.append(text[near[same]])
            slots.append(slot[same])
        return distinct(np.concatenate(texts), np.concatenate(slots))

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        text, slot = self.known(data, offsets)
        return np.bincount(text, self.model.weights[slot], minlength=len(offsets) - 1)


def judge(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """Per document ``doc_id``, ``expected_grade``, ``tail_probability`` and ``keep``."""
    block = share(docs.sparkSession, model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared(block))
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column("text")):
                expected, tail = scorer.model.judge(scorer.scores(data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, end - row), pa.array(expected), pa.array(tail), pa.array(tail >= keep)],
                    names=["doc_id", "expected_grade", "tail_probability", "keep"],
                )

    schema = f"doc_id {kind}, expected_grade double, tail_probability double, keep boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """The documents that are kept, with all their columns."""
    block = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared(block))
        for batch in batches:
            for row, end, data, offsets in chunks(batch.column("text")):
                good = scorer.model.judge(scorer.scores(data, offsets))[1] >= keep
                yield batch.slice(row, end - row).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
