"""Ordinal regression on graded ratings: one weight per hashed word feature, ordered thresholds.

Cumulative link model: P(grade > j) = sigmoid(weights . features - threshold_j). All
thresholds share the weights, so the score of a text is one number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fundlens.llm.common import in_chunks, window_hashes, word_hashes

BITS = 15
TRAIN_ROWS = 6000
PENALTY = 1e-4
STEPS = 400
RATE = 0.05


def _features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text (buckets, values): words and word pairs with square-root counts, scaled to length one.

    The share of repeated pairs is a feature of its own, and so is the constant.
    """
    hashes, starts = word_hashes(texts)
    pairs = window_hashes(hashes, 2)
    for a, b in zip(starts[:-1], starts[1:]):
        own, double = hashes[a:b], pairs[a : max(a, b - 1)]
        keys = np.concatenate([own, double]) >> np.uint64(64 - BITS)
        buckets, counts = np.unique(keys.astype(np.int64), return_counts=True)
        values = np.sqrt(counts)
        values = values / np.sqrt((values**2).sum() or 1.0) * 3
        repeated = 1 - len(np.unique(double)) / len(double) if len(double) else 0.0
        extra = [repeated * 3, min(len(own), 100) / 100]
        yield np.append(buckets, [1 << BITS, (1 << BITS) + 1]), np.append(values, extra)


class OrdinalModel:
    """Weights of the buckets and ordered thresholds for the grades 0 .. len(thresholds)."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    @classmethod
    def fit(cls, rated: DataFrame, rows: int = TRAIN_ROWS) -> OrdinalModel:
        """Learn from (text, grade): about ``rows`` of them, chosen by a hash of the text, by full-batch Adam steps."""
        known = rated.where(F.col("text").isNotNull() & F.col("grade").isNotNull()).select("text", F.col("grade").cast("int").alias("grade"))
        total = known.count()
        draw = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) / 1_000_000
        sample = known if total <= rows else known.where(draw < rows / total)

        def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, found = batch.column(0).to_pylist(), []
                for start, end in in_chunks(texts):
                    found += _features(texts[start:end])
                columns = [
                    batch.column(1),
                    pa.array([b.astype(np.int32) for b, _ in found], pa.list_(pa.int32())),
                    pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["grade", "buckets", "vals"])

        table = sample.mapInArrow(featurize, "grade int, buckets array<int>, vals array<float>").toArrow()
        grades = table["grade"].to_numpy().astype(int)
        lists, values = table["buckets"].combine_chunks(), table["vals"].combine_chunks()
        if not len(grades):
            return cls(np.zeros((1 << BITS) + 2), np.zeros(1))
        sizes = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(grades)), sizes)
        return cls._descend(row, lists.flatten().to_numpy(), values.flatten().to_numpy().astype(float), grades)

    @classmethod
    def _descend(cls, row: np.ndarray, bucket: np.ndarray, value: np.ndarray, grades: np.ndarray) -> OrdinalModel:
        size, top = (1 << BITS) + 2, max(1, int(grades.max()))
        above = (grades[:, None] > np.arange(top)).astype(float)
        share = np.clip(above.mean(0), 1e-3, 1 - 1e-3)
        weights, first = np.zeros(size), -np.log(share / (1 - share))
        # Thresholds are the first one and positive steps, so they stay in order.
        state = np.concatenate([weights, first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
        mean, spread = np.zeros_like(state), np.zeros_like(state)
        for step in range(1, STEPS + 1):
            weights, start, gaps = state[:size], state[size], np.exp(state[size + 1 :])
            limits = start + np.concatenate([[0], np.cumsum(gaps)])
            score = np.bincount(row, weights[bucket] * value, len(grades))
            error = 1 / (1 + np.exp(limits[None, :] - score[:, None])) - above
            pull = np.bincount(bucket, (error.sum(1) / len(grades))[row] * value, size) + PENALTY * weights
            by_limit = -error.mean(0)
            tails = np.cumsum(by_limit[::-1])[::-1]
            slope = np.concatenate([pull, tails[:1], tails[1:] * gaps])
            mean, spread = 0.9 * mean + 0.1 * slope, 0.999 * spread + 0.001 * slope**2
            state = state - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
        gaps = np.exp(state[size + 1 :])
        return cls(state[:size], state[size] + np.concatenate([[0], np.cumsum(gaps)]))

    def tails(self, texts: list[str | None]) -> np.ndarray:
        """P(grade > j) per text and threshold."""
        scores = np.array([self.weights[b] @ v for b, v in _features(texts)])
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores.reshape(-1, 1), -60, 60)))


def grade_documents(docs: DataFrame, model: OrdinalModel, least_grade: int, least_tail: float = 0.5) -> DataFrame:
    """(doc_id, expected_grade, tail, selected): tail is P(grade >= least_grade), selected tells if it reaches the limit.

    A null or empty text gets the grade of a text without words; copies get equal grades and repeated rows stay,
    an empty table gives no rows, other columns are left out. A long text costs memory in proportion to its words.
    The tail of a grade above all that the model has learnt is 0; a least grade below 1 is an error.
    """
    if least_grade < 1:
        raise ValueError("every text has at least grade 0: ask for 1 or more")

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [model.tails(texts[a:b]) for a, b in in_chunks(texts)] or [np.zeros((0, len(model.thresholds)))]
            tails = np.vstack(found)
            tail = tails[:, least_grade - 1] if least_grade <= tails.shape[1] else np.zeros(len(tails))
            columns = [batch.column(0), pa.array(tails.sum(1)), pa.array(tail), pa.array(tail >= least_tail)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "expected_grade", "tail", "selected"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(grade, "doc_id long, expected_grade double, tail double, selected boolean")


def rated_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, grade) of labelled documents: 0 toxic, 1 neither toxic nor good, 2 good."""
    grade = F.when(F.col("toxic") == 1, 0).otherwise(1 + F.col("quality")).alias("grade")
    return docs.select("doc_id", "text").join(labels.select("doc_id", "quality", "toxic"), "doc_id").select("text", grade)
