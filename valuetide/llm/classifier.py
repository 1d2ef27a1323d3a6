"""Quality classifier: logistic regression on hashed word n-grams.

Words stand in three forms: as they are, by shape (letters and digits folded,
signs kept), and a mark where a word follows itself.  Single words and pairs
are hashed into ``DIMENSIONS`` slots; a document is its vector of counts,
scaled to length one.  Training is follow-the-regularised-leader with
per-coordinate rates; most weights stay exactly zero.

The model is fitted on at most ``TRAIN_ROWS`` labelled documents, those whose
ids hash lowest.  Their features are made on the executors, and one task reads
that bounded set; what it returns is one vector of ``DIMENSIONS`` weights,
which is broadcast.  Scoring is a narrow map over all documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_fold

DIMENSIONS = 1 << 18
TRAIN_ROWS = 20_000
FOLDS = 5
EPOCHS = 3
THRESHOLD = 0.3
# Rates and penalties of the updates.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.1

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
RUNS = re.compile(r"([A-Za-z\x80-\U0010FFFF])\1*")
MIX = np.uint64(0x9E3779B97F4A7C15)
CACHE_WORDS = 200_000


def shape(word: str) -> str:
    """Case and digits folded, equal neighbours joined: 'Abc!!' becomes 'Aa!!'."""
    kinds = (
        "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word
    )
    return RUNS.sub(r"\1", "".join(kinds))


class Features:
    """Hashes texts to sparse vectors; keeps the hashes of recent words."""

    def __init__(self, dimensions: int):
        self.shift = np.uint64(64 - (dimensions.bit_length() - 1))
        self.known: dict[str, tuple[int, int]] = {}

    def _pair(self, word: str) -> tuple[int, int]:
        if (pair := self.known.get(word)) is None:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            pair = (
                xxhash.xxh64_intdigest(word.lower(), 1),
                xxhash.xxh64_intdigest(shape(word), 2),
            )
            self.known[word] = pair
        return pair

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(slots, values), slots ascending; a text without words has none."""
        found = WORDS.findall(text or "")
        if not found:
            return np.empty(0, np.int32), np.empty(0, np.float32)
        both = np.array(list(map(self._pair, found)), np.uint64)
        words, shapes = both[:, 0], both[:, 1]
        again = words[1:] == words[:-1]
        with np.errstate(over="ignore"):
            parts = (
                words * MIX,
                shapes * MIX,
                (words[:-1] * np.uint64(3) + words[1:]) * MIX,
                (shapes[:-1] * np.uint64(5) + shapes[1:]) * MIX,
                (np.flatnonzero(again) * 0 + 7).astype(np.uint64) * MIX,
            )
        slots, counts = np.unique(np.concatenate(parts) >> self.shift, return_counts=True)
        values = counts / math.sqrt(float(np.square(counts, dtype=np.float64).sum()))
        return slots.astype(np.int32), values.astype(np.float32)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], dimensions: int, epochs: int) -> np.ndarray:
    """FTRL-proximal over the rows in order; slot ``dimensions`` is the bias."""
    z, n = np.zeros(dimensions + 1), np.zeros(dimensions + 1)

    def weights(at):
        pull = np.where(np.abs(z[at]) <= L1, 0.0, z[at] - np.sign(z[at]) * L1)
        return -pull / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for slots, values, label in rows:
            at = np.append(slots, dimensions)
            x = np.append(values, 1.0)
            w = weights(at)
            gradient = (1 / (1 + math.exp(-max(min(float(w @ x), 35.0), -35.0))) - label) * x
            step = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - step * w
            n[at] += gradient**2
    return weights(np.arange(dimensions + 1)).astype(np.float32)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    train_rows: int = TRAIN_ROWS,
    dimensions: int = DIMENSIONS,
    epochs: int = EPOCHS,
) -> np.ndarray:
    """Weights learned from labelled documents outside the held-out fold.

    Labels that are neither 0 nor 1, and those of NULL ids, are left out; of
    several labels of one id the largest counts.  Without any label all weights
    are zero and every score is 0.5.
    """
    usable = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (crc_fold(F.col("doc_id"), FOLDS) != 0))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("__label"))
        .select(F.col("doc_id").alias("__id"), "__label", F.xxhash64("doc_id").alias("__order"))
        .orderBy("__order", "__id")
        .limit(train_rows)
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features(dimensions)
        for batch in batches:
            vectors = [make(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([v[0] for v in vectors], pa.list_(pa.int32())),
                    pa.array([v[1] for v in vectors], pa.list_(pa.float32())),
                    batch.column(1),
                    batch.column(2),
                ],
                ["slots", "values", "label", "order"],
            )

    # At most train_rows ids of 20 bytes: small enough to send to every task.
    sample = docs.join(F.broadcast(usable), F.col("doc_id") == F.col("__id"))
    vectors = sample.select("text", "__label", "__order").mapInArrow(
        features, "slots array<int>, values array<float>, label int, order long"
    )

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows["size"] = rows["slots"].map(len)
        rows = rows.sort_values(["order", "size"], kind="stable")
        found = fit(list(zip(rows["slots"], rows["values"], rows["label"])), dimensions, epochs)
        return pd.DataFrame({"weights": [found.tobytes()]})

    model = vectors.groupBy(F.lit("all")).applyInPandas(learn, "weights binary").first()
    if model is None:
        return np.zeros(dimensions + 1, np.float32)
    return np.frombuffer(bytes(model.weights), np.float32)


def score(docs: DataFrame, weights: np.ndarray, name: str = "score") -> DataFrame:
    """``docs`` with a double ``name`` (replaced if there): how likely label 1 is.

    A NULL text scores as an empty one: by the bias alone.
    """
    model = docs.sparkSession.sparkContext.broadcast(weights.tobytes())
    dimensions = len(weights) - 1

    @F.pandas_udf(T.DoubleType())
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        make, w = Features(dimensions), np.frombuffer(model.value, np.float32)
        for texts in parts:
            sums = []
            for text in texts:
                slots, values = make(text)
                sums.append(float(w[slots] @ values) + float(w[dimensions]))
            yield pd.Series(1 / (1 + np.exp(-np.array(sums, float))))

    return docs.withColumn(name, of("text"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest row of each document."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id",
        (crc_fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score of at least ``threshold``."""
    scored = score(docs, train(docs, labels), "__score")
    return scored.filter(F.col("__score") >= threshold).drop("__score")
