"""Quality classifier on supervised subword embeddings.

Words and character n-grams are hashed into one table of learned vectors. A document is the average of the vectors of all
its words and n-grams; a softmax over the classes reads the average. Vectors and output weights are learned together by
stochastic gradient descent in numpy on a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfeat.llm import labels as labelled
from ledgerfeat.llm.subword import Words, ngram_buckets
from ledgerfeat.llm.text import texts_of

#: The only bound of the training sample: documents.
TRAIN_ROWS = 5_000
BITS, DIMENSIONS = 16, 8
ORDERS = (3, 5)
EPOCHS, BATCH, RATE = 6, 64, 0.5
THRESHOLD = 0.7


def features(text: str) -> np.ndarray:
    """Buckets of all words and n-grams of a text, repeats kept. A word that repeats the one before it has a bucket of its own."""
    words = Words(text)
    found = [ngram_buckets(words.data, order, BITS) for order in ORDERS]
    buckets = (words.hashes >> np.uint64(64 - BITS)).astype(np.int64)
    repeats = np.zeros(int((words.hashes[1:] == words.hashes[:-1]).sum()), np.int64)
    return np.concatenate([*found, buckets, repeats]) if len(words.hashes) else np.zeros(0, np.int64)


def _entry_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, values = [], []
        for text in texts_of(batch, "text"):
            buckets, counts = np.unique(features(text), return_counts=True)
            keys.append(buckets.astype(np.int32).tobytes())
            values.append((counts / max(counts.sum(), 1)).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), pa.array(keys, pa.binary()), pa.array(values, pa.binary())],
            names=["id", "label", "keys", "shares"])


@dataclass
class QualityModel:
    """Weight of each bucket for class 1 against class 0, its share of a document being 1, and the bias."""

    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        found = features(text)
        value = self.bias + (float(self.weights[found].mean()) if len(found) else 0.0)
        return 1.0 / (1.0 + np.exp(-np.clip(value, -30, 30)))


def fit(rows: Sequence[tuple[np.ndarray, np.ndarray, int]], seed: int = 5) -> QualityModel:
    """Vectors, output weights and bias by gradient descent with a rate that falls to zero.

    Without rows, or with one class only, the model answers with the share of class 1 (0.5 without rows).
    """
    targets = np.array([label for _, _, label in rows], np.float32)
    if not len(rows) or targets.min() == targets.max():
        share = (targets.sum() + 0.5) / (len(rows) + 1)
        return QualityModel(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (1 << BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    output = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.zeros(2, np.float32)
    # Step sizes adapt to how often a bucket has moved, since most are rare.
    moved_v, moved_o, moved_b = np.full(vectors.shape, 1e-8, np.float32), np.full(output.shape, 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    steps = EPOCHS * -(-len(rows) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            picked = order[at:at + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            batch = [rows[i] for i in picked]
            keys = np.concatenate([r[0] for r in batch])
            shares = np.concatenate([r[1] for r in batch])
            owner = np.repeat(np.arange(len(picked)), [len(r[0]) for r in batch])
            entries = vectors[keys] * shares[:, None]
            mean = np.stack([np.bincount(owner, entries[:, d], len(picked)) for d in range(DIMENSIONS)], axis=1)
            logits = mean @ output + bias
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(picked)), targets[picked].astype(int)] -= 1
            grad_o, grad_b, grad_mean = mean.T @ p / len(picked), p.mean(axis=0), (p @ output.T).astype(np.float32)
            used, inverse = np.unique(keys, return_inverse=True)
            pushed = grad_mean[owner] * shares[:, None]
            grad_v = np.stack([np.bincount(inverse, pushed[:, d], len(used)) for d in range(DIMENSIONS)], axis=1)
            for table, moved, grad, at_rows in ((output, moved_o, grad_o, slice(None)), (bias, moved_b, grad_b, slice(None)),
                                                (vectors, moved_v, grad_v, used)):
                moved[at_rows] += grad * grad
                table[at_rows] -= (rate * grad / np.sqrt(moved[at_rows])).astype(np.float32)
    direction = output[:, 1] - output[:, 0]
    return QualityModel((vectors @ direction).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          rows: int = TRAIN_ROWS) -> QualityModel:
    """Fits on at most ``rows`` labelled documents; their hashed counts come to a temporary file of the driver."""
    sample = labelled.training_sample(docs, labels, label, rows, id_col, text_col)
    entries = sample.mapInArrow(_entry_batches, "id long, label int, keys binary, shares binary")
    spool = labelled.Spool()
    found = [(r["id"], spool.add(r["keys"], r["shares"]), r["label"]) for r in entries.toLocalIterator()]
    found.sort(key=lambda row: row[0])
    return fit(labelled.Stored(found, lambda row: (*spool.read(row[1], np.int32, np.float32), row[2])))


def _score_batches(batches: Iterator[pa.RecordBatch], model: QualityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = np.array([model.score(t) for t in texts_of(batch, "text")], np.float64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())],
            names=["doc_id", "held_out", "score"])


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` for every row of ``docs``.

    Null and empty texts get the score of the bias alone. Only the text enters the score. Repeated rows get equal scores;
    other columns are not read. An empty table gives an empty table.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), labelled.held_out(id_col).alias("held_out"),
                         F.col(text_col).alias("text"))
    scored = source.mapInArrow(lambda it: _score_batches(it, model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
