"""Toxicity classifier on words, regularised by counterfactual swaps of identity terms.

Every distinct word of a text has a chance of being toxic, a logistic function of learned weights of the word and of its
hashed character n-grams. A text is toxic unless all its words are not (noisy-or), so one word in a long text counts.
Sentences of the labelled texts that mention a group are repeated with the term swapped for another of its kind, and
the difference between the two scores is penalised: a mention of one group must not weigh more than that of another.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfeat.llm import labels as labelled
from ledgerfeat.llm.subword import Words
from ledgerfeat.llm.text import texts_of

#: The only bound of the training sample: documents.
TRAIN_ROWS = 4_000
BITS = 18
ORDERS = (3, 4, 5)
EPOCHS, BATCH, RATE, DECAY = 6, 128, 0.3, 1e-6
SWAP_PENALTY = 5.0
START = -6.0
THRESHOLD = 0.3

# Identity terms by kind; terms of one row can stand in for each other.
IDENTITY_TERMS = (
    "women men girls boys females males people",
    "woman man girl boy female male person",
    "muslims christians jews hindus buddhists sikhs atheists catholics protestants",
    "muslim christian jewish hindu buddhist sikh atheist catholic protestant",
    "black white asian african european american latino hispanic arab indian chinese mexican",
    "gay lesbian straight bisexual transgender queer heterosexual homosexual",
    "immigrants refugees foreigners migrants citizens natives",
    "old young elderly disabled blind deaf",
    "frauen männer mädchen jungen", "muslime christen juden hindus buddhisten", "ausländer flüchtlinge migranten bürger",
    "femmes hommes filles garçons", "musulmans chrétiens juifs hindous bouddhistes", "étrangers réfugiés migrants citoyens",
    "mujeres hombres niñas niños", "musulmanes cristianos judíos hindúes budistas", "extranjeros refugiados migrantes ciudadanos",
)
SENTENCE = re.compile(r"[^.!?\n]+")
TERM = re.compile(r"\w+")


def swapped_sentences(text: str, terms: dict[str, list[str]], seed: int = 0) -> list[tuple[str, str]]:
    """Sentences with identity terms, each with a copy in which every term is another of its kind."""
    out = []
    for sentence in SENTENCE.findall(text):
        turn = seed + len(sentence)
        changed = TERM.sub(lambda m: terms[m[0]][turn % len(terms[m[0]])] if m[0] in terms else m[0], sentence)
        if changed != sentence:
            out.append((sentence, changed))
    return out


def term_table(rows: tuple[str, ...] = IDENTITY_TERMS) -> dict[str, list[str]]:
    """For each identity term the others of its kind."""
    table: dict[str, list[str]] = {}
    for row in rows:
        kind = row.split()
        for term in kind:
            table[term] = [t for t in kind if t != term]
    return table


def _word_entries(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Number of buckets of each distinct word, and the buckets: the word itself and its n-grams."""
    words = Words(text).distinct()
    owners, buckets = [np.arange(len(words.hashes))], [(words.hashes >> np.uint64(64 - BITS)).astype(np.int64)]
    for order in ORDERS:
        owner, found = words.entries(order, BITS)
        owners.append(owner)
        buckets.append(found)
    owner, bucket = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owner, kind="stable")
    return np.bincount(owner, minlength=len(words.hashes)), bucket[order]


def _entry_batches(batches: Iterator[pa.RecordBatch], terms: dict[str, list[str]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, label, text in zip(batch.column("id").to_pylist(), batch.column("label").to_pylist(), texts_of(batch, "text")):
            text = text.lower()
            parts = [(0, text)]
            for i, (plain, changed) in enumerate(swapped_sentences(text, terms), 1):
                parts += [(i, plain), (i, changed)]
            for part, content in parts:
                counts, buckets = _word_entries(content)
                rows.append((key, label, part, counts.astype(np.int32).tobytes(), buckets.astype(np.int32).tobytes()))
        types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        columns = list(zip(*rows)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)],
                                         names=["id", "label", "part", "counts", "buckets"])


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def word_values(self, words: Words) -> np.ndarray:
        values = self.weights[(words.hashes >> np.uint64(64 - BITS)).astype(np.int64)] + self.bias
        for order in ORDERS:
            values = values + words.sums(order, BITS, self.weights)
        return values

    def score(self, text: str) -> float:
        values = self.word_values(Words(text.lower()))
        if not len(values):
            return 0.0
        # Few words have any weight to speak of; repeats of those are told apart by their value.
        likely = np.unique(np.round(values[values > -16], 6))
        return float(-np.expm1(-np.logaddexp(0, likely).sum()))


Sample = tuple[np.ndarray, np.ndarray, int]


def fit(texts: Sequence[Sample], pairs: Sequence[tuple[Sample, Sample]], seed: int = 3) -> ToxicityModel:
    """Weights by stochastic gradient descent on the noisy-or likelihood plus the penalty on swapped pairs.

    Without texts the model calls nothing toxic.
    """
    weights, moved = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6)
    bias = START
    rng = np.random.default_rng(seed)

    def forward(samples: list[Sample]):
        sizes = [len(s[0]) for s in samples]
        counts = np.concatenate([s[0] for s in samples])
        buckets = np.concatenate([s[1] for s in samples])
        word = np.repeat(np.arange(len(counts)), counts)
        values = np.bincount(word, weights[buckets], len(counts)) + bias
        owner = np.repeat(np.arange(len(samples)), sizes)
        total = np.bincount(owner, np.logaddexp(0, values), len(samples))
        return buckets, word, owner, 1 / (1 + np.exp(-values)), total

    def update(buckets: np.ndarray, word: np.ndarray, pull: np.ndarray, rate: float) -> None:
        grad = np.bincount(buckets, pull[word], 1 << BITS)
        used = np.flatnonzero(grad)
        moved[used] += grad[used] ** 2
        weights[used] -= rate * (grad[used] / np.sqrt(moved[used]) + DECAY * weights[used])

    steps, step = EPOCHS * max(1, -(-len(texts) // BATCH)), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            rate = RATE * (1 - step / steps)
            step += 1
            samples = [texts[i] for i in order[at:at + BATCH]]
            buckets, word, owner, chance, total = forward(samples)
            label = np.array([s[2] for s in samples])
            # Loss: the sum of log-odds terms for clean texts, -log(1 - exp(-sum)) for toxic ones.
            slope = np.where(label == 1, -1 / np.expm1(np.maximum(total, 1e-9)), 1.0)
            update(buckets, word, chance * slope[owner], rate)
            if pairs:
                drawn = [pairs[i] for i in rng.integers(0, len(pairs), min(len(pairs), BATCH))]
                buckets, word, owner, chance, total = forward([s for pair in drawn for s in pair])
                gap = total[0::2] - total[1::2]
                slope = 2 * SWAP_PENALTY * np.stack([gap, -gap], axis=1).ravel()
                update(buckets, word, chance * slope[owner], rate)
    return ToxicityModel(weights.astype(np.float32), bias)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
          rows: int = TRAIN_ROWS, terms: tuple[str, ...] = IDENTITY_TERMS) -> ToxicityModel:
    """Fits on at most ``rows`` labelled documents; their hashed words come to a temporary file of the driver."""
    table = term_table(terms)
    sample = labelled.training_sample(docs, labels, label, rows, id_col, text_col)
    entries = sample.mapInArrow(lambda it: _entry_batches(it, table),
                                "id long, label int, part int, counts binary, buckets binary")
    spool, found = labelled.Spool(), []
    for r in entries.toLocalIterator():
        if r["counts"]:
            found.append((r["id"], r["part"], (spool.add(r["counts"], r["buckets"]), r["label"])))
    texts = [s for _, part, s in sorted(found, key=lambda f: f[:2]) if part == 0]
    sides: dict[tuple[int, int], list[tuple]] = {}
    for key, part, s in found:
        if part:
            sides.setdefault((key, part), []).append(s)
    pairs = [(v[0], v[1]) for _, v in sorted(sides.items(), key=lambda kv: kv[0]) if len(v) == 2]

    def read(stored: tuple) -> Sample:
        counts, buckets = spool.read(stored[0], np.int32, np.int32)
        return counts, buckets, stored[1]

    return fit(labelled.Stored(texts, read), labelled.Stored(pairs, lambda pair: (read(pair[0]), read(pair[1]))))


def _score_batches(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = np.array([model.score(t) for t in texts_of(batch, "text")], np.float64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())],
            names=["doc_id", "held_out", "score"])


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` for every row of ``docs``.

    Null and empty texts score 0. Only the text enters the score. Repeated rows get equal scores; other columns are not
    read. An empty table gives an empty table.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), labelled.held_out(id_col).alias("held_out"),
                         F.col(text_col).alias("text"))
    scored = source.mapInArrow(lambda it: _score_batches(it, model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``; columns stay as they are."""
    columns, schema = docs.columns, docs.schema
    place = columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([model.score(t) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(keep, schema)
