"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

P(word | context) = P(class | context) * P(group | class, word before) * P(word | group). Frequent words are classes of their
own; all others fall into classes by their spelling, grouped by the frequent words they stand next to. The first factor is a
softmax over classes on hashed features of the context: the class before (bigram), the one before that (skip) and both (trigram).
The second is a softmax over the groups of the class, of which the frequent words of a class are one each and the others share
the rest by their hash; its features are the class and the word before, a frequent one exactly, any other by its hash. The third
is the smoothed share of the word in its group, where one more word stands for all unknown ones.

The counts of (classes before, class) and of (class, word before, group) over all training tokens hold all that the likelihood
depends on. They are gathered once; every gradient step runs over them in parallel.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfeat.llm.text import id_bucket, mix, span_hashes, texts_of, word_bounds
from ledgerfeat.session import pin

FOLDS, HELD_OUT = 10, 0
SMOOTHING = 0.1
#: Classes of one frequent word each (the end token is the first), classes of other words, and spellings told apart.
HEADS, TAILS, SPELLINGS = 64, 64, 1024
CLASSES = HEADS + TAILS
#: Buckets of the hashed trigram feature; gradient steps and their damping; penalty on squared weights.
PAIR_BUCKETS, STEPS, DAMPING, PENALTY = 4096, 14, 0.25, 1.0
FEATURES = 1 + 2 * CLASSES + PAIR_BUCKETS
#: Parts of the (context, class) counts, at most CLASSES**3 numbers in all, and rows of the weight table updated together.
PARTS, SLICE = 4, 512
#: Words whose counts are broadcast at most, and slots of their table (powers of two). All others are joined.
COMMON_WORDS, COMMON_BITS = 1 << 19, 20
#: Groups of the words of a class, those of one frequent word each, and buckets of the word before: of one word each, and all.
GROUPS, LEADERS = 128, 64
OWN_BUCKETS, BUCKETS = 768, 1024
END = np.uint64(1)
_MARKS = np.zeros(256, bool)
_MARKS[list(b".,;:!?\"')")] = True


def tokens(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash and spelling (0 to SPELLINGS - 1) of each word, A-Z lower-cased, and of the end token."""
    data = text.encode("utf-8", "replace").lower()
    starts, ends = word_bounds(data)
    hashes = np.append(span_hashes(data, starts, ends), END)
    if not len(starts):
        return hashes, np.zeros(1, np.int64)
    codes = np.frombuffer(data, np.uint8)
    marked = _MARKS[codes[ends - 1]] & (ends - starts > 1)
    last = ends - 1 - marked
    spelling = marked.astype(np.uint64)
    for back in range(3):
        at = last - back
        spelling = spelling * np.uint64(257) + np.where(at >= starts, codes[np.maximum(at, 0)].astype(np.uint64), 0)
    return hashes, np.append((mix(spelling) % np.uint64(SPELLINGS)).astype(np.int64), 0)


def _batch_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [tokens(t) for t in texts_of(batch, "text")]
        if not found:
            continue
        hashes, first, counts = np.unique(np.concatenate([h for h, _ in found]), return_index=True, return_counts=True)
        spelling = np.concatenate([s for _, s in found])[first]
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes.view(np.int64)), pa.array(spelling.astype(np.int32)), pa.array(counts.astype(np.int64))],
            names=["word", "spelling", "n"])


def word_counts(training: DataFrame) -> DataFrame:
    """``word`` (hash), ``spelling`` and ``n`` over all tokens of the column ``text``; end tokens count."""
    parts = training.select("text").mapInArrow(_batch_counts, "word long, spelling int, n long")
    return parts.groupBy("word").agg(F.min("spelling").alias("spelling"), F.sum("n").alias("n"))


@dataclass
class Classes:
    """Classes of words: hashes of the frequent words (sorted) with their classes, and the class of each spelling."""

    heads: np.ndarray
    head_classes: np.ndarray
    spellings: np.ndarray

    def of(self, hashes: np.ndarray, spelling: np.ndarray) -> np.ndarray:
        found = self.spellings[spelling]
        at = np.minimum(np.searchsorted(self.heads, hashes), len(self.heads) - 1)
        return np.where(self.heads[at] == hashes, self.head_classes[at], found)


@dataclass
class Words:
    """Frequent words: hashes (sorted), group within the class and bucket as the word before (-1: by the hash, as for all others)."""

    hashes: np.ndarray
    groups: np.ndarray
    buckets: np.ndarray

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word, -1 for all others."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def group(self, hashes: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
        return _found_or_hashed(self.groups, self.places(hashes) if places is None else places, hashes, LEADERS, GROUPS)

    def bucket(self, hashes: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
        return _found_or_hashed(self.buckets, self.places(hashes) if places is None else places, hashes, OWN_BUCKETS, BUCKETS)

    def rows(self, hashes: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the tokens in tail classes, the number of their (class, word before), and their group."""
        at = np.flatnonzero(classes >= HEADS)
        words = np.concatenate([[END], hashes])
        places = self.places(words)
        return (at, (classes[at] - HEADS) * BUCKETS + self.bucket(words[at], places[at]),
                self.group(words[at + 1], places[at + 1]))


def _found_or_hashed(values: np.ndarray, places: np.ndarray, hashes: np.ndarray, own: int, size: int) -> np.ndarray:
    """The value at each place; without one, a number from ``own`` to ``size`` - 1 by the hash."""
    found = np.where(places >= 0, values[places], -1)
    return np.where(found >= 0, found, own + (mix(hashes) % np.uint64(size - own)).astype(np.int64))


def frequent_words(hashes: np.ndarray, classes: np.ndarray) -> Words:
    """Words by falling frequency as ``Words``: the first of each tail class are groups, the first of all buckets."""
    groups = np.full(len(hashes), -1, np.int64)
    for c in np.unique(classes[classes >= HEADS]):
        own = np.flatnonzero(classes == c)[:LEADERS]
        groups[own] = np.arange(len(own))
    buckets = np.where(np.arange(len(hashes)) < OWN_BUCKETS, np.arange(len(hashes)), -1)
    order = np.argsort(hashes)
    return Words(hashes[order], groups[order], buckets[order])


def contexts(classes: np.ndarray) -> np.ndarray:
    """Number of the context of each token: the classes before it; before the start stand end tokens (class 0)."""
    before = np.concatenate([[0, 0], classes[:-1]])
    return before[1:] * CLASSES + before[:-1]


def _cells(batches: Iterator[pa.RecordBatch], classes: Classes, words: Words | None) -> Iterator[pa.RecordBatch]:
    """Counts of cells over a partition: (context, class) and after these (class, word before, group) where ``words`` are given,
    else (spelling, frequent neighbour on either side)."""
    total = np.zeros(CLASSES ** 3 + TAILS * BUCKETS * GROUPS if words else SPELLINGS * 2 * HEADS, np.int32)
    for batch in batches:
        for text in texts_of(batch, "text"):
            hashes, spelling = tokens(text)
            own = classes.of(hashes, spelling)
            if words is None:
                tail = own >= HEADS
                for side, here, there in ((0, slice(1, None), slice(None, -1)), (1, slice(None, -1), slice(1, None))):
                    use = tail[here] & ~tail[there]
                    np.add.at(total, (spelling[here][use] * 2 + side) * HEADS + own[there][use], 1)
            else:
                np.add.at(total, contexts(own) * CLASSES + own, 1)
                _, row, group = words.rows(hashes, own)
                np.add.at(total, CLASSES ** 3 + row * GROUPS + group, 1)
    filled = np.flatnonzero(total)
    for at in range(0, len(filled), 1 << 17):
        part = filled[at:at + (1 << 17)]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part].astype(np.int64))], names=["cell", "n"])


def cell_counts(training: DataFrame, classes: Classes, words: Words | None = None) -> DataFrame:
    cells = training.select("text").mapInArrow(lambda it: _cells(it, classes, words), "cell int, n long")
    return cells.groupBy("cell").agg(F.sum("n").alias("n"))


def group_spellings(table: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Tail class of each spelling: k-means on the square roots of its shares of frequent neighbours, by weight."""
    weight = table.sum(axis=1)
    points = np.sqrt(table / np.maximum(weight, 1)[:, None])
    order = np.argsort(-weight, kind="stable")
    centres = points[order[:TAILS]].copy()
    nearest = np.zeros(len(points), np.int64)
    for _ in range(rounds):
        nearest = np.argmax(np.einsum("ij,kj->ik", points, centres) - 0.5 * (centres ** 2).sum(axis=1), axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points * weight[:, None])
        mass = np.bincount(nearest, weight, TAILS)
        centres = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1)[:, None], centres)
    return HEADS + nearest


def feature_rows(context: np.ndarray) -> np.ndarray:
    """Rows of the weight table that a context switches on: bias, bigram, skip and hashed trigram."""
    before, skip = context // CLASSES, context % CLASSES
    pair = (mix(context.astype(np.uint64)) % np.uint64(PAIR_BUCKETS)).astype(np.int64)
    return np.stack([np.zeros_like(context), 1 + before, 1 + CLASSES + skip, 1 + 2 * CLASSES + pair], axis=1)


def class_log_probs(weights: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Natural logarithm of P(class | context), one row per context."""
    logits = weights[feature_rows(context)].sum(axis=1)
    logits -= logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def _gradient(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Gradient and curvature of the log-likelihood over the cells of a partition.

    One row per slice of the weights, with only those rows of the table that the partition's contexts switch on.
    """
    cells, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for batch in batches:
        cells.append(batch.column("cell").to_numpy().astype(np.int64))
        counts.append(batch.column("n").to_numpy())
    cell, n = np.concatenate(cells), np.concatenate(counts)
    if not len(cell):
        return
    context, place = np.unique(cell // CLASSES, return_inverse=True)
    seen = np.zeros((len(context), CLASSES))
    seen[place, cell % CLASSES] = n
    logs = class_log_probs(weights, context)
    p, mass = np.exp(logs), seen.sum(axis=1, keepdims=True)
    used, at = np.unique(feature_rows(context), return_inverse=True)
    at = at.reshape(len(context), -1)
    slope, bend = np.zeros((len(used), CLASSES)), np.zeros((len(used), CLASSES))
    for j in range(at.shape[1]):
        np.add.at(slope, at[:, j], seen - mass * p)
        np.add.at(bend, at[:, j], mass * p * (1 - p))
    likelihood = float((seen * logs).sum())
    for start in np.unique(used // SLICE * SLICE):  # the slice of the bias is always among them
        own = used // SLICE * SLICE == start
        columns = [used[own].astype(np.int32), slope[own].astype(np.float32), bend[own].astype(np.float32)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([start], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in columns],
             pa.array([likelihood if start == 0 else 0.0])], names=["start", "used", "slope", "bend", "likelihood"])


def _stepped(parts: pa.Table, weights: np.ndarray) -> pa.Table:
    """One slice of the weights after a damped step along the summed gradient of all parts."""
    start = parts.column("start")[0].as_py()
    old = weights[start:start + SLICE].astype(np.float64)
    slope, bend = -PENALTY * old, np.full(old.shape, PENALTY)
    # Sums of floats depend on their order; parts arrive in any.
    for used, *sums in sorted(zip(*[parts.column(c).to_pylist() for c in ("used", "slope", "bend")])):
        rows = np.frombuffer(used, np.int32) - start
        for total, part in zip((slope, bend), sums):
            total[rows] += np.frombuffer(part, np.float32).reshape(-1, CLASSES)
    new = old + DAMPING * np.clip(slope / bend, -4, 4)
    likelihood = sum(sorted(parts.column("likelihood").to_pylist()))
    return pa.table({"start": pa.array([start], pa.int32()), "weights": pa.array([new.astype(np.float32).tobytes()], pa.binary()),
                     "likelihood": pa.array([likelihood])})


def _with(work: Callable, sent: Broadcast) -> Callable:
    return lambda rows: work(rows, sent.value)


def train_weights(cells: DataFrame, sizes: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, list[float]]:
    """Weights (FEATURES x CLASSES) after ``steps`` damped gradient steps, and the log-likelihood before each.

    The bias starts at the logarithm of the classes' ``sizes``. Four features are on at a time, hence the damping of 1/4.

    Gradients are summed and applied on Spark, slice by slice. Every step sends the weights out and gets the next ones
    back; they have a fixed size, and what was sent goes with the step.
    """
    spark = cells.sparkSession
    cells = pin(cells.repartition(PARTS, F.floor(F.col("cell") / CLASSES)))
    weights = np.zeros((FEATURES, CLASSES), np.float32)
    weights[0] = np.log((sizes + SMOOTHING) / (sizes + SMOOTHING).sum())
    history = []
    for _ in range(steps):
        sent = spark.sparkContext.broadcast(weights)
        parts = cells.mapInArrow(_with(_gradient, sent), "start int, used binary, slope binary, bend binary, likelihood double")
        found = parts.groupBy("start").applyInArrow(
            _with(_stepped, sent), "start int, weights binary, likelihood double").toArrow()
        weights = weights.copy()  # rows that no context switches on stay 0
        for start, part in zip(found.column("start").to_pylist(), found.column("weights")):
            rows = np.frombuffer(part.as_py(), np.float32).reshape(-1, CLASSES)
            weights[start:start + len(rows)] = rows
        history.append(sum(found.column("likelihood").to_pylist()))
        sent.destroy()
    return weights, history


def _group_counts(batches: Iterator[pa.RecordBatch], classes: Classes, words: Words) -> Iterator[pa.RecordBatch]:
    """Tokens and different words of (tail class, group) over a partition of word counts."""
    n, kinds = np.zeros(TAILS * GROUPS, np.int64), np.zeros(TAILS * GROUPS, np.int64)
    for batch in batches:
        hashes = batch.column("word").to_numpy().view(np.uint64)
        own = classes.of(hashes, batch.column("spelling").to_numpy())
        tail = own >= HEADS
        cell = (own[tail] - HEADS) * GROUPS + words.group(hashes[tail])
        np.add.at(n, cell, batch.column("n").to_numpy()[tail])
        np.add.at(kinds, cell, 1)
    at = np.flatnonzero(kinds)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at]), pa.array(kinds[at])], names=["cell", "n", "v"])


def group_sizes(counts: DataFrame, classes: Classes, words: Words) -> np.ndarray:
    """Smoothed tokens of each group of the tail classes; each group of hashed words has one more word, the unknown."""
    parts = counts.select("word", "spelling", "n").mapInArrow(lambda it: _group_counts(it, classes, words), "cell int, n long, v long")
    sizes = np.zeros(TAILS * GROUPS)
    for r in parts.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():  # a row per group
        sizes[r["cell"]] = r["n"] + SMOOTHING * r["v"]
    sizes = sizes.reshape(TAILS, GROUPS)
    sizes[:, LEADERS:] += SMOOTHING
    return sizes


def group_steps(seen: np.ndarray, logits: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Logits of the groups after ``steps`` gradient steps from the ``logits`` of the class, one row per (class, word before)."""
    weights, mass = np.zeros_like(seen), seen.sum(axis=1, keepdims=True)
    for _ in range(steps):
        p = np.exp(logits + weights)
        p /= p.sum(axis=1, keepdims=True)
        weights += np.clip((seen - mass * p - PENALTY * weights) / (mass * p + PENALTY), -4, 4)
    return logits + weights


def _log_shares(logits: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return logits - np.log(np.exp(logits).sum(axis=-1, keepdims=True))


def _group_rows(batches: Iterator[pa.RecordBatch], shares: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Logarithms of P(group | class, word before) for the rows of a partition's cells."""
    cells, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for batch in batches:
        cells.append(batch.column("cell").to_numpy().astype(np.int64))
        counts.append(batch.column("n").to_numpy())
    cell, n = np.concatenate(cells) - CLASSES ** 3, np.concatenate(counts)
    order = np.argsort(cell)
    cell, n = cell[order], n[order]
    rows, starts = np.unique(cell // GROUPS, return_index=True)
    ends = np.append(starts[1:], len(cell))
    for at in range(0, len(rows), SLICE):
        own, first, last = rows[at:at + SLICE], starts[at], ends[min(at + SLICE, len(rows)) - 1]
        seen = np.zeros((len(own), GROUPS))
        seen[np.searchsorted(own, cell[first:last] // GROUPS), cell[first:last] % GROUPS] = n[first:last]
        logs = _log_shares(group_steps(seen, shares[own // BUCKETS])).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array([r.tobytes() for r in logs], pa.binary())],
                                         names=["row", "logs"])


def train_groups(cells: DataFrame, sizes: np.ndarray) -> np.ndarray:
    """Natural logarithms of P(group | class, word before), from the cells after those of the classes.

    The weights of a (class, word before) meet no others, so its gradient steps all run in one task, from the shares of the class.
    """
    with np.errstate(divide="ignore"):
        shares = np.log(sizes) - np.log(sizes.sum(axis=1, keepdims=True))
    spread = cells.where(F.col("cell") >= CLASSES ** 3).repartition(4 * PARTS, F.floor(F.col("cell") / GROUPS))
    found = spread.mapInArrow(lambda it: _group_rows(it, shares), "row int, logs binary").toArrow()
    logs = np.repeat(shares.astype(np.float32), BUCKETS, axis=0)  # rows without tokens keep the shares of the class
    for row, values in zip(found.column("row").to_pylist(), found.column("logs")):
        logs[row] = np.frombuffer(values.as_py(), np.float32)
    return logs


@dataclass
class Model:
    classes: Classes
    weights: np.ndarray
    #: Frequent words, log10 of P(group | class, word before), and log10 of the smoothed size of each group.
    words: Words
    group_logs: np.ndarray
    group_sizes: np.ndarray
    #: log10 of each class's smoothed size, the same of all tokens, and the number of training tokens.
    class_sizes: np.ndarray
    size: float
    train_tokens: int
    #: Direct-mapped table of common words: hash and count per slot.
    slot_words: np.ndarray
    slot_counts: np.ndarray


def _unpacked(fields: dict) -> Model:
    return Model(**{**fields, "classes": Classes(**fields["classes"]), "words": Words(**fields["words"])})


def _score_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column("key").to_pylist()
        rows = []
        texts = texts_of(batch, "text")
        for first in range(0, len(texts), 256):
            part = [tokens(t) for t in texts[first:first + 256]]
            owns = [model.classes.of(h, s) for h, s in part]
            used = [contexts(o) for o in owns]
            distinct, place = np.unique(np.concatenate(used), return_inverse=True)
            logs = class_log_probs(model.weights, distinct) / np.log(10)
            begin = 0
            for (hashes, _), own in zip(part, owns):
                n = len(hashes)
                at, row, group = model.words.rows(hashes, own)
                context_sum = float(logs[place[begin:begin + n], own].sum() - model.class_sizes[own[own < HEADS]].sum()
                                    + (model.group_logs[row, group] - model.group_sizes[own[at] - HEADS, group]).sum())
                begin += n
                slot = (hashes >> np.uint64(64 - COMMON_BITS)).astype(np.int64)
                common = (model.slot_words[slot] == hashes) & (model.slot_counts[slot] > 0)
                counts = model.slot_counts[slot[common]]
                rest, times = np.unique(hashes[~common], return_counts=True)
                rows.append((n, len(counts), float(np.log10(counts + SMOOTHING).sum()), context_sum, rest.view(np.int64), times))
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(r[4]) for r in rows])]).astype(np.int32))
        joined = [np.concatenate([r[i] for r in rows]) if rows else np.zeros(0, np.int64) for i in (4, 5)]
        yield pa.RecordBatch.from_arrays([
            pa.array(keys, pa.int64()), batch.column("doc_id"), batch.column("held_out"),
            pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.float64()), pa.array([r[3] for r in rows], pa.float64()),
            pa.ListArray.from_arrays(offsets, pa.array(joined[0], pa.int64())),
            pa.ListArray.from_arrays(offsets, pa.array(joined[1].astype(np.int32), pa.int32()))],
            names=["key", "doc_id", "held_out", "n_tokens", "common", "logs", "context_logs", "rest", "times"])


def train(training: DataFrame) -> tuple[Model, DataFrame]:
    """The model and the counts of all training words, from the column ``text`` (no nulls)."""
    counts = pin(word_counts(training))
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    # The frequent words, the end token before them.
    frequent = counts.where(F.col("word") != int(END)).orderBy(F.desc("n"), "word").limit(HEADS - 1 + 2 * TAILS * LEADERS).collect()
    top = frequent[:HEADS - 1]
    ends = counts.where(F.col("word") == int(END)).first()
    heads = np.array([int(END), *[r["word"] for r in top]], np.int64).view(np.uint64)
    order = np.argsort(heads)
    classes = Classes(heads[order], order.astype(np.int64), np.full(SPELLINGS, HEADS, np.int64))
    table = np.zeros(SPELLINGS * 2 * HEADS)
    beside = cell_counts(training, classes).toArrow()  # at most SPELLINGS * 2 * HEADS rows
    table[beside.column("cell").to_numpy()] = beside.column("n").to_numpy()
    classes.spellings = group_spellings(table.reshape(SPELLINGS, -1))
    # Tokens and different words per class.
    size, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in counts.groupBy("spelling").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        size[classes.spellings[row["spelling"]]] += row["n"]
        kinds[classes.spellings[row["spelling"]]] += row["v"]
    for place, row in enumerate([ends, *top]):
        if row is not None:
            tail = classes.spellings[row["spelling"]]
            size[tail], kinds[tail] = size[tail] - row["n"], kinds[tail] - 1
            size[place], kinds[place] = row["n"], 1
    known = np.array([int(END), *[r["word"] for r in frequent]], np.int64).view(np.uint64)
    words = frequent_words(known, classes.of(known, np.array([0, *[r["spelling"] for r in frequent]])))
    cells = pin(cell_counts(training, classes, words))
    weights, _ = train_weights(cells.where(F.col("cell") < CLASSES ** 3), size)
    sizes = group_sizes(counts, classes, words)
    group_logs = train_groups(cells, sizes) / np.float32(np.log(10))
    # The least count whose words all fit into the broadcast table: one row per power of two of counts.
    steps = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("step")).agg(F.count("*").alias("v")).collect()
    least, held = 63, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        if held + row["v"] > COMMON_WORDS:
            break
        held, least = held + row["v"], row["step"]
    common = counts.where(F.floor(F.log2("n")) >= least).select("word", "n").toArrow()  # at most COMMON_WORDS rows
    common_words = common.column("word").to_numpy().view(np.uint64)
    n = common.column("n").to_numpy()
    order = np.lexsort((common_words, n))  # the most frequent comes last and keeps the slot
    slot_words, slot_counts = np.zeros(1 << COMMON_BITS, np.uint64), np.zeros(1 << COMMON_BITS, np.int64)
    slots = (common_words[order] >> np.uint64(64 - COMMON_BITS)).astype(np.int64)
    slot_words[slots], slot_counts[slots] = common_words[order], n[order]
    del common, common_words, n, order, slots
    with np.errstate(divide="ignore"):
        log_sizes = np.log10(sizes)
    model = Model(classes, weights, words, group_logs, log_sizes, np.log10(size + SMOOTHING * (kinds + 1)),
                  float(np.log10(totals["n"] + SMOOTHING * (totals["v"] + 1))), int(totals["n"]), slot_words, slot_counts)
    return model, counts


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` for every row.

    Null texts are empty; an empty text is its end token. Documents with crc32 of the id modulo ``FOLDS`` equal to
    ``HELD_OUT``, and null ids, are not learned from. Repeated rows each count in training and get equal scores. Without
    training tokens every count is 0. Other columns are not read. An empty table gives an empty table. Counts of at most
    ``COMMON_WORDS`` words are broadcast; those of all other words are joined, so no word is left out.
    """
    spark = docs.sparkSession
    held_out = F.coalesce(id_bucket(F.col(id_col), FOLDS) == HELD_OUT, F.lit(True))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    model, counts = train(source.where("NOT held_out").select("text"))
    # Plain arrays travel in a broadcast; the class that holds them travels with the function.
    sent = spark.sparkContext.broadcast({**vars(model), "classes": vars(model.classes), "words": vars(model.words)})
    scored = pin(source.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "held_out", "text").mapInArrow(
        lambda it: _score_batches(it, _unpacked(sent.value)),
        "key long, doc_id long, held_out boolean, n_tokens long, common long, logs double, context_logs double, "
        "rest array<long>, times array<int>"))
    rest = (scored.dropDuplicates(["key"]).select("key", F.explode(F.arrays_zip("rest", "times")).alias("r"))
            .select("key", F.col("r.rest").alias("word"), F.col("r.times").alias("times")))
    found = rest.join(counts.select("word", "n"), "word", "left")
    sums = found.groupBy("key").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTHING))).alias("rest_logs"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rest_known"))
    logs = F.col("logs") + F.coalesce("rest_logs", F.lit(0.0))
    return scored.drop("rest", "times").join(sums, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("common") + F.coalesce("rest_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(model.size)).alias("base_score"), (logs + F.col("context_logs")).alias("score"))
