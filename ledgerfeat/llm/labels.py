"""Bounded training samples of labelled documents."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfeat.llm.text import id_bucket

FOLDS, HELD_OUT = 4, 2


class Spool:
    """Arrays in an unnamed temporary file of the driver, so that a sample of long texts takes disk and no memory."""

    def __init__(self) -> None:
        self._file, self._end = tempfile.TemporaryFile(), 0

    def add(self, *parts: bytes) -> tuple[int, ...]:
        """Place of the parts: where they begin and end."""
        bounds = [self._end]
        for part in parts:
            self._file.write(part)
            bounds.append(bounds[-1] + len(part))
        self._end = bounds[-1]
        return tuple(bounds)

    def read(self, place: tuple[int, ...], *types: type) -> list[np.ndarray]:
        self._file.flush()
        data = os.pread(self._file.fileno(), place[-1] - place[0], place[0])
        return [np.frombuffer(data[a - place[0]:b - place[0]], t) for a, b, t in zip(place, place[1:], types)]


class Stored(Sequence):
    """The items of a list, each read when it is asked for."""

    def __init__(self, items: list, read: Callable) -> None:
        self._items, self._read = items, read

    def __len__(self) -> int:
        return len(self._items)

    def __getitem__(self, at: int):
        return self._read(self._items[at])


def held_out(id_col: str = "doc_id"):
    """True for documents whose labels are never learned from; a null id is held out."""
    return F.coalesce(id_bucket(F.col(id_col), FOLDS) == HELD_OUT, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``id``, ``text`` and ``label`` (0 or 1) of up to ``rows`` labelled documents outside the held-out part.

    The labels are drawn by the hash of their id, so reruns agree; the drawn ids, at most ``rows``, are broadcast and the
    documents stay where they are. Null labels or ids are left out; of ids labelled twice the greatest label counts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("labelled"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("labelled").isNotNull() & F.col("label").isNotNull() & ~held_out("labelled"))
    drawn = (known.groupBy("labelled").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("labelled"), "labelled").limit(rows))
    return docs.join(F.broadcast(drawn), docs[id_col].cast("long") == F.col("labelled")).select(
        F.col("labelled").alias("id"), F.col(text_col).alias("text"), "label")
