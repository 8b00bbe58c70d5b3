"""Near-duplicate documents from bottom-k sketches of one hash function.

1. Every text becomes the set of its distinct word shingles; equal sets fall together into one class.
2. A class keeps its ``SKETCH`` smallest shingle hashes. Rows (value, class) are the inverted lists.
3. Two sets at or above the similarity share at least ``least_overlap`` retained values. Therefore it is enough to
   list a class under its rarest values (the prefix of its sketch in order of list length), with no loss, and values
   of passages that many documents hold fall out of the lists of all documents that have other content.
4. Candidates are met in the lists, estimated on the sketch of their union, and verified on full sets.
   The first round compares the members of a list with its most central one, whose values the others share most. The
   last round compares what is still in different components of a list. There a pair is left out when the shingles
   that no other open class holds rule the similarity out, so a group of many copies never becomes all its pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerfeat.llm.components import components
from ledgerfeat.llm.stages import Stages
from ledgerfeat.llm.text import shingle_set, texts_of

SHINGLE_WORDS = 5
SKETCH = 48
#: Chance that a pair exactly at the similarity shares fewer retained values than `least_overlap`.
MISS = 1e-9
#: Values in the sketches of the last round; sets with a smaller union are compared whole there. Halves of hashes may meet
#: by chance, which the slack makes good.
WIDE, HALF_SLACK = 256, 2
#: Texts, sets or pairs of sets in an Arrow batch.
BATCH_ROWS = 512
#: How often classes that cannot be in a link are left out before pairs are met.
OWN_PASSES = 2


def least_overlap(drawn: int, percent: int, miss: float = MISS) -> int:
    """Largest t such that Binomial(drawn, percent / 100) falls below t with a chance of at most ``miss``."""
    p, below = percent / 100, 0.0
    for t in range(drawn + 1):
        below += math.comb(drawn, t) * p ** t * (1 - p) ** (drawn - t)
        if below > miss:
            return t
    return drawn


def prefix_lengths(percent: int, sketch: int = SKETCH) -> list[int]:
    """Number of rarest values to list, by the size of a class's sketch (0 to ``sketch``).

    A set smaller than ``percent`` of the sketch size meets only sets whose sketch is complete as well; then the exact
    overlap bound holds. Others use the bound with the chance ``MISS``.
    """
    drawn = least_overlap(sketch, percent)
    out = [0]
    for size in range(1, sketch + 1):
        exact = -(-percent * size // 100)
        bound = exact if size * 100 <= percent * sketch else min(exact, drawn)
        out.append(size - max(bound, 1) + 1)
    return out


def _sketch_batches(batches: Iterator[pa.RecordBatch], width: int, sketch: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, sketches = [], [], []
        for text in texts_of(batch, "text"):
            values = shingle_set(text, width)
            sizes.append(len(values))
            digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
            sketches.append(values[:sketch].view(np.int64))
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sketches])]).astype(np.int32)
        flat = np.concatenate(sketches) if sketches else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))],
            names=["id", "n", "digest", "sketch"])


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS,
             sketch: int = SKETCH) -> DataFrame:
    """``id``, set size ``n``, set ``digest`` and bottom-k ``sketch`` of every row."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(lambda it: _sketch_batches(it, width, sketch),
                             "id long, n long, digest binary, sketch array<long>")


def _set_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Full sets of the classes' own texts; another text under the same document id has another digest and goes."""
    for batch in batches:
        sets = [shingle_set(t, width) for t in texts_of(batch, "text")]
        own = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() == d.as_py() for s, d in zip(sets, batch.column("digest"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([s.tobytes() for s in sets], pa.binary())],
            names=["id", "shingles"]).filter(pa.array(own, pa.bool_()))


def _wide_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # Signed numbers in the order of the unsigned ones.
        halves = [np.unique((np.frombuffer(s.as_buffer(), np.uint64) >> np.uint64(32)).astype(np.uint32)) for s in batch.column("shingles")]
        wide = [(h[:WIDE] ^ np.uint32(1 << 31)).view(np.int32) for h in halves]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(wide, pa.list_(pa.int32()))], names=["id", "wide"])


def _shingle_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(s.as_buffer(), np.int64) for s in batch.column("shingles")]
        ids = np.repeat(batch.column("id").to_numpy(zero_copy_only=False), [len(s) for s in sets])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(np.concatenate(sets) if sets else [], pa.int64())], names=["id", "shingle"])


def _verify_batches(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs that are like enough by their full sets."""
    for batch in batches:
        keep = []
        for left, right in zip(batch.column("left"), batch.column("right")):
            x, y = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))


def _inverted_lists(classes: DataFrame, percent: int, sketch: int) -> DataFrame:
    """Rows (value, id, n, central, listed) for the rarest shared values of each class.

    ``listed`` are all values of the class's rows, ``central`` the mean length of the lists of its whole sketch.
    """
    rows = classes.select("id", "n", F.size("sketch").alias("kept"), F.explode("sketch").alias("value"))
    shared = rows.groupBy("value").agg(F.count("*").alias("length")).where("length > 1")
    joined = rows.join(shared, "value")
    lengths = F.array(*[F.lit(x) for x in prefix_lengths(percent, sketch)])
    # Values held by this class alone come first in the order of rarity and use up the prefix.
    ranked = (joined.groupBy("id", "n", "kept")
              .agg(F.sort_array(F.collect_list(F.struct("length", "value"))).alias("held")))  # at most `sketch` values
    room = F.greatest(lengths[F.col("kept")] - (F.col("kept") - F.size("held")), F.lit(0))
    central = F.aggregate("held", F.lit(0.0), lambda total, h: total + h["length"]) / F.col("kept")
    listed = ranked.select("id", "n", central.alias("central"), F.slice("held", 1, room)["value"].alias("listed"))
    return listed.select(F.explode("listed").alias("value"), "id", "n", "central", "listed")


class _Verifier:
    """Estimates pairs on sketches, then compares full sets."""

    def __init__(self, members: DataFrame, texts: DataFrame, stages: Stages, percent: int, width: int, sketch: int) -> None:
        self.percent, self.sketch = percent, sketch
        self.members = members
        involved = texts.join(members.select("id", "digest", F.col("least").alias("doc")), "doc")
        self.sets = stages.write(involved.select("id", "digest", "text").mapInArrow(
            lambda it: _set_batches(it, width), "id long, shingles binary"))

    def estimate(self, kept: int = 0, slack: int = 0) -> str:
        """Condition on sketches ``sa`` and ``sb`` of ``kept`` values: shared ones among the smallest of the union."""
        kept = kept or self.sketch
        union = f"slice(sort_array(array_union(sa, sb)), 1, {kept})"
        return (f"size(array_intersect({union}, array_intersect(sa, sb))) + {slack} >= "
                f"CASE WHEN size(array_union(sa, sb)) < {kept} "
                f"THEN ceil({self.percent} * size(array_union(sa, sb)) / 100) ELSE {least_overlap(kept, self.percent)} END")

    def wide_sketches(self, ids: DataFrame) -> DataFrame:
        """``id`` and its ``WIDE`` smallest hashes, shortened to their upper halves (order is kept)."""
        return self.sets.mapInArrow(_wide_batches, "id long, wide array<int>").join(ids, "id", "left_semi")

    def close(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that the union sketch does not rule out."""
        left = self.members.select(F.col("id").alias("a"), F.col("sketch").alias("sa"))
        right = self.members.select(F.col("id").alias("b"), F.col("sketch").alias("sb"))
        return pairs.join(left, "a").join(right, "b").where(self.estimate()).select("a", "b")

    def own_shingles(self, ids: DataFrame) -> DataFrame:
        """``id`` and ``own``, the number of its shingles that no other of the classes ``ids`` holds."""
        rows = (self.sets.join(ids, "id", "left_semi")
                .mapInArrow(_shingle_batches, "id long, shingle long"))
        held = rows.groupBy("shingle").agg(F.min("id").alias("id"), F.count("*").alias("holders"))
        return held.where("holders = 1").groupBy("id").agg(F.count("*").alias("own"))

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) at or above the similarity, by their full sets."""
        left = self.sets.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
        right = self.sets.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
        # A set meets its partners in lists, cut by a salt, so that it is not repeated on the way to the first join.
        partners = pairs.groupBy("a", F.pmod(F.hash("b"), F.lit(64))).agg(F.collect_list("b").alias("bs"))
        met = partners.join(left, "a").select("a", "left", F.explode("bs").alias("b")).join(right, "b")
        percent = self.percent
        return met.select("a", "b", "left", "right").mapInArrow(lambda it: _verify_batches(it, percent), "a long, b long")


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80,
                          width: int = SHINGLE_WORDS, sketch: int = SKETCH) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``.

    Documents are linked when 100 * |A and B| >= ``percent`` * |A or B| over their sets of ``width``-word shingles (A-Z
    lower-cased; fewer words make one shingle). ``component_id`` is the smallest id reachable over links. Null or
    word-less texts have an empty set, are linked with nothing and form their own component. A null id is a document
    of its own with a null component and is kept. Rows that repeat an id count as one document when their texts agree;
    otherwise their links are joined under that id. Other columns are not read. An empty table gives an empty table.
    """
    with Stages(docs.sparkSession, BATCH_ROWS) as stages:
        rows = stages.write(sketches(docs, id_col, text_col, width, sketch))
        classes = (rows.where("n > 0 AND id IS NOT NULL").groupBy("digest", "n")
                   .agg(F.min("id").alias("id"), F.first("sketch").alias("sketch")))
        # An id on several rows may stand for several classes; every class gets a number of its own.
        classes = stages.write(classes.select(F.xxhash64("digest").alias("id"), "digest", "n", "sketch", F.col("id").alias("least")))
        texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
        lists = stages.write(_inverted_lists(classes, percent, sketch))
        listed = stages.write(classes.join(lists.select("id").distinct(), "id", "left_semi"))
        check = _Verifier(listed, texts, stages, percent, width, sketch)
        same_size = f"least(na, nb) * 100 >= {percent} * greatest(na, nb)"

        # First round: members of a list against its most central member.
        leaders = lists.groupBy("value").agg(F.max(F.struct("central", F.col("n").alias("nb"), F.col("id").alias("b"))).alias("l"))
        pairs = (lists.select("value", F.col("id").alias("a"), F.col("n").alias("na"))
                 .join(leaders.select("value", "l.b", "l.nb"), "value").where(f"a <> b AND {same_size}").select("a", "b").distinct())
        links = stages.write(check.verified(check.close(pairs)))
        placed = stages.write(_placed(lists, links))
        # Last round: what is left in different components of a list.
        mixed = placed.groupBy("value").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
        open_rows = stages.write(placed.join(mixed.select("value"), "value", "left_semi"))
        # A class with so many shingles of its own is like no other. Without it others have more of their own.
        able_ids = open_rows.select("id", "n").distinct()
        for _ in range(OWN_PASSES):
            own = check.own_shingles(able_ids.select("id"))
            able_ids = stages.write(able_ids.select("id", "n").join(own, "id", "left").withColumn("own", F.coalesce("own", F.lit(0)))
                           .where(f"100 * (n - own) >= {percent} * n"))
        able = (open_rows.join(able_ids.select("id", "own"), "id")
                .join(check.wide_sketches(able_ids.select("id")).withColumnRenamed("wide", "sketch"), "id"))
        left = able.select("value", F.col("id").alias("a"), F.col("n").alias("na"), F.col("part").alias("pa"),
                           F.col("sketch").alias("sa"), (F.col("n") - F.col("own")).alias("ma"), F.col("listed").alias("la"))
        right = able.select("value", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("part").alias("pb"),
                            F.col("sketch").alias("sb"), (F.col("n") - F.col("own")).alias("mb"), F.col("listed").alias("lb"))
        possible = f"(100 + {percent}) * least(ma, mb) >= {percent} * (na + nb)"
        first_meeting = "array_min(array_intersect(la, lb)) = value"
        pairs = (left.join(right, "value").where(f"a < b AND pa <> pb AND {possible} AND {first_meeting} AND {check.estimate(WIDE, HALF_SLACK)}")
                 .select("a", "b"))
        links = links.unionByName(stages.write(check.verified(pairs)))

        # Links between classes and, where one id holds several texts, between its classes.
        held = rows.where("n > 0 AND id IS NOT NULL").select(F.col("id").alias("doc"), F.xxhash64("digest").alias("class"))
        several = (held.distinct().groupBy("doc").agg(F.min("class").alias("a"), F.max("class").alias("b"))
                   .where("a <> b").select("doc"))
        same_id = (held.join(several, "doc").join(held.groupBy("doc").agg(F.min("class").alias("first")), "doc")
                   .select(F.col("class").alias("a"), F.col("first").alias("b")).distinct())
        groups = components(links.unionByName(same_id))
        least = (classes.join(groups, classes["id"] == groups["node"], "left")
                 .select(classes["digest"], F.coalesce("root", classes["id"]).alias("root"), "least"))
        lowest = least.groupBy("root").agg(F.min("least").alias("component"))
        found = least.join(lowest, "root").select("digest", "component")
        out = rows.select("id", "n", F.when(F.col("n") > 0, F.col("digest")).alias("digest")).join(found, "digest", "left")
        component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
        return stages.last(out.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                                      (F.col("id").isNull() | (F.col("id") == component)).alias("kept")))


def _placed(lists: DataFrame, links: DataFrame) -> DataFrame:
    groups = components(links)
    return (lists.join(groups.withColumnsRenamed({"node": "id"}), "id", "left")
            .select("value", "id", "n", "listed", F.coalesce("root", "id").alias("part")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """One document of each group: the row with the smallest id. Columns stay as they are.

    Documents without words and rows without id stay. Rows that repeat an id are one document: the row whose text
    sorts first stays.
    """
    groups = near_duplicate_groups(docs, id_col, text_col, percent)
    kept = groups.where("kept AND id IS NOT NULL").select("id").distinct()
    named = docs.where(F.col(id_col).isNotNull())
    named = named.join(kept, named[id_col].cast("long") == kept["id"], "left_semi")
    order = Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_last())
    place = "__place"
    while place in docs.columns:
        place += "_"
    first = named.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)
    return first.unionByName(docs.where(F.col(id_col).isNull()))
