"""Similarity join of documents over sets of word n-grams as a blocked sparse matrix product.

Rows of the matrix are the distinct n-gram sets (a row stands for all documents with that set), columns the n-grams in the
order of their hashes. The product of the matrix with its transpose holds the overlap of every two rows. Only the parts of it
that bounds on the sizes leave possible are computed:

1. Two rows of ``n`` n-grams link only if they share ``ceil(percent * n / 100)`` of the larger one. So their common n-grams
   reach into the first columns of both (`first_block`, under a third of a row), and only this block of columns is counted.
2. Of its first columns a row enters its rarest into lists, leaving out as many frequent ones as the bound allows
   (`left_out`). Two rows that link stand in a list together, whatever their sizes: nothing is missed.
3. Rows of a list are multiplied with the list's leader, the row with the largest shared part. Rows left in different
   components of a list are multiplied in blocks as well (`_list_groups`), unless the n-grams that no other open row holds rule out the
   overlap. Overlaps are added up column by column for all pairs of a block at once, and pairs below the bound are dropped;
   a block emits a spanning forest of its links, so its output is no larger than its input.

A product task holds about ``CELLS`` entries of either side. Many rows with one leader, or in one list, are cut into several
tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerfeat.llm.buckets import bucket_filter, full_buckets, grouped, packed_counts, passes
from ledgerfeat.llm.components import components
from ledgerfeat.llm.stages import Stages
from ledgerfeat.llm.text import shingle_set

NGRAM_WORDS = 4
#: Part of a row's n-grams in the first block of columns beyond the least one, in percent; entries in a block of rows; and
#: matches added up at once.
BEYOND = 15
CELLS, MATCHES = 1 << 18, 1 << 22
#: Hashed buckets for each entry of the first block, rounded up to a power of two; entries for each part of the buckets, and
#: entries of a task counted at once; texts or rows in an Arrow batch.
BUCKETS_AN_ENTRY, PART_ENTRIES, SLICE, BATCH_ROWS = 16, 1 << 21, 1 << 20, 2_000


def least_prefix(n: int, percent: int) -> int:
    """Columns of a row that any linked row must share one of."""
    return n - -(-percent * n // 100) + 1


def first_block(n: int, percent: int) -> int:
    """Columns of a row of ``n`` that are in the first block."""
    return min(n, least_prefix(n, percent) + BEYOND * n // 100)


def left_out(n: int, percent: int) -> int:
    """Columns of the first block that a row may leave out of its lists, for partners as small as the bound allows."""
    least = -(-percent * n // 100)
    return first_block(least, percent) - least_prefix(least, percent)


def _grams(text: pa.Scalar, width: int) -> tuple[np.ndarray, bytes]:
    grams = shingle_set((text.as_py() or b"").decode("utf-8", "replace"), width)
    return grams, hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _size_batches(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Set sizes and digests, and the columns of the first block."""
    for batch in batches:
        made = [_grams(text, width) for text in batch.column("text")]
        sizes = [len(g) for g, _ in made]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(sizes, pa.int64()), pa.array([d for _, d in made], pa.binary()),
             pa.array([first_block(n, percent) if n else 0 for n in sizes], pa.int64())], names=["id", "n", "digest", "held"])


def _new_sets(batch: pa.RecordBatch, width: int, seen: set[bytes]) -> Iterator[tuple[np.ndarray, bytes]]:
    """The sets of a batch that the task has not met before."""
    for text in batch.column("text"):
        grams, digest = _grams(text, width)
        if len(grams) and digest not in seen:
            seen.add(digest)
            yield grams, digest


def _column_batches(batches: Iterator[pa.RecordBatch], width: int, percent: int, bucket_bits: int, low: int) -> Iterator[pa.RecordBatch]:
    """Buckets of the first columns and how many sets of the task hold them (one or more), by parts."""
    seen: set[bytes] = set()
    waiting: list[np.ndarray] = []
    mask = np.uint64((1 << bucket_bits) - 1)

    def out() -> pa.RecordBatch:
        keys = np.concatenate(waiting) & mask
        waiting.clear()
        buckets, counts, _ = grouped(keys, np.ones(len(keys), np.int64))
        return packed_counts(buckets, np.minimum(counts, 2), low, np.uint8)

    held = 0
    for batch in batches:
        for grams, _ in _new_sets(batch, width, seen):
            waiting.append(grams[:first_block(len(grams), percent)].copy())
            held += len(waiting[-1])
            if held > SLICE:
                held = 0
                yield out()
    if waiting:
        yield out()


def _row_batches(batches: Iterator[pa.RecordBatch], width: int, percent: int, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The first columns that other rows may hold too, for the first row of its set in a task.

    A column of this row alone would use up a place in its lists, so ``listed`` falls by those left out here.
    """
    seen: set[bytes] = set()
    for batch in batches:
        sizes, digests, listed, firsts = [], [], [], []
        for grams, digest in _new_sets(batch, width, seen):
            n = len(grams)
            first = grams[:first_block(n, percent)]
            kept = first[passes(bits, first)]
            if len(kept):
                sizes.append(n)
                digests.append(digest)
                listed.append(len(first) - left_out(n, percent) - (len(first) - len(kept)))
                firsts.append(kept.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(listed, pa.int64()),
             pa.array(firsts, pa.list_(pa.int64()))], names=["n", "digest", "listed", "first"])


def _node(digest: Column) -> Column:
    """Number of a row of the matrix: half of its 128-bit digest."""
    return F.conv(F.substring(F.hex(digest), 2, 15), 16, 10).cast("long")


def _full_batches(batches: Iterator[pa.RecordBatch], width: int, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Whole rows of the documents that the filter lets through; a row too many is in no list and meets nothing."""
    for batch in batches:
        batch = batch.filter(pa.array(passes(bits, batch.column("bucket").to_numpy().view(np.uint64))))
        made = [_grams(text, width) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d for _, d in made], pa.binary()), pa.array([g.view(np.int64) for g, _ in made], pa.list_(pa.int64()))],
            names=["digest", "grams"])


def _entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes and sizes of the rows of a block, and its entries as columns and row numbers, by column."""
    grams = table.column("grams").combine_chunks()
    if isinstance(grams, pa.ChunkedArray):
        grams = pa.concat_arrays(grams.chunks) if grams.num_chunks else pa.array([], pa.list_(pa.int64()))
    sizes = np.diff(grams.offsets.to_numpy()).astype(np.int64)
    columns, rows = grams.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(columns, kind="stable")
    return table.column("node").to_numpy(), sizes, columns[order], rows[order]


def overlaps(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells ``row of left * width + row of right`` of the product that are not 0, and their values.

    Both sides are columns in order and the rows that hold them. Matches are added up ``MATCHES`` at a time.
    """
    columns, rows = left
    low, high = np.searchsorted(right[0], columns, "left"), np.searchsorted(right[0], columns, "right")
    met = high > low
    rows, low, times = rows[met], low[met], (high - low)[met]
    cells, values = np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = np.flatnonzero(np.diff(np.append(-1, np.cumsum(times) // MATCHES)))
    for a, b in zip(edges, np.append(edges[1:], len(rows))):
        t = times[a:b]
        at = np.repeat(low[a:b] - np.cumsum(t) + t, t) + np.arange(t.sum())
        found, counts = np.unique(np.repeat(rows[a:b], t) * width + right[1][at], return_counts=True)
        cells, place = np.unique(np.append(cells, found), return_inverse=True)
        values = np.bincount(place, np.append(values, counts), len(cells)).astype(np.int64)
    return cells, values


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node reachable) that connect what the links ``a`` - ``b`` connect."""
    nodes, ends = np.unique(np.append(a, b), return_inverse=True)
    a, b = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _product(left: pa.Table, right: pa.Table, percent: int) -> pa.Table:
    nodes_a, sizes_a, *cells_a = _entries(left)
    nodes_b, sizes_b, *cells_b = _entries(right)
    a = b = np.zeros(0, np.int64)
    if len(nodes_a) and len(nodes_b):
        cells, shared = overlaps(tuple(cells_a), tuple(cells_b), len(nodes_b))
        i, j = np.divmod(cells, len(nodes_b))
        union = sizes_a[i] + sizes_b[j] - shared
        kept = (100 * shared >= percent * union) & (nodes_a[i] != nodes_b[j])
        a, b = forest(nodes_a[i[kept]], nodes_b[j[kept]])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def block_links(left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) found by multiplying the blocks of ``left`` and ``right`` (block, part, node, grams) that match."""
    def multiply(a: pa.Table, b: pa.Table) -> pa.Table:
        return _product(a, b, percent)
    left, right = (side.select(*[F.col(c).alias(c) for c in ("block", "part", "node", "grams")]) for side in (left, right))
    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(multiply, "a long, b long")


def _shared_columns(source: DataFrame, held: int, stages: Stages, percent: int, width: int) -> np.ndarray:
    """Bit filter over the first columns (``held`` entries in all) that more than one row may hold.

    Only four bytes and a count of an entry are shuffled for it. Most columns are of one row and are never sent as entries.
    """
    bucket_bits = max(10, (BUCKETS_AN_ENTRY * held).bit_length())
    low = bucket_bits - (held // PART_ENTRIES).bit_length()
    counts = source.mapInArrow(lambda it: _column_batches(it, width, percent, bucket_bits, low), "part long, buckets binary, counts binary")
    found = counts.groupBy("part").applyInArrow(lambda part: full_buckets(part, 2, low, np.uint8), "bucket long")
    return bucket_filter(stages.write(found))


def _lists(inputs: DataFrame) -> DataFrame:
    """Rows (column, node, n, central) of the lists: the rarest of every row's first columns that other rows hold too."""
    entries = inputs.where("first IS NOT NULL").select("node", "n", "listed", F.size("first").alias("held"), F.explode("first").alias("column"))
    # Counted where the rows of a column meet anyway: entries are made and shuffled once. A set that several tasks met comes
    # several times; it shares nothing with itself, and its columns are listed once.
    same = W.partitionBy("column")
    met = entries.select("*", F.count("*").over(same).alias("df"), F.min("node").over(same).alias("low"), F.max("node").over(same).alias("high"))
    # Shuffled as plain rows: sets of a task, made before, take more room.
    shared = (met.where("low < high").select("node", "n", "listed", "held", "df", "column").repartition("node").groupBy("node", "n", "listed", "held")
              .agg(F.sort_array(F.collect_set(F.struct("df", "column"))).alias("shared")))
    room = F.greatest(F.col("listed") - (F.col("held") - F.size("shared")), F.lit(0)).cast("int")
    return shared.select("node", "n", (F.size("shared") / F.col("n")).alias("central"),
                         F.explode(F.slice("shared", 1, room)["column"]).alias("column"))


def _blocks(groups: DataFrame, partners: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks of the rows of ``groups`` (key, node, n) and of their ``partners`` (key, node, n), for `block_links`.

    Groups are packed into blocks of about ``CELLS`` entries by their key, with the partners of all of them; a block with more
    entries of partners is cut into parts, each with the whole groups.
    """
    cells = groups.agg(F.sum("n")).first()[0] or 0
    block = F.pmod(F.xxhash64("key"), F.lit(max(1, -(-cells // CELLS)))).alias("block")
    partners = partners.select(block, "node", "n").distinct()
    parts = partners.groupBy("block").agg(F.ceil(F.sum("n") / CELLS).alias("parts"))
    right = partners.join(parts, "block").select("block", F.pmod(F.xxhash64("node"), "parts").alias("part"), "node")
    left = groups.select(block, "node").distinct().join(parts, "block").select(
        "block", "node", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    return left.join(rows, "node"), right.join(rows, "node")


def _list_groups(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups of the rows that have their longest list in common, and as partners all rows of groups they share a list with.

    A row stands in dozens of lists with nearly the same rows. By groups, two of them meet once and not in every list.
    """
    lengths = lists.groupBy("column").agg(F.count("*").alias("rows"))
    longest = lists.join(lengths, "column").groupBy("node", "n").agg(F.max(F.struct("rows", "column"))["column"].alias("longest"))
    parts = longest.groupBy("longest").agg(F.ceil(F.sum("n") / CELLS).alias("parts"))
    groups = longest.join(parts, "longest").select(
        F.xxhash64("longest", F.pmod(F.xxhash64("node"), "parts")).alias("key"), "node", "n")
    present = lists.select("column", "node").join(groups.select("node", "key"), "node").select("column", "key").distinct()
    meeting = (present.join(present.select("column", F.col("key").alias("other")), "column").where("key <= other")
               .select("key", "other").distinct())
    return groups, meeting.join(groups.withColumnRenamed("key", "other"), "other").select("key", "node", "n")


def _open_lists(lists: DataFrame, links: DataFrame) -> DataFrame:
    """The lists whose rows are in several components, each set of rows once."""
    groups = components(links).withColumnRenamed("node", "in")
    placed = lists.join(groups, lists["node"] == groups["in"], "left").select(
        "column", "node", "n", F.coalesce("root", "node").alias("component"))
    per = placed.groupBy("column").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least"),
        F.count("*").alias("rows"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    once = per.where("low < high").groupBy("rows", "x", "y").agg(F.min_by(F.struct("column", "least"), "column").alias("l"))
    return placed.join(once.select("l.column", "l.least"), "column").select("column", "node", "n", "component", "least")


def ngram_join_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
                      width: int = NGRAM_WORDS) -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id`` for every row of ``docs``.

    Documents link when ``100 * |A and B| >= percent * |A or B|`` over their sets of ``width``-word n-grams (A-Z lower-cased;
    fewer words make one n-gram). ``component_id`` is the smallest id reachable over links. Null or word-less texts have an
    empty set and are linked with nothing. A null id is a document of its own with a null component. Rows that repeat an id
    are one document when their texts agree; otherwise their links are joined under that id. Other columns are not read. An
    empty table gives an empty table. N-grams are told apart by 64-bit hashes.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    sized = source.mapInArrow(lambda it: _size_batches(it, width, percent), "id long, n long, digest binary, held long")
    spark = docs.sparkSession
    with Stages(spark, BATCH_ROWS) as stages:
        base = stages.write(sized.select("id", "n", "held", _node(F.col("digest")).alias("node")))
        named = base.where("n > 0 AND id IS NOT NULL")
        with_id = source.where("id IS NOT NULL")
        shared = spark.sparkContext.broadcast(_shared_columns(with_id, named.agg(F.sum("held")).first()[0] or 0, stages, percent, width))
        firsts = with_id.mapInArrow(lambda it: _row_batches(it, width, percent, shared.value), "n long, digest binary, listed long, first array<long>")
        lists = _lists(firsts.select(_node(F.col("digest")).alias("node"), "n", "listed", "first"))
        several = lists.groupBy("column").agg(
            F.count("*").alias("rows"), F.max(F.struct("central", F.col("n").alias("size"), F.col("node").alias("leader"))).alias("l"))
        lists = stages.write(lists.join(several.where("rows > 1").select("column", "l.leader", "l.size"), "column"))
        near = f"100 * least(n, size) >= {percent} * greatest(n, size)"
        members = lists.where(f"node <> leader AND {near}").select(F.col("leader").alias("key"), "node", "n", "size").distinct()

        # Texts are not shuffled: a bit filter over the ids finds those whose whole rows are wanted.
        wanted = named.groupBy("node").agg(F.min("id").alias("id")).join(lists.select("node").distinct(), "node", "left_semi")
        ids = spark.sparkContext.broadcast(bucket_filter(stages.write(wanted.select(F.xxhash64("id").alias("bucket")))))
        full = with_id.select(F.xxhash64("id").alias("bucket"), "text").mapInArrow(
            lambda it: _full_batches(it, width, ids.value), "digest binary, grams array<long>")
        full = full.select(_node(F.col("digest")).alias("node"), "grams")
        rows = stages.write(full.repartition(stages.buckets, "node").groupBy("node").agg(F.first("grams").alias("grams")), "node")
        members = stages.write(members)
        leaders = members.select("key", F.col("key").alias("node"), F.col("size").alias("n")).distinct()
        links = stages.write(block_links(*_blocks(leaders, members.select("key", "node", "n"), rows), percent))

        lists = stages.write(_open_lists(lists.select("column", "node", "n"), links))
        entries = rows.join(lists.select("node").distinct(), "node", "left_semi").select("node", F.explode("grams").alias("gram"))
        alone = entries.groupBy("gram").agg(F.count("*").alias("rows"), F.min("node").alias("node")).where("rows = 1")
        own = alone.groupBy("node").agg(F.count("*").alias("own"))
        # With a partner of the least size, what a row shares with any other open row must reach the bound.
        able = (lists.join(own, "node", "left")
                .where(f"{100 + percent} * (n - coalesce(own, 0)) >= {percent} * (n + least)"))
        still = able.groupBy("column").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
        able = stages.write(able.join(still, "column", "left_semi").select("column", "node", "n"))
        links = links.unionByName(stages.write(block_links(*_blocks(*_list_groups(able), rows), percent)))

        # An id on several rows may stand for several sets, which are joined under it.
        held = named.select("id", "node").distinct()
        same = held.join(held.groupBy("id").agg(F.min("node").alias("b"), F.max("node").alias("last")).where("b <> last"), "id")
        groups = components(links.unionByName(same.select(F.col("node").alias("a"), "b")))
        nodes = held.groupBy("node").agg(F.min("id").alias("least"))
        placed = nodes.join(groups, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
        found = placed.join(placed.groupBy("root").agg(F.min("least").alias("component")), "root").select("node", "component")
        out = base.join(found.withColumnRenamed("node", "row"), (F.col("n") > 0) & (F.col("node") == F.col("row")), "left")
        return stages.last(out.select("id", F.col("n").alias("n_shingles"),
                                      F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")))
