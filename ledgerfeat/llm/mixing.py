"""Mixing sources to target weights by Efraimidis-Spirakis sampling to token budgets.

Every document draws the key -ln(u) / w, u from a hash of its id and text and w its quality weight; small keys come first,
so a document of higher weight tends to come earlier. Budgets are filled by whole passes over a source first; the rest
goes to documents in the order of keys until the budget is spent; the document on the edge gives its first words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfeat.llm.text import word_count
from ledgerfeat.session import pin

SOURCE_WEIGHTS = (5, 2, 1)
BUDGET_SHARE = 1.5
MOST_EPOCHS = 2
SEED = 17
#: Slices of the key range in which a source's sizes are summed before the edge slice is put in order.
KEY_SLICES = 65_536
OTHER_MARKS = r"[^\p{L} ]+"


def letter_share(text: Column) -> Column:
    """Quality weight of a text: 0.1 for none, up to 1.0 for letters and spaces alone."""
    length = F.greatest(F.length(text), F.lit(1))
    return F.lit(0.1) + F.lit(0.9) * F.coalesce(F.length(F.regexp_replace(text, OTHER_MARKS, "")) / length, F.lit(0.0))


def uniform(doc_id: Column, text: Column, seed: int) -> Column:
    """Number in (0, 1), fixed by the id, the text and the seed."""
    digest = F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(str(seed)),
                               F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = SOURCE_WEIGHTS, share: float = BUDGET_SHARE,
                   most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``target`` for each row (source, source_size) of ``sizes``.

    Weights repeat over the sources by code point, null last. A target stops at ``most_epochs`` times its source's size
    and the excess is shared anew by weight until none is above: every target is min(cap, level * weight), where the
    level follows from the sources in order of cap / weight. One row per source; sources without words get 0.
    """
    # Rows are sources, few beside documents; they share one order.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    placed = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    weight = F.array(*[F.lit(float(w)) for w in weights])[(F.col("place") % len(weights)).cast("int")]
    rows = placed.withColumns({"weight": weight, "cap": F.col("source_size") * F.lit(float(most_epochs))})
    fullness = F.col("cap") / F.col("weight")
    before = Window.orderBy(fullness, "place").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(fullness, "place").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = Window.partitionBy()
    rows = rows.withColumns({
        "all": F.sum("source_size").over(total) * F.lit(float(share)),
        "capped": F.coalesce(F.sum("cap").over(before), F.lit(0.0)), "open": F.sum("weight").over(after)})
    # The level if this source and all later ones stay below their caps; the first that holds is the level.
    level = (F.col("all") - F.col("capped")) / F.col("open")
    held = F.min(F.when(level * F.col("weight") <= F.col("cap"), F.struct(fullness.alias("f"), "place", level.alias("l")))).over(total)
    return rows.withColumn("level", held["l"]).select(
        "source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        quality: Column | None = None, seed: int = SEED, weights: tuple[int, ...] = SOURCE_WEIGHTS,
        share: float = BUDGET_SHARE, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``taken`` for every row of ``docs``.

    ``size`` is the number of words (null text: 0), ``taken`` the words of the document in the mix, repeats counted: whole
    passes over the source plus what the last, fractional pass takes. No document gives more than ``most_epochs`` times
    its size. ``quality`` weighs documents (default: the share of letters); null or non-positive weights count as tiny.
    Sums within a source run over slices of the key range first, so no task orders a whole source: only the slice in
    which the budget ends is put in order. Equal keys fall back to id and size. Repeated rows are documents of their
    own. Null sources form one source. Other columns are not read. An empty table gives an empty table.
    """
    weight = letter_share(F.col(text_col)) if quality is None else quality
    weight = F.greatest(F.coalesce(weight.cast("double"), F.lit(1e-9)), F.lit(1e-9))
    draw = uniform(F.col(id_col), F.col(text_col), seed)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"), (-F.ln(draw) / weight).alias("key"))
    # exp(-key) falls from 1 to 0 as the key grows: slices of about equal count for weights near 1.
    # One pass over the texts; every later step reads these few numbers.
    slice_no = F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * KEY_SLICES).cast("int")
    rows = pin(rows.withColumn("slice", slice_no))
    per_slice = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    targets = source_targets(per_slice.groupBy("source").agg(F.sum("slice_size").alias("source_size")),
                             weights, share, most_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("passes", whole).withColumn(
        "rest", F.floor(F.col("target") - F.col("passes") * F.col("source_size")).cast("long"))
    ahead = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = per_slice.withColumn("ahead", F.coalesce(F.sum("slice_size").over(ahead), F.lit(0)))
    targets = targets.withColumnRenamed("source", "its_source")
    known = slices.join(targets, F.col("source").eqNullSafe(F.col("its_source"))).select(
        "its_source", F.col("slice").alias("its_slice"), "slice_size", "ahead", "source_size", "target", "passes", "rest")
    edge = (F.col("ahead") < F.col("rest")) & (F.col("ahead") + F.col("slice_size") > F.col("rest"))
    known = known.withColumn("edge", edge)
    same = F.col("source").eqNullSafe(F.col("its_source")) & (F.col("slice") == F.col("its_slice"))
    placed = rows.join(known, same).drop("its_source", "its_slice", "slice_size")
    fraction = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    order = (Window.partitionBy("source", "slice").orderBy("key", "doc_id", "size")
             .rowsBetween(Window.unboundedPreceding, -1))
    edges = placed.where("edge").withColumn("before", F.col("ahead") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    plain = placed.where("NOT edge").withColumn("before", F.col("ahead"))
    inside = F.when(F.col("ahead") < F.col("rest"), F.col("size")).otherwise(0)
    both = (edges.withColumn("extra", fraction)).unionByName(plain.withColumn("extra", inside))
    return both.select("doc_id", "source", "size", "source_size", "target",
                       (F.col("passes") * F.col("size") + F.col("extra")).cast("long").alias("taken"))
