"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfeat.session import pin


def _rank(column: str):
    return F.struct(F.xxhash64(column).alias("h"), F.col(column).alias("id"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node of ``edges`` (columns ``a`` and ``b``).

    In each round every node moves to its neighbour of least hash (or stays), edges follow and those inside one node
    vanish. Hashed order shortens chains by a share per round, so rounds grow with the logarithm of the longest path.
    Each round reads and writes edge tables only: nothing reaches the driver. Self loops and repeats are allowed; an
    empty table gives an empty table.
    """
    live = pin(edges.select("a", "b"))
    steps: list[DataFrame] = []
    while True:
        ends = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = pin(ends.groupBy(F.col("a").alias("node")).agg(F.min(_rank("b")).alias("m"))
                    .select("node", F.least(F.col("m"), _rank("node"))["id"].alias("parent")))
        steps.append(moves)
        left = moves.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = moves.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        live = pin(live.join(left, "a").join(right, "b").where("pa <> pb")
                   .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        if live.isEmpty():
            break
    found = steps[0]
    for step in steps[1:]:
        found = (found.join(step.select(F.col("node").alias("parent"), F.col("parent").alias("next")), "parent", "left")
                 .select("node", F.coalesce("next", "parent").alias("parent")))
    found = pin(found)
    least = found.groupBy("parent").agg(F.min("node").alias("root"))
    return found.join(least, "parent").select("node", "root")
