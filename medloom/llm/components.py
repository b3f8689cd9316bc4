"""Connected components by random contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stage


def components(edges: DataFrame) -> DataFrame:
    """Label the nodes of ``edges`` (src, dst: long) by component: (node, label).

    In each round every node moves to the neighbour (or stays with itself) that comes
    first in a random order drawn for the round; edges are then renamed, and those within
    a node go. A constant share of the nodes goes in each round, whatever the shape, so
    the rounds grow with the logarithm of the size. Each round is a grouped minimum and
    two joins on node ids; nothing is gathered by component. The label is one of the
    component's nodes. No edges: no rows.
    """
    first = stage(edges.where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct(), "edges")
    moves, now, turn = [], first, 0
    while not now.isEmpty():
        both = now.unionByName(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        rank = lambda c: F.xxhash64(F.lit(turn), c)  # noqa: B023, E731
        best = both.groupBy(F.col("src").alias("node")).agg(F.min(F.struct(rank(F.col("dst")).alias("r"), F.col("dst").alias("to"))).alias("b"))
        move = stage(best.select("node", F.when(F.col("b.r") < rank(F.col("node")), F.col("b.to")).otherwise(F.col("node")).alias("to")), "moves")
        moves.append(move)
        a, b = move.toDF("src", "a"), move.toDF("dst", "b")
        now = now.join(a, "src").join(b, "dst").where("a <> b").select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct()
        now, turn = stage(now, "edges"), turn + 1
    if not moves:
        return first.select(F.col("src").alias("node"), F.col("dst").alias("label"))
    out = moves[0].toDF("node", "label")
    for move in moves[1:]:
        out = out.join(move.toDF("label", "next"), "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return out
