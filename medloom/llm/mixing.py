"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .shared import stage
from .words import WORD

#: Bits of the hash that a level of the histogram tells apart, and the number of levels.
BITS, LEVELS = 12, 3


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def bucket(doc_id: str | Column) -> Column:
    """BITS * LEVELS bits that depend on doc_id alone; null goes to 0."""
    digest = F.substring(F.md5(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")), 1, 15)
    return F.coalesce(F.shiftright(F.conv(digest, 16, 10).cast("long"), 60 - BITS * LEVELS), F.lit(0))


def targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Target of each source: (source, source_size, target).

    sizes: (source, source_size). Sources by code point, null last, take the weights in
    turn. They share ``share`` times all words by weight; a target stops at ``most``
    times its source's size and what is above goes to the others by weight. Ordering
    the sources by size/weight turns the repeated resharing into one running sum: the
    sources that stop are the first ones. One row per source passes a single window.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("top", F.lit(most) * F.col("source_size")).withColumn("ratio", F.col("top") / F.col("weight"))
    by = W.orderBy("ratio", F.col("source").asc_nulls_last())
    before, after = by.rowsBetween(W.unboundedPreceding, -1), by.rowsBetween(0, W.unboundedFollowing)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = s.withColumn("level", (F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    s = s.withColumn("level", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "level"))).over(whole)["level"])
    return s.select("source", "source_size", F.coalesce(F.least("top", F.col("level") * F.col("weight")), F.col("top")).alias("target"))


def thresholds(rows: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Where the mix cuts each source: (source, source_size, target, base, cut).

    rows: (source, size, bucket). A document is taken ``base`` times, and once more if
    its bucket is below ``cut``. Level by level, sizes are summed by source and the next
    BITS of the bucket; running sums over at most 2**BITS rows of a source find the
    bucket in which its budget ends, and only that bucket's documents are read for the
    next level. The last bucket is taken whole if that comes nearer to the budget.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    cuts = targets(sizes, weights, share, most)
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    cuts = stage(cuts.withColumn("base", base).withColumn("rest", F.col("target") - F.col("base") * F.col("source_size")), "targets")
    edge = cuts.select(F.col("source").alias("s"), F.lit(0).cast("long").alias("prefix"), F.col("rest"))
    for level in range(1, LEVELS + 1):
        down = BITS * (LEVELS - level)
        own = F.shiftright("bucket", down)
        last = edge.select("s", "prefix", "rest")
        here = rows.join(last, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright(own, BITS) == F.col("prefix"))) if level > 1 else rows
        sums = here.groupBy("source", own.alias("b")).agg(F.sum("size").alias("n"))
        sums = sums.withColumn("upto", F.sum("n").over(W.partitionBy("source").orderBy("b")))
        sums = sums.join(last, F.col("source").eqNullSafe(F.col("s")))
        pick = F.min(F.when(F.col("upto") > F.col("rest"), F.struct("b", (F.col("rest") - F.col("upto") + F.col("n")).alias("left"), "n")))
        edge = sums.groupBy("s").agg(pick.alias("p")).where("p is not null").select("s", F.col("p.b").alias("prefix"), F.col("p.left").alias("rest"), F.col("p.n").alias("n"))
        edge = stage(edge, "edge")
    cut = F.coalesce(F.col("e.prefix") + (F.col("n") < 2 * F.col("e.rest")).cast("long"), F.lit(0))
    out = cuts.alias("c").join(edge.alias("e"), F.col("source").eqNullSafe(F.col("s")), "left")
    return stage(out.select("source", "source_size", "target", "base", cut.alias("cut")), "cuts")


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0, narrow: bool = False) -> DataFrame:
    """How often each document is in the mix: docs with size, source_size, target, copies, taken.

    A null text has no words; null is a source, the last one. Repeated rows share their
    doc_id's hash and are in or out together, as are rows with a null doc_id. A source
    without words has target 0. An empty table gives no rows. Columns of docs that bear
    the names added here are replaced; all others stay. narrow: of docs, only doc_id is returned, and
    texts are read once.
    """
    docs = docs.drop("size", "source_size", "target", "copies", "taken")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # so that no column clashes with those of the work
    sized = docs.select(row.alias("row"), "doc_id", "source", word_count("text").alias("size"), bucket("doc_id").alias("bucket"))
    rows = stage(sized.drop("row"), "sizes")
    cuts = thresholds(rows, weights, share, most)
    right = cuts.select(F.col("source").alias("s"), "source_size", "target", "base", "cut")
    # cuts is a small file, which Spark broadcasts if it is below its threshold
    out = (rows if narrow else sized).join(right, F.col("source").eqNullSafe(F.col("s")))
    out = out.withColumn("copies", F.col("base") + (F.col("bucket") < F.col("cut")).cast("long")).withColumn("taken", F.col("copies") * F.col("size"))
    return out.select("doc_id" if narrow else "row.*", "size", "source_size", "target", "copies", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT >> 24, 0) AS b FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS top FROM s),
r AS (SELECT *, top / weight AS ratio FROM w),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(top) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
        / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
f AS (SELECT level FROM l WHERE ratio >= level ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, coalesce(least(top, (SELECT level FROM f) * weight), top) AS target FROM l),
u AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS base FROM t),
v AS (SELECT *, target - base * source_size AS rest FROM u),
g AS (SELECT source, b, sum(size) AS n FROM d GROUP BY source, b),
c AS (SELECT source, b, n, sum(n) OVER (PARTITION BY source ORDER BY b) - n AS before FROM g)
SELECT d.doc_id, d.size, v.source_size, v.target,
       (d.size * (v.base + CASE WHEN c.before + c.n <= v.rest OR (c.before <= v.rest AND c.n < 2 * (v.rest - c.before)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN v ON d.source IS NOT DISTINCT FROM v.source JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.b = c.b
"""
