"""Exact quantiles by group, without all values of a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Accuracy of the sketch that brackets a quantile: between its bounds lie about 8/ACCURACY of
#: the values; of fewer than ACCURACY values, all.
ACCURACY = 10_000
#: Equal parts of a bracket. Only values of the part in which a quantile lies are put in order.
CELLS = 1_024


def exact(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, q): of each group with a value, the quantiles as an array in the order of probs,
    interpolated between the two nearest values. Without keys there is one row; its quantiles
    are null if there is no value.

    A sketch, which merges from all tasks, brackets each quantile. A second pass counts the
    values below each bracket, and by value those within, about 8/ACCURACY of all. Each
    bracket is parted in CELLS by value; running sums over these find the one or two that
    hold the quantile, and only their values are put in order. Groups are joined by their
    keys, null being one of them.
    """
    v = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    spread = 4 / ACCURACY
    asked = lambda d: F.array(*[F.lit(min(1.0, max(0.0, p + d))) for p in probs])
    sketch = lambda d: F.percentile_approx("_v", asked(d), ACCURACY)
    ends = [F.min("_v").alias("_least"), F.max("_v").alias("_most"), F.count("*").alias("_n")]
    found = v.groupBy(*keys).agg(sketch(-spread).alias("_lo"), sketch(spread).alias("_hi"), *ends) if keys else v.agg(sketch(-spread).alias("_lo"), sketch(spread).alias("_hi"), *ends)
    few = F.col("_n") < ACCURACY
    bound = lambda c, edge, far: F.array(*[F.col(edge) if far(p) else F.when(few, F.col(edge)).otherwise(F.element_at(c, i + 1)) for i, p in enumerate(probs)])
    bounds = found.select(*[F.col(k).alias(f"_{k}") for k in keys], bound("_lo", "_least", lambda p: p <= spread).alias("_lo"), bound("_hi", "_most", lambda p: p >= 1 - spread).alias("_hi"), "_n")

    def beside(rows: DataFrame) -> DataFrame:
        if not keys:
            return rows.crossJoin(F.broadcast(bounds))  # one row
        return rows.join(bounds, reduce(lambda a, b: a & b, [rows[k].eqNullSafe(bounds[f"_{k}"]) for k in keys]))

    with_bounds = beside(v)
    # a value that is itself computed, such as a mean, may differ in its last digits from pass to pass
    near = lambda c, i, way: F.element_at(c, i + 1) + way * 1e-9 * F.abs(F.element_at(c, i + 1))
    lo, hi = (lambda i: near("_lo", i, -1)), (lambda i: near("_hi", i, 1))
    # 2i: below bracket i; 2i + 1: within it
    where = F.concat(*[F.when(F.col("_v") < lo(i), F.array(F.lit(2 * i))).when(F.col("_v") <= hi(i), F.array(F.lit(2 * i + 1))).otherwise(F.array().cast("array<int>")) for i in range(len(probs))])
    cell = lambda i: F.coalesce(F.floor(F.try_divide((F.col("_v") - lo(i)) * CELLS, hi(i) - lo(i))), F.lit(0))
    inside = F.least(F.lit(CELLS - 1), F.element_at(F.array(*[cell(i) for i in range(len(probs))]), F.floor(F.col("_at") / 2).cast("int") + 1))
    marked = with_bounds.select("*", F.explode(where).alias("_at"))
    marked = marked.select(*keys, "_n", F.floor(F.col("_at") / 2).cast("int").alias("_i"), F.when(F.col("_at") % 2 == 0, -1).otherwise(inside).cast("int").alias("_cell"), F.when(F.col("_at") % 2 == 1, F.col("_v")).alias("_v"))
    counted = marked.groupBy(*keys, "_n", "_i", "_cell", "_v").agg(F.count("*").alias("_c"))
    rank = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("_i") + 1) * (F.col("_n") - 1)
    cells = counted.groupBy(*keys, "_n", "_i", "_cell").agg(F.sum("_c").alias("_c"))
    before = F.coalesce(F.sum("_c").over(W.partitionBy(*keys, "_i").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # CELLS + 1 rows
    holds = cells.withColumn("_before", before).withColumn("_rank", rank)
    spans = lambda r: (F.col("_before") <= r) & (F.col("_before") + F.col("_c") > r)
    holds = holds.where((F.col("_cell") >= 0) & (spans(F.floor("_rank")) | spans(F.ceil("_rank")))).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_i").alias("_j"), F.col("_cell").alias("_held"), "_before", "_rank")
    same = [counted[k].eqNullSafe(holds[f"_{k}"]) for k in keys] + [counted["_i"] == holds["_j"], counted["_cell"] == holds["_held"]]
    order = W.partitionBy(*keys, "_i", "_cell").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    upto = counted.join(holds, reduce(lambda a, b: a & b, same)).withColumn("_upto", F.col("_before") + F.sum("_c").over(order))
    # a rank may fall on the first value of a cell, or on the last one's successor in the next
    nth = lambda r: F.min(F.when((F.col("_upto") > r) & (F.col("_before") <= r), F.col("_v")))
    pair = upto.groupBy(*keys, "_i").agg(nth(F.floor("_rank")).alias("_a"), nth(F.ceil("_rank")).alias("_b"), F.first("_rank").alias("_rank"))
    q = F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_rank") - F.floor("_rank"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_i", q.alias("q")))), lambda x: x["q"]).alias("q")
    if keys:
        return pair.groupBy(*keys).agg(listed)
    none = F.array(*[F.lit(None).cast("double") for _ in probs])
    return pair.agg(listed).select(F.when(F.size("q") > 0, F.col("q")).otherwise(none).alias("q"))


def pick(i: int) -> Column:
    """The i-th of the quantiles."""
    return F.element_at("q", i + 1)
