"""How well scores tell labels: counts at thresholds, area under the curve, calibration."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Buckets of scores that a group is parted in, so that none of them sorts all scores.
BUCKETS = 1_000


def _by_score(rows: DataFrame, score: str, label: str, keys: Sequence[str]) -> DataFrame:
    """(keys, score, pos, neg): rows of a score together. Rows without score or label don't count."""
    r = rows.where(F.col(score).isNotNull() & F.col(label).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    return r.groupBy(*keys, F.col(score).cast("double").alias("score")).agg(F.count_if(F.col(label).cast("int") == 1).alias("pos"), F.count_if(F.col(label).cast("int") != 1).alias("neg"))


def _beside(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """a joined with the rows of b of the same keys, nulls being equal."""
    if not on:
        return a.crossJoin(F.broadcast(b))  # b has one row
    c = b.select(*[F.col(k).alias(f"_{k}") for k in on], *[x for x in b.columns if x not in on])
    return a.join(c, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in on])).drop(*[f"_{k}" for k in on])


def curve(rows: DataFrame, score: str, label: str, keys: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """(keys, threshold, tp, fp, fn, tn, pos, neg) at each different score: rows that score at
    least the threshold, or less; pos and neg have that very score.

    Scores are counted first. A sketch parts the different scores of a group into buckets of
    about the same number; sums of whole buckets come from a window over the buckets, and
    only scores of one bucket are put in order. So counts are exact, and no task sees all
    scores of a group.
    """
    g = _by_score(rows, score, label, keys)
    edges = F.percentile_approx("score", F.array(*[F.lit(i / buckets) for i in range(1, buckets)]), 10 * buckets).alias("edges")
    bounds = g.groupBy(*keys).agg(edges) if keys else g.agg(edges)
    # the number of edges at or below the score, by halving
    low, high = F.lit(0), F.size("edges")
    step = F.aggregate(F.sequence(F.lit(1), F.lit(buckets.bit_length())), F.struct(low.alias("l"), high.alias("h")), lambda s, _: F.when(s["l"] < s["h"], _halved(s)).otherwise(s), lambda s: s["l"])
    b = _beside(g, bounds, keys).withColumn("bucket", F.coalesce(step, F.lit(0))).drop("edges")
    whole = b.groupBy(*keys, "bucket").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    above = W.partitionBy(*keys).orderBy(F.desc("bucket")).rowsBetween(W.unboundedPreceding, -1)  # at most ``buckets`` rows a group
    every = W.partitionBy(*keys)
    of = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    known = whole.select(*keys, "bucket", of("p", above).alias("p"), of("n", above).alias("n"), of("p", every).alias("all_p"), of("n", every).alias("all_n"))
    inside = W.partitionBy(*keys, "bucket").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, 0)
    c = _beside(b, known, [*keys, "bucket"])
    c = c.withColumn("tp", F.col("p") + F.sum("pos").over(inside)).withColumn("fp", F.col("n") + F.sum("neg").over(inside))
    return c.select(*keys, F.col("score").alias("threshold"), "tp", "fp", (F.col("all_p") - F.col("tp")).alias("fn"), (F.col("all_n") - F.col("fp")).alias("tn"), "pos", "neg")


def _halved(s: Column) -> Column:
    middle = F.floor((s["l"] + s["h"]) / 2).cast("int")
    right = F.get("edges", middle) <= F.col("score")
    return F.struct(F.when(right, middle + 1).otherwise(s["l"]).alias("l"), F.when(right, s["h"]).otherwise(middle).alias("h"))


def at_thresholds(rows: DataFrame, score: str, label: str, thresholds: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, threshold, tp, fp, fn, tn) at given thresholds, in one pass: each row counts in
    the interval between two thresholds, and running sums over these give the rest."""
    cuts = sorted({float(t) for t in thresholds})
    g = _by_score(rows, score, label, keys)
    place = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda t: t <= F.col("score")))
    n = g.groupBy(*keys, place.alias("i")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    total = n.groupBy(*keys).agg(F.sum("pos").alias("all_p"), F.sum("neg").alias("all_n")) if keys else n.agg(F.sum("pos").alias("all_p"), F.sum("neg").alias("all_n"))
    upto = F.explode(F.slice(F.array(*[F.struct(F.lit(i + 1).alias("j"), F.lit(t).alias("threshold")) for i, t in enumerate(cuts)]), 1, F.col("i")))
    at = n.where("i > 0").select(*keys, "pos", "neg", upto.alias("t")).groupBy(*keys, F.col("t.threshold").alias("threshold")).agg(F.sum("pos").alias("tp"), F.sum("neg").alias("fp"))
    spine = total.select("*", F.explode(F.array(*map(F.lit, cuts))).alias("threshold"))
    a = _beside_left(spine, at, [*keys, "threshold"])
    tp, fp = F.coalesce("tp", F.lit(0)), F.coalesce("fp", F.lit(0))
    return a.select(*keys, "threshold", tp.alias("tp"), fp.alias("fp"), (F.col("all_p") - tp).alias("fn"), (F.col("all_n") - fp).alias("tn"))


def _beside_left(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    c = b.select(*[F.col(k).alias(f"_{k}") for k in on], *[x for x in b.columns if x not in on])
    return a.join(c, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in on]), "left").drop(*[f"_{k}" for k in on])


def measures(found: DataFrame) -> DataFrame:
    """found (tp, fp, fn, tn) with sensitivity, specificity, ppv and npv; null where none could."""
    share = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(a) + F.col(b))
    return found.withColumns({"sensitivity": share("tp", "fn"), "specificity": share("tn", "fp"), "ppv": share("tp", "fp"), "npv": share("tn", "fn")})


def auc(rows: DataFrame, score: str, label: str, keys: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """(keys, n_pos, n_neg, auc): the share of pairs of a positive and a negative row in which
    the positive one scores higher, ties being half; null without either."""
    c = curve(rows, score, label, keys, buckets)
    ahead = F.col("neg") * (F.col("tp") - F.col("pos") / 2)
    g = c.groupBy(*keys) if keys else c.groupBy()
    out = g.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"), F.sum(ahead).alias("u"))
    return out.select(*keys, "n_pos", "n_neg", F.try_divide(F.col("u"), F.col("n_pos") * F.col("n_neg")).alias("auc"))


def calibration(rows: DataFrame, score: str, label: str, keys: Sequence[str] = (), groups: int = 10, buckets: int = BUCKETS) -> DataFrame:
    """(keys, bin, n, observed, mean_score, least_score, most_score) of groups of equal size by
    score, from 0; rows of a score stay together, in the group of the lowest of them."""
    c = curve(rows, score, label, keys, buckets)
    below, n = F.col("fn") + F.col("tn"), F.col("pos") + F.col("neg")
    everyone = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    bin_ = F.floor(below * groups / everyone).cast("int")
    g = c.groupBy(*keys, bin_.alias("bin")).agg(F.sum(n).alias("n"), F.sum("pos").alias("events"), F.sum(F.col("threshold") * n).alias("scores"), F.min("threshold").alias("least_score"), F.max("threshold").alias("most_score"))
    return g.select(*keys, "bin", "n", (F.col("events") / F.col("n")).alias("observed"), (F.col("scores") / F.col("n")).alias("mean_score"), "least_score", "most_score")
