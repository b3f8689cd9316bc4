"""Eras: spans of exposure or of a condition, and what happens when they stop and come back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def collapse(rows: DataFrame, by: Sequence[str], start: str, end: str | None = None, gap: int = 0, supply: str | None = None, carry: bool = False) -> DataFrame:
    """(by, era_number, era_start, era_end, n_rows, gap_days): rows of a group are one
    era as long as at most ``gap`` days in a row have none; gap 0: rows that overlap or touch.

    A row lasts from start to end, both included, else for ``supply`` days, else for a day;
    an end before the start counts as the start. With ``carry`` a row lasts for its supply
    (or as long as its dates say), and what is left of the earlier ones' supply when it
    starts is used up first, so that early refills lengthen the era. gap_days are days of the
    era that no row covers. Rows without a start are left out; a null key is a group.

    Running sums and maxima over a group's rows in order of start; no row meets another.
    """
    last = F.col(end) if end else F.lit(None).cast("date")
    days = F.col(supply).cast("int") if supply else F.lit(None).cast("int")
    a, b = F.col("_a"), F.col("_b")
    r = rows.where(F.col(start).isNotNull()).select(*by, F.datediff(start, F.lit("1970-01-01").cast("date")).alias("_a"), F.datediff(last, F.col(start)).alias("_long"), days.alias("_d"))
    own = F.coalesce("_d", F.col("_long") + 1) if carry else F.coalesce(F.col("_long") + 1, "_d")
    r = r.select(*by, "_a", F.greatest(F.lit(1), F.coalesce(own, F.lit(1))).alias("_n"))
    w = W.partitionBy(*by).orderBy("_a", "_n")
    upto, before = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(W.unboundedPreceding, -1)
    if carry:  # the day after row i is covered: the latest of start j + supply of j to i
        total = F.sum("_n").over(upto)
        r = r.withColumn("_total", total).withColumn("_b", F.col("_total") + F.max(a - (F.col("_total") - F.col("_n"))).over(upto))
        r = r.withColumn("_prev", F.lag("_b").over(w))
    else:
        r = r.withColumn("_b", a + F.col("_n")).withColumn("_prev", F.max("_b").over(before))
    free = a - F.col("_prev")  # days without cover before this row
    r = r.withColumn("_new", F.coalesce((free > gap).cast("int"), F.lit(1)))
    r = r.withColumn("_era", F.sum("_new").over(upto)).withColumn("_free", F.when(F.col("_new") == 0, F.greatest(F.lit(0), free)).otherwise(0))
    g = r.groupBy(*by, "_era").agg(F.min("_a").alias("_s"), (F.max("_b") - 1).alias("_e"), F.count("*").alias("n_rows"), F.sum("_free").alias("gap_days"))
    day = lambda c: F.date_from_unix_date(F.col(c).cast("int"))
    return g.select(*by, F.col("_era").cast("int").alias("era_number"), day("_s").alias("era_start"), day("_e").alias("era_end"), "n_rows", "gap_days")


def challenges(exposures: DataFrame, outcomes: DataFrame, stop_within: int = 30, watch: int = 30) -> DataFrame:
    """Trials of stopping and of taking again: (subject_id, exposure_id, outcome_id, trial,
    stopped, dechallenge, again, rechallenge).

    exposures: eras (subject_id, exposure_id, era_start, era_end); outcomes: (subject_id,
    outcome_id, outcome_date). A trial of stopping is an era that ends within ``stop_within``
    days after its first outcome. It succeeds (dechallenge 1) if no outcome falls within
    ``watch`` days after its end, else fails (0). If it succeeds and a later era of the
    same exposure begins, that one is the trial of taking again: rechallenge 1 if an
    outcome falls within it (the harm came back), else 0; null if there is no such era.
    Trials are numbered by era. An outcome on the last day belongs to the era.
    """
    keys = ["subject_id", "exposure_id"]
    w = W.partitionBy(*keys).orderBy("era_start")
    e = exposures.select(*keys, "era_start", "era_end").withColumn("again", F.lead("era_start").over(w)).withColumn("again_end", F.lead("era_end").over(w))
    o = outcomes.select("subject_id", "outcome_id", "outcome_date").distinct()
    d, end, again = F.col("outcome_date"), F.col("era_end"), F.col("again")
    near = (d >= F.col("era_start")) & ((d <= F.date_add(end, watch)) | d.between(again, F.col("again_end")))
    j = e.join(o, "subject_id").where(near)
    inside, after = d <= end, (d > end) & (d <= F.date_add(end, watch))
    g = j.groupBy(*keys, "outcome_id", "era_start", "era_end", "again").agg(F.min(F.when(inside, d)).alias("first"), F.count_if(after).alias("n_after"), F.count_if(d.between(again, F.col("again_end"))).alias("n_again"))
    g = g.where(F.datediff("era_end", "first") <= stop_within).withColumn("dechallenge", (F.col("n_after") == 0).cast("int"))
    trial = F.row_number().over(W.partitionBy(*keys, "outcome_id").orderBy("era_start"))
    tried = (F.col("dechallenge") == 1) & again.isNotNull()
    return g.select(*keys, "outcome_id", trial.alias("trial"), end.alias("stopped"), "dechallenge", F.when(F.col("dechallenge") == 1, again).alias("again"), F.when(tried, (F.col("n_again") > 0).cast("int")).alias("rechallenge"))


def challenge_counts(trials: DataFrame) -> DataFrame:
    """Trials and persons by exposure and outcome: (exposure_id, outcome_id, n_trials,
    n_persons, n_dechallenge, n_dechallenge_failed, n_rechallenge, n_came_back)."""
    c = lambda name, test: F.count_if(test).alias(name)
    d, r = F.col("dechallenge"), F.col("rechallenge")
    return trials.groupBy("exposure_id", "outcome_id").agg(F.count("*").alias("n_trials"), F.count_distinct("subject_id").alias("n_persons"), c("n_dechallenge", d == 1), c("n_dechallenge_failed", d == 0), c("n_rechallenge", r.isNotNull()), c("n_came_back", r == 1))
