"""What happens to cohorts: attrition by criteria, overlap and timing, standardised differences."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Criterion:
    """At least ``least`` and at most ``most`` events that ``test`` holds for, within days
    ``start`` to ``end`` of the episode's start. source: the key of the events' table; None:
    the test is on the episode itself."""

    name: str
    source: str | None
    test: Column
    start: int | None = None
    end: int | None = None
    least: int = 1
    most: int | None = None


def masks(cohort: DataFrame, sources: dict[str, tuple[DataFrame, str]], criteria: Sequence[Criterion]) -> DataFrame:
    """(subject_id, episode_id, mask): bit i is set if criterion i holds, of up to 63.

    sources: {key: (events, date)}. Events that no criterion asks for go where they are read;
    the others of all sources meet the episodes in one join by person and are counted in
    one aggregate, which needs no other shuffle. Episodes without any have counts of 0.
    """
    if len(criteria) > 63:
        raise ValueError("a mask has 63 bits")
    if unknown := {c.source for c in criteria} - {None, *sources}:
        raise ValueError(f"no such source: {sorted(unknown)}")
    keys, none = ["subject_id", "episode_id"], F.lit(False)
    bits = lambda tests: sum((F.when(t, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, t in tests), F.lit(0).cast("long"))
    asked = [(i, c) for i, c in enumerate(criteria) if c.source is not None]
    out = cohort.select(*keys, "cohort_start_date", bits((i, c.test) for i, c in enumerate(criteria) if c.source is None).alias("_own"))
    every = None
    for key, (events, date) in sources.items():
        if not any(c.source == key for _, c in asked):
            continue
        flags = [(F.coalesce(c.test, none) if c.source == key else none).alias(f"_c{i}") for i, c in asked]
        e = events.withColumnRenamed("person_id", "subject_id").select("subject_id", F.col(date).alias("_d"), *flags)
        e = e.where(reduce(or_, [F.col(f"_c{i}") for i, c in asked if c.source == key]))
        every = e if every is None else every.unionByName(e)
    if every is None:
        return out.groupBy(*keys).agg(F.bit_or("_own").alias("mask"))
    day, counts = F.datediff("_d", "cohort_start_date"), []
    for i, c in asked:
        t = F.col(f"_c{i}") if c.start is None else F.col(f"_c{i}") & (day >= c.start)
        counts.append(F.count_if(t if c.end is None else t & (day <= c.end)).alias(f"_n{i}"))
    n = out.join(every, "subject_id", "left").groupBy(*keys).agg(F.bit_or("_own").alias("_own"), *counts)
    holds = ((i, (F.col(f"_n{i}") >= c.least) & (F.lit(True) if c.most is None else F.col(f"_n{i}") <= c.most)) for i, c in asked)
    return n.select(*keys, F.col("_own").bitwiseOR(bits(holds)).alias("mask"))


def attrition(found: DataFrame, criteria: Sequence[Criterion]) -> DataFrame:
    """(criterion, name, n_in, n_passed, n_passed_this, n_passed_only, n_failed_only), a row for
    each criterion, from 1: episodes that pass all before it, that pass it too, that pass it
    whatever the others say, it alone, and all but it. Computed from the counts by mask."""
    k = len(criteria)
    full = (1 << k) - 1
    m = F.col("mask")
    counted = found.groupBy("mask").agg(F.count("*").alias("n"))
    has = lambda want: m.bitwiseAND(F.lit(want).cast("long")) == want
    row = lambda i, c: F.struct(F.lit(i + 1).alias("criterion"), F.lit(c.name).alias("name"), has((1 << i) - 1).alias("a"), has((2 << i) - 1).alias("b"), has(1 << i).alias("t"), (m == (1 << i)).alias("o"), (m == full - (1 << i)).alias("f"))
    each = counted.select("n", F.explode(F.array(*[row(i, c) for i, c in enumerate(criteria)])).alias("r"))
    n = lambda c, name: F.coalesce(F.sum(F.when(F.col(f"r.{c}"), F.col("n"))), F.lit(0)).alias(name)
    return each.groupBy("r.criterion", "r.name").agg(n("a", "n_in"), n("b", "n_passed"), n("t", "n_passed_this"), n("o", "n_passed_only"), n("f", "n_failed_only"))


def passing(cohort: DataFrame, found: DataFrame, criteria: Sequence[Criterion]) -> DataFrame:
    """Episodes that meet all criteria."""
    return cohort.join(found.where(F.col("mask") == (1 << len(criteria)) - 1), ["subject_id", "episode_id"], "left_semi")


def _firsts(cohorts: DataFrame) -> DataFrame:
    return cohorts.groupBy("subject_id", "cohort_definition_id").agg(F.min("cohort_start_date").alias("first"))


def timing(cohorts: DataFrame) -> DataFrame:
    """(cohort_1, cohort_2, days, n_persons): persons in both of two cohorts, cohort_1 being the
    smaller number, by the days from their first start in cohort_1 to that in cohort_2.
    Pairs come from a person's own memberships only."""
    f = _firsts(cohorts)
    a = f.select("subject_id", F.col("cohort_definition_id").alias("cohort_1"), F.col("first").alias("a"))
    b = f.select("subject_id", F.col("cohort_definition_id").alias("cohort_2"), F.col("first").alias("b"))
    both = a.join(b, "subject_id").where("cohort_1 < cohort_2")
    return both.groupBy("cohort_1", "cohort_2", F.datediff("b", "a").alias("days")).agg(F.count("*").alias("n_persons"))


def overlap(cohorts: DataFrame) -> DataFrame:
    """(cohort_1, cohort_2, n_1, n_2, n_both, n_only_1, n_only_2, n_first_1, n_same_day,
    n_first_2) of each pair of cohorts that share a person."""
    size = _firsts(cohorts).groupBy("cohort_definition_id").agg(F.count("*").alias("n"))
    d = F.col("days")
    n = lambda test: F.coalesce(F.sum(F.when(test, F.col("n_persons"))), F.lit(0))
    g = timing(cohorts).groupBy("cohort_1", "cohort_2").agg(F.sum("n_persons").alias("n_both"), n(d > 0).alias("n_first_1"), n(d == 0).alias("n_same_day"), n(d < 0).alias("n_first_2"))
    for i in (1, 2):
        g = g.join(size.select(F.col("cohort_definition_id").alias(f"cohort_{i}"), F.col("n").alias(f"n_{i}")), f"cohort_{i}")
    return g.select("cohort_1", "cohort_2", "n_1", "n_2", "n_both", (F.col("n_1") - F.col("n_both")).alias("n_only_1"), (F.col("n_2") - F.col("n_both")).alias("n_only_2"), "n_first_1", "n_same_day", "n_first_2")


def covariate_sums(covariates: DataFrame, cohorts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, cohort, n, covariate_id, total, squares): sums over the persons of cohorts
    (subject_id, cohort 1 or 2, keys) of sparse covariates (subject_id, covariate_id,
    value), and how many persons the cohort has. These add up over sites."""
    size = cohorts.groupBy(*keys, "cohort").agg(F.count_distinct("subject_id").alias("n"))
    member = cohorts.select("subject_id", "cohort", *keys).distinct()
    v = F.col("value").cast("double")
    sums = covariates.join(member, "subject_id").groupBy(*keys, "cohort", "covariate_id").agg(F.sum(v).alias("total"), F.sum(v * v).alias("squares"))
    return sums.join(size, [*keys, "cohort"]).select(*keys, "cohort", "n", "covariate_id", "total", "squares")


def standardised(sums: DataFrame, sizes: DataFrame) -> DataFrame:
    """(covariate_id, mean_1, sd_1, mean_2, sd_2, smd) from covariate_sums of one site or of
    several, and the cohorts' sizes (cohort, n), by site or in all. A person without a covariate
    has the value 0, by the cohort's size only. smd: the difference of means by the root of the
    mean variance, null if both are 0."""
    n = sizes.agg(*[F.sum(F.when(F.col("cohort") == i, F.col("n"))).alias(f"n_{i}") for i in (1, 2)])
    of = lambda c, i: F.coalesce(F.sum(F.when(F.col("cohort") == i, F.col(c))), F.lit(0.0)).alias(f"{c}_{i}")
    g = sums.groupBy("covariate_id").agg(*[of(c, i) for c in ("total", "squares") for i in (1, 2)]).crossJoin(F.broadcast(n))  # one row
    for i in (1, 2):
        size, total = F.col(f"n_{i}"), F.col(f"total_{i}")
        variance = F.greatest(F.lit(0.0), F.try_divide(F.col(f"squares_{i}") - F.try_divide(total * total, size), size - 1))
        g = g.withColumn(f"mean_{i}", F.try_divide(total, size)).withColumn(f"sd_{i}", F.sqrt(variance))
    spread = F.sqrt((F.col("sd_1") * F.col("sd_1") + F.col("sd_2") * F.col("sd_2")) / 2)
    return g.select("covariate_id", "mean_1", "sd_1", "mean_2", "sd_2", F.try_divide(F.col("mean_1") - F.col("mean_2"), spread).alias("smd"))
