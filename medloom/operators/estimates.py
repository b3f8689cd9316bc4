"""Rates and effect estimates of one site, which pooling takes together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .eras import collapse


def incidence(risk: DataFrame, outcome: DataFrame, date: str, keys: Sequence[str] = (), least_persons: int = 1) -> DataFrame:
    """(keys, persons_at_risk, person_days, outcomes, person_outcomes, proportion, rate).

    risk: episodes with entry_day and exit_day (see survival.censored), and the keys. Days
    count from entry to the first outcome or the exit; outcomes are all in the time at
    risk, person_outcomes the persons that have one. The rate is persons by day.
    """
    e = outcome.select(F.col("person_id").alias("subject_id"), F.col(date).alias("d"))
    day = F.datediff("d", "cohort_start_date")
    found = risk.join(e, "subject_id").where(day.between(F.col("entry_day"), F.col("exit_day"))).groupBy("subject_id", "episode_id").agg(F.count("*").alias("n"), F.min(day).alias("first"))
    all_of = risk.join(found, ["subject_id", "episode_id"], "left")
    person = F.count_distinct(F.when(F.col("n") > 0, F.col("subject_id")))
    g = all_of.groupBy(*keys).agg(F.count_distinct("subject_id").alias("persons_at_risk"), F.sum(F.coalesce("first", "exit_day") - F.col("entry_day")).alias("person_days"), F.coalesce(F.sum("n"), F.lit(0)).alias("outcomes"), person.alias("person_outcomes"))
    g = g.where(F.col("persons_at_risk") >= least_persons)
    return g.withColumn("proportion", F.try_divide("person_outcomes", "persons_at_risk")).withColumn("rate", F.try_divide("person_outcomes", "person_days"))


def _log_ratio(a: str, t: str, b: str, u: str) -> list[Column]:
    """The log of (a / t) / (b / u), and its standard error; null unless all are above 0."""
    ok = (F.col(a) > 0) & (F.col(b) > 0) & (F.col(t) > 0) & (F.col(u) > 0)
    estimate = F.log(F.col(a) * F.col(u) / (F.col(b) * F.col(t)))
    return [F.when(ok, estimate).alias("log_estimate"), F.when(ok, F.sqrt(1 / F.col(a) + 1 / F.col(b))).alias("se")]


def comparative(target: DataFrame, comparator: DataFrame, outcome: DataFrame, date: str, keys: Sequence[str] = ()) -> DataFrame:
    """The log rate ratio of two populations at risk, with its standard error: (keys,
    target_events, target_days, comparator_events, comparator_days, log_estimate, se)."""
    both = None
    for arm, risk in (("target", target), ("comparator", comparator)):
        g = incidence(risk, outcome, date, keys).select(*keys, F.lit(arm).alias("arm"), "person_outcomes", "person_days")
        both = g if both is None else both.unionByName(g)
    of = lambda arm, c: F.coalesce(F.max(F.when(F.col("arm") == arm, F.col(c))), F.lit(0))
    g = both.groupBy(*keys).agg(*[of(arm, c).alias(f"{arm}_{n}") for arm in ("target", "comparator") for c, n in (("person_outcomes", "events"), ("person_days", "days"))])
    return g.select("*", *_log_ratio("target_events", "target_days", "comparator_events", "comparator_days"))


def self_controlled(periods: DataFrame, exposures: DataFrame, start: str, end: str, outcome: DataFrame, date: str, keys: Sequence[str] = ()) -> DataFrame:
    """The log rate ratio of exposed and other days of the same persons, those with an outcome
    while observed and with an exposed day: (keys, exposed_events, exposed_days,
    other_events, other_days, log_estimate, se).

    periods: observation periods with the keys. Exposures that overlap or touch are one.
    """
    s, e = "observation_period_start_date", "observation_period_end_date"
    valid = exposures.where(F.coalesce(end, start) >= F.col(start))
    x = collapse(valid, ["person_id"], start, end).select("person_id", F.col("era_start").alias("a"), F.col("era_end").alias("b"))
    p = periods.select("person_id", *keys, F.col(s).alias("s"), F.col(e).alias("e")).withColumn("days", F.datediff("e", "s") + 1)
    inside = F.datediff(F.least("b", "e"), F.greatest("a", "s")) + 1
    exposed = p.join(x, "person_id").where("a <= e and b >= s").groupBy("person_id", "s").agg(F.sum(inside).alias("on"))
    o = outcome.select("person_id", F.col(date).alias("d"))
    seen = p.join(o, "person_id").where("d between s and e").select("person_id", "s", "d")
    hit = seen.join(x, (seen["person_id"] == x["person_id"]) & seen["d"].between(x["a"], x["b"]), "left").select(seen["person_id"], "s", x["a"].isNotNull().cast("int").alias("exposed"))
    events = hit.groupBy("person_id", "s").agg(F.sum("exposed").alias("on_events"), F.count("*").alias("events"))
    cases = p.join(exposed, ["person_id", "s"], "left").join(events, ["person_id", "s"], "left").groupBy("person_id", *keys)
    cases = cases.agg(F.sum("days").alias("days"), F.sum("on").alias("on"), F.sum("on_events").alias("on_events"), F.sum("events").alias("events")).where("events > 0 and on > 0")
    g = cases.groupBy(*keys).agg(F.sum("on_events").alias("exposed_events"), F.sum("on").alias("exposed_days"), (F.sum("events") - F.sum("on_events")).alias("other_events"), (F.sum("days") - F.sum("on")).alias("other_days"))
    return g.select("*", *_log_ratio("exposed_events", "exposed_days", "other_events", "other_days"))


def persons_by(person: DataFrame, column: str, least_persons: int = 1) -> DataFrame:
    """(value, n_persons): persons by a column of theirs, such as sex."""
    return person.groupBy(F.col(column).alias("value")).agg(F.count_distinct("person_id").alias("n_persons")).where(F.col("n_persons") >= least_persons)
