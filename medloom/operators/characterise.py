"""A cohort described: rates by calendar year, age and sex, events around exposure, visits and concepts at the index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .eras import collapse


def _dates(events: DataFrame, date: str, *keys: str) -> DataFrame:
    """(subject_id, keys, d): the different dates of each person's events."""
    return events.where(F.col(date).isNotNull()).select(F.col("person_id").alias("subject_id"), *keys, F.col(date).alias("d")).distinct()


def by_year(spans: DataFrame, start: str, end: str) -> DataFrame:
    """(subject_id, year, a, b): spans of a person, those that overlap or touch as one, cut at
    each turn of the year; both ends included. One that ends before it starts gives nothing."""
    whole = collapse(spans.where(F.col(end) >= F.col(start)), ["subject_id"], start, end)
    each = whole.select("subject_id", "era_start", "era_end", F.explode(F.sequence(F.year("era_start"), F.year("era_end"))).alias("year"))
    of = lambda month, day: F.make_date("year", F.lit(month), F.lit(day))
    return each.select("subject_id", "year", F.greatest("era_start", of(1, 1)).alias("a"), F.least("era_end", of(12, 31)).alias("b"))


def person_time(risk: DataFrame, outcome: DataFrame, date: str, clean: int = 0) -> DataFrame:
    """(subject_id, year, person_days, outcomes) of each person and calendar year with a day at
    risk.

    risk: (subject_id, cohort_start_date, cohort_end_date); a day that several episodes
    cover counts once. An outcome counts unless the person had one within the ``clean``
    days before it, at risk or not, and these days after an outcome are no days at risk.
    Several outcomes on a day are one. Days are never listed: what an outcome takes away is
    the overlap of two spans, and all three sums meet in one aggregate by person and year.
    """
    o = _dates(outcome, date)
    pieces = by_year(risk, "cohort_start_date", "cohort_end_date")
    none = F.lit(0).cast("long")
    days = lambda a, b: (F.datediff(b, a) + 1).cast("long")
    parts = pieces.select("subject_id", "year", days("a", "b").alias("person_days"), none.alias("outcomes"))
    if clean > 0:
        gone = collapse(o.select("subject_id", F.date_add("d", 1).alias("x"), F.date_add("d", clean).alias("y")), ["subject_id"], "x", "y")
        lost = pieces.join(gone, "subject_id").where("era_start <= b and era_end >= a")
        parts = parts.unionByName(lost.select("subject_id", "year", (-days(F.greatest("a", "era_start"), F.least("b", "era_end"))).alias("person_days"), none.alias("outcomes")))
    since = F.datediff("d", F.lag("d").over(W.partitionBy("subject_id").orderBy("d")))
    cases = o.withColumn("since", since).where(F.coalesce(F.col("since") > clean, F.lit(True)))
    met = pieces.join(cases, "subject_id").where("d between a and b")
    parts = parts.unionByName(met.select("subject_id", "year", none.alias("person_days"), F.lit(1).cast("long").alias("outcomes")))
    g = parts.groupBy("subject_id", "year").agg(F.sum("person_days").alias("person_days"), F.sum("outcomes").alias("outcomes"))
    return g.where("person_days > 0")


def incidence_strata(risk: DataFrame, outcome: DataFrame, date: str, person: DataFrame, clean: int = 0, band: int = 10, least_persons: int = 1) -> DataFrame:
    """(strata, gender_concept_id, age_from, year, persons_at_risk, person_days, outcomes,
    person_outcomes, rate) for each sex, age band and calendar year, and for all unions of
    these.

    strata has a bit for each of the three that is summed over (4 sex, 2 age, 1 year), so
    that a null sex isn't taken for all. Age is that of the calendar year, year less year
    of birth, in bands of ``band`` years. rate: outcomes in 1,000 years of 365.25 days.
    See person_time.
    """
    who = person.select(F.col("person_id").alias("subject_id"), "gender_concept_id", "year_of_birth").dropDuplicates(["subject_id"])
    t = person_time(risk, outcome, date, clean).join(who, "subject_id")
    t = t.withColumn("age_from", (F.floor((F.col("year") - F.col("year_of_birth")) / band) * band).cast("int"))
    persons = F.count_distinct("subject_id")
    hit = F.count_distinct(F.when(F.col("outcomes") > 0, F.col("subject_id")))
    g = t.cube("gender_concept_id", "age_from", "year").agg(F.grouping_id().cast("int").alias("strata"), persons.alias("persons_at_risk"), F.sum("person_days").alias("person_days"), F.sum("outcomes").alias("outcomes"), hit.alias("person_outcomes"))
    g = g.where(F.col("persons_at_risk") >= least_persons)
    return g.withColumn("rate", F.col("outcomes") * 365_250.0 / F.col("person_days"))


def time_to_event(exposures: DataFrame, outcomes: DataFrame, date: str, key: str, scales: Sequence[int] = (1, 30, 365)) -> DataFrame:
    """(outcome_id, is_first, position, scale, bucket, n_events): when outcomes fall beside a
    person's exposure.

    exposures: eras (subject_id, era_start, era_end), apart from each other (see
    eras.collapse). position: before, during first, during later, between, or after all of
    the person's eras; the last day of an era belongs to it. bucket: whole scales of days
    from the start of the first era, below 0 before it. is_first: the first outcome of that
    id of the person; an id counts once a day. Persons without an era don't count.

    Eras and outcomes of a person are put in one order, in which each outcome finds the last
    era begun; none is joined with another.
    """
    e = exposures.select("subject_id", F.col("era_start").alias("d"), F.lit(None).cast(outcomes.schema[key].dataType).alias("outcome_id"), F.lit(0).alias("kind"), "era_end")
    o = _dates(outcomes.withColumnRenamed(key, "outcome_id"), date, "outcome_id")
    first = F.row_number().over(W.partitionBy("subject_id", "outcome_id").orderBy("d")) == 1
    o = o.select("subject_id", "d", "outcome_id", F.lit(1).alias("kind"), F.lit(None).cast("date").alias("era_end"), first.cast("int").alias("is_first"))
    both = e.withColumn("is_first", F.lit(None).cast("int")).unionByName(o)
    own = W.partitionBy("subject_id")
    upto = own.orderBy("d", "kind").rowsBetween(W.unboundedPreceding, 0)
    is_era = F.col("kind") == 0
    t = both.withColumn("begun", F.count_if(is_era).over(upto)).withColumn("all_of", F.count_if(is_era).over(own))
    t = t.withColumn("last_end", F.max("era_end").over(upto)).withColumn("zero", F.min(F.when(is_era, F.col("d"))).over(own)).where("kind = 1 and all_of > 0")
    inside = F.col("d") <= F.col("last_end")
    position = F.when(F.col("begun") == 0, "before").when(inside & (F.col("begun") == 1), "during first").when(inside, "during later").when(F.col("begun") == F.col("all_of"), "after").otherwise("between")
    t = t.select("outcome_id", "is_first", position.alias("position"), F.datediff("d", "zero").alias("days"))
    daily = t.groupBy("outcome_id", "is_first", "position", "days").agg(F.count("*").alias("n"))  # so that only counts are told apart by scale
    scaled = daily.select("*", F.explode(F.array(*map(F.lit, scales))).alias("scale"))
    return scaled.groupBy("outcome_id", "is_first", "position", "scale", F.floor(F.col("days") / F.col("scale")).cast("int").alias("bucket")).agg(F.sum("n").alias("n_events"))


def visit_context(cohort: DataFrame, visits: DataFrame, days: int = 30) -> DataFrame:
    """(visit_concept_id, context, n_persons, n_episodes): the visits around an episode's start.

    context: ``before``, ended 1 to ``days`` days earlier; ``during``, begun earlier and not
    ended; ``on``, begun that day; ``after``, begun 1 to ``days`` days later. A visit without
    an end, or with one before its start, ends on the day it starts.
    """
    start = F.col("visit_start_date")
    v = visits.select(F.col("person_id").alias("subject_id"), "visit_concept_id", start.alias("a"), F.greatest(start, F.coalesce("visit_end_date", start)).alias("b"))
    from_, to = F.datediff("a", "cohort_start_date"), F.datediff("b", "cohort_start_date")
    context = F.when(from_ == 0, "on").when((from_ < 0) & (to >= 0), "during").when(to.between(-days, -1), "before").when(from_.between(1, days), "after")
    j = cohort.select("subject_id", "episode_id", "cohort_start_date").join(v, "subject_id").select("subject_id", "episode_id", "visit_concept_id", context.alias("context")).where("context is not null")
    return j.groupBy("visit_concept_id", "context").agg(F.count_distinct("subject_id").alias("n_persons"), F.count_distinct("subject_id", "episode_id").alias("n_episodes"))


def index_breakdown(cohort: DataFrame, sources: dict[str, tuple[DataFrame, str, str]], days: int = 0) -> DataFrame:
    """(source, concept_id, n_persons, n_episodes, n_events): what is recorded at an episode's
    start, or up to ``days`` days from it. sources: {name: (events, date, concept)}."""
    every = None
    for name, (events, date, concept) in sources.items():
        e = events.select(F.col("person_id").alias("subject_id"), F.lit(name).alias("source"), F.col(concept).cast("long").alias("concept_id"), F.col(date).alias("d"))
        every = e if every is None else every.unionByName(e)
    c = cohort.select("subject_id", "episode_id", "cohort_start_date")
    if days:
        j = c.join(every, "subject_id").where(F.abs(F.datediff("d", "cohort_start_date")) <= days)
    else:  # the date is a key of the join, so a person's other events never meet the episode
        j = c.join(every.withColumnRenamed("d", "cohort_start_date"), ["subject_id", "cohort_start_date"])
    return j.groupBy("source", "concept_id").agg(F.count_distinct("subject_id").alias("n_persons"), F.count_distinct("subject_id", "episode_id").alias("n_episodes"), F.count("*").alias("n_events"))
