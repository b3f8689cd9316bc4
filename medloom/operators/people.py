"""Variables of persons, scores from code sets, and filters on persons."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..cdm.spec import FEMALE, MALE
from ..functions.dates import age_at, age_band
from ..functions.sets import among

_S, _E = "observation_period_start_date", "observation_period_end_date"
DEMOGRAPHIC = ("gender_concept_id", "year_of_birth", "month_of_birth", "day_of_birth", "race_concept_id", "ethnicity_concept_id")


def sex() -> Column:
    return F.when(F.col("gender_concept_id") == MALE, "M").when(F.col("gender_concept_id") == FEMALE, "F")


def demographic_missingness(columns: Sequence[str] = DEMOGRAPHIC) -> Column:
    """How many of the columns are null or 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c) == 0, F.lit(True)).cast("int") for c in columns])


def observed_days(periods: DataFrame, policy: str = "total") -> DataFrame:
    """(person_id, obs_duration): days from start to end of all periods, or of the first,
    last or longest one."""
    days = F.datediff(_E, _S)
    how = {"total": F.sum(days), "first": F.min_by(days, F.struct(_S, _E)), "last": F.max_by(days, F.struct(_S, _E)), "longest": F.max(days)}[policy]
    return periods.groupBy("person_id").agg(how.cast("long").alias("obs_duration"))


def around_reference(persons: DataFrame, periods: DataFrame, reference: Column) -> DataFrame:
    """(person_id, prior_obs, followup): days from the start and to the end of the one
    period that covers the reference; null for persons with none or several."""
    p = periods.where(reference.between(F.col(_S), F.col(_E)))
    one = p.groupBy("person_id").agg(F.count("*").alias("n"), F.min(F.datediff(reference, _S)).alias("prior_obs"), F.min(F.datediff(_E, reference)).alias("followup")).where("n = 1").drop("n")
    return persons.select("person_id").join(one, "person_id", "left")


def codes(codeset: DataFrame, ancestor: DataFrame | None = None, relationship: DataFrame | None = None) -> DataFrame:
    """A code set (category, concept_id, weight) widened by descendants, and by the
    concepts its source codes map to."""
    out = codeset.select("category", "concept_id", "weight")
    if relationship is not None:
        maps = relationship.where(F.col("relationship_id") == "Maps to").select(F.col("concept_id_1").alias("concept_id"), F.col("concept_id_2").alias("to"))
        out = out.unionByName(out.join(maps, "concept_id").select("category", F.col("to").alias("concept_id"), "weight"))
    if ancestor is not None:
        below = ancestor.select(F.col("ancestor_concept_id").alias("concept_id"), F.col("descendant_concept_id").alias("to"))
        out = out.unionByName(out.join(below, "concept_id").select("category", F.col("to").alias("concept_id"), "weight"))
    return out.groupBy("category", "concept_id").agg(F.max("weight").alias("weight"))


def score(persons: DataFrame, events: DataFrame, concept: str, codeset: DataFrame, extra: Column | None = None, supersedes: Sequence[tuple] = ()) -> DataFrame:
    """(person_id, score): the largest weight (or tier) of each category a person has, summed,
    and ``extra``, an expression on the columns of ``persons``, such as points for age and
    sex. supersedes: pairs of a severe and a mild category; where a person has the severe
    one, the mild one doesn't count, even if a third supersedes the severe one.

    One operator serves all weighted indices (comorbidity, stroke, complication tiers,
    frailty): they differ in code set and extra points, both given by the caller.
    """
    hit = events.select("person_id", F.col(concept).alias("concept_id")).join(codeset, "concept_id").groupBy("person_id", "category").agg(F.max("weight").alias("weight"))
    own = lambda m: F.max(F.when(F.col("category") == m, F.col("weight")))
    has = lambda m: F.bool_or(F.col("category").isin([s for s, mild in supersedes if mild == m]))
    less = [F.when(has(m), F.coalesce(own(m), F.lit(0))).otherwise(0) for m in dict.fromkeys(m for _, m in supersedes)]
    sums = hit.groupBy("person_id").agg(reduce(lambda a, b: a - b, less, F.sum("weight")).alias("points"))
    points = F.coalesce(F.col("points"), F.lit(0))
    return persons.join(sums, "person_id", "left").select("person_id", (points + extra if extra is not None else points).alias("score"))


def age_groups(labels: Sequence[str], age: Column) -> Column:
    """Whether an age is in one of the groups "a-b" or "n+"."""
    one = lambda g: age >= int(g[:-1]) if g.endswith("+") else age.between(*map(int, g.split("-")))
    return reduce(lambda a, b: a | b, [one(g) for g in labels])


def members(persons: DataFrame, cohort: DataFrame, cohort_definition_id: int) -> DataFrame:
    own = cohort.where(F.col("cohort_definition_id") == cohort_definition_id).select(F.col("subject_id").alias("person_id"))
    return persons.join(own, "person_id", "left_semi")


def at_least(persons: DataFrame, events: DataFrame, n: int = 1) -> DataFrame:
    """Persons with at least n of the events; n = 0: with none."""
    if not n:
        return persons.join(events.select("person_id"), "person_id", "left_anti")
    return persons.join(events.groupBy("person_id").count().where(F.col("count") >= n), "person_id", "left_semi")


def snap(edges: Sequence[float], threshold: float, direction: str = "above") -> tuple[float, float]:
    """The value range [low, high) from a threshold, moved to the public edge at or below
    it: from there to the last edge, or from the first edge to there."""
    if len(edges) < 2:
        raise ValueError("no common edges")
    i = max(0, min(len(edges) - 2, sum(e <= threshold for e in edges) - 1))
    return (edges[i], edges[-1]) if direction == "above" else (edges[0], edges[max(1, i)])


def snap_outwards(edges: Sequence[float], low: float, high: float) -> tuple[float, float]:
    """The narrowest range of public edges that holds [low, high]."""
    if len(edges) < 2:
        raise ValueError("no common edges")
    return max([e for e in edges if e <= low], default=edges[0]), min([e for e in edges if e >= high], default=edges[-1])


def by_episodes(cohort: DataFrame, passed: DataFrame, policy: str = "any") -> DataFrame:
    """Persons by which of their episodes pass a filter: any, all, the first or the last.

    cohort: all episodes; passed: those that pass (subject_id, episode_id)."""
    marked = cohort.select("subject_id", "episode_id").join(passed.select("subject_id", "episode_id", F.lit(True).alias("ok")), ["subject_id", "episode_id"], "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    how = {"any": F.bool_or("ok"), "all": F.bool_and("ok"), "first": F.min_by("ok", "episode_id"), "last": F.max_by("ok", "episode_id")}[policy]
    return marked.groupBy("subject_id").agg(how.alias("ok")).where("ok").select("subject_id")


def stored(cohort: DataFrame, definition: DataFrame, least_persons: int = 3) -> DataFrame:
    """Stored cohorts with their number of persons; those of too few are left out."""
    n = cohort.groupBy("cohort_definition_id").agg(F.count_distinct("subject_id").alias("n_persons")).where(F.col("n_persons") >= least_persons)
    return n.join(definition, "cohort_definition_id", "left")


def create(events: DataFrame, concept: str, concepts: Sequence[int] | DataFrame, start: str, end: str, criteria: Sequence[DataFrame] = ()) -> DataFrame:
    """A cohort from events of some concepts: distinct (subject_id, cohort_start_date,
    cohort_end_date, cohort_row_id) of the persons that are in every criterion's rows."""
    out = among(events, concept, concepts).select(F.col("person_id").alias("subject_id"), F.col(start).alias("cohort_start_date"), F.coalesce(end, start).alias("cohort_end_date")).distinct()
    for c in criteria:
        out = out.join(c.select(F.col("person_id").alias("subject_id")), "subject_id", "left_semi")
    return out.withColumn("cohort_row_id", F.row_number().over(W.partitionBy("subject_id").orderBy("cohort_start_date", "cohort_end_date")))


def dated(rows: DataFrame, dates: Sequence[str], mode: str = "remove", reference: str | None = None, width: str = "month") -> DataFrame:
    """Date columns removed, as days from a reference column, cut to a week, month or year, or left."""
    if mode == "absolute":
        return rows
    if mode == "remove":
        return rows.drop(*dates)
    each = {"relative": lambda c: F.datediff(c, reference), "binned": lambda c: F.to_date(F.date_trunc(width, F.col(c)))}[mode]
    return rows.withColumns({c: each(c) for c in dates})


def value_in(rows: DataFrame, value: str, low: float | None = None, high: float | None = None, date: str | None = None, dates: tuple[str, str] | None = None, concept: str | None = None, concepts: Sequence[int] | DataFrame | None = None) -> DataFrame:
    """Rows with a value in [low, high), a date between two, both included, and a concept of a set."""
    if low is not None:
        rows = rows.where(F.col(value) >= low)
    if high is not None:
        rows = rows.where(F.col(value) < high)
    if dates:
        rows = rows.where(F.col(date).between(*dates))
    return rows if concepts is None else among(rows, concept, concepts)


def of_visits(rows: DataFrame, visits: DataFrame) -> DataFrame:
    """Rows recorded in one of the visits."""
    return rows.join(visits.select("visit_occurrence_id").distinct(), "visit_occurrence_id", "left_semi")


def definition(definitions: DataFrame, cohort_definition_id: int) -> DataFrame:
    return definitions.where(F.col("cohort_definition_id") == cohort_definition_id)


def baseline(cohort: DataFrame, person: DataFrame, width: int = 10) -> DataFrame:
    """Each episode with the age group of its start, and the days observed before and after."""
    p = person.select(F.col("person_id").alias("subject_id"), "year_of_birth")
    group = age_band(age_at(F.col("cohort_start_date"), F.col("year_of_birth")), width)
    return cohort.join(p, "subject_id").select("subject_id", "episode_id", "cohort_start_date", group.alias("age_group"), F.datediff("cohort_start_date", "obs_start").alias("prior_observation"), F.datediff("obs_end", "cohort_start_date").alias("future_observation"))


def person_level(person: DataFrame, parts: Sequence[DataFrame], counts: Sequence[str] = ()) -> DataFrame:
    """A row per person with the columns of the parts, each of a row per person at most; the
    count columns are 0 where a person has no row."""
    out = reduce(lambda a, b: a.join(b, "person_id", "left"), parts, person)
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts}) if counts else out


def without_sensitive(rows: DataFrame, sensitive: Sequence[str]) -> DataFrame:
    """The columns that no pattern of ``sensitive`` matches; * stands for any characters."""
    wrong = [re.compile(".*".join(map(re.escape, p.split("*"))), re.I) for p in sensitive]
    return rows.select(*[c for c in rows.columns if not any(w.fullmatch(c) for w in wrong)])
