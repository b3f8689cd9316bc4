"""Cohorts as sets of episodes, populations as sets of persons."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.dates import age_at
from ..functions.sets import among


def covered(events: DataFrame, periods: DataFrame, date: str) -> DataFrame:
    """Events that exactly one observation period covers, with its bounds."""
    p = periods.select("person_id", F.col("observation_period_start_date").alias("obs_start"), F.col("observation_period_end_date").alias("obs_end"))
    e = events.join(p, "person_id").where(F.col(date).between(F.col("obs_start"), F.col("obs_end")))
    keys = [c for c in events.columns]
    return e.groupBy(*keys).agg(F.count("*").alias("n_obs"), F.min("obs_start").alias("obs_start"), F.max("obs_end").alias("obs_end")).where("n_obs = 1").drop("n_obs")


def index_events(events: DataFrame, periods: DataFrame, date: str, key: str, limit: str = "first", offset: int | None = None) -> DataFrame:
    """Episodes (subject_id, episode_id, cohort_start_date, cohort_end_date, obs_start, obs_end).

    The first, last or all events of a person are taken before anything is filtered. An
    episode ends with the observation period that covers it, or ``offset`` days after its
    start if that is earlier. Events that no period or several cover give none.
    """
    base = events.select("person_id", F.col(date).alias("cohort_start_date"), F.col(key).alias("event_key"))
    if limit != "all":
        order = [F.col("cohort_start_date").asc(), F.col("event_key").asc()] if limit == "first" else [F.col("cohort_start_date").desc(), F.col("event_key").desc()]
        base = base.withColumn("rn", F.row_number().over(W.partitionBy("person_id").orderBy(*order))).where("rn = 1").drop("rn")
    e = covered(base, periods, "cohort_start_date")
    end = F.col("obs_end") if offset is None else F.least("obs_end", F.date_add("cohort_start_date", offset))
    episode = F.row_number().over(W.partitionBy("person_id").orderBy("cohort_start_date", "event_key"))
    return e.select(F.col("person_id").alias("subject_id"), episode.alias("episode_id"), "cohort_start_date", end.alias("cohort_end_date"), "obs_start", "obs_end")


def combine(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Set operation on the persons of two cohorts: union, intersect or setdiff."""
    x, y = a.select("subject_id").distinct(), b.select("subject_id").distinct()
    return {"union": lambda: x.union(y).distinct(), "intersect": lambda: x.intersect(y), "setdiff": lambda: x.subtract(y)}[how]()


def with_count(cohort: DataFrame, events: DataFrame, date: str, window: tuple[int | None, int | None] = (None, None), least: int = 1) -> DataFrame:
    """Episodes with at least ``least`` events in a window of days from their start; least 0: with none."""
    e = events.select(F.col("person_id").alias("subject_id"), F.col(date).alias("event_date"))
    gap = F.datediff("event_date", "cohort_start_date")
    near = F.lit(True)
    if window[0] is not None:
        near = near & (gap >= window[0])
    if window[1] is not None:
        near = near & (gap <= window[1])
    hit = cohort.select("subject_id", "episode_id", "cohort_start_date").join(e, "subject_id").where(near).groupBy("subject_id", "episode_id").agg(F.count("*").alias("n"))
    if not least:
        return cohort.join(hit, ["subject_id", "episode_id"], "left_anti")
    return cohort.join(hit.where(F.col("n") >= least), ["subject_id", "episode_id"], "left_semi")


def eligible(cohort: DataFrame, person: DataFrame, sex: int | None = None, ages: tuple[int, int] | None = None, prior: int | None = None, followup: int | None = None) -> DataFrame:
    """Episodes by sex, age in the index year, and days observed before and after the index."""
    p = person.select(F.col("person_id").alias("subject_id"), "gender_concept_id", "year_of_birth")
    out = cohort.join(p, "subject_id")
    if sex is not None:
        out = out.where(F.col("gender_concept_id") == sex)
    if ages:
        out = out.where(age_at(F.col("cohort_start_date"), F.col("year_of_birth")).between(*ages))
    if prior is not None:
        out = out.where(F.datediff("cohort_start_date", "obs_start") >= prior)
    if followup is not None:
        out = out.where(F.datediff("obs_end", "cohort_start_date") >= followup)
    return out.select(*cohort.columns)


def concept_set(concepts: Sequence[int] | DataFrame, ancestors: DataFrame, descendants: bool = True, exclude: Sequence[int] | DataFrame = ()) -> DataFrame:
    """Concepts and, if wanted, their descendants, without the excluded ones and theirs:
    (concept_id). Either is a list, or a table of any size whose first column counts."""
    spark = ancestors.sparkSession

    def whole(ids: Sequence[int] | DataFrame) -> DataFrame:
        own = ids.select(F.col(ids.columns[0]).alias("concept_id")) if isinstance(ids, DataFrame) else spark.createDataFrame([(int(c),) for c in ids], "concept_id int")
        return own.union(among(ancestors, "ancestor_concept_id", ids).select(F.col("descendant_concept_id").alias("concept_id"))) if descendants else own

    out = whole(concepts)
    if isinstance(exclude, DataFrame) or len(exclude):
        out = out.join(whole(exclude), "concept_id", "left_anti")
    return out.distinct()


def from_table(rows: DataFrame) -> DataFrame:
    """The persons of any result as a cohort."""
    return rows.where("person_id is not null").select(F.col("person_id").alias("subject_id")).distinct()


def scope(cohorts: Sequence[DataFrame], how: str = "union") -> DataFrame:
    """The persons of several cohorts: those in any (union) or in all (intersect)."""
    persons = cohorts[0].select("subject_id").distinct()
    for c in cohorts[1:]:
        persons = combine(persons, c, how)
    return persons


def population(tree: DataFrame | dict) -> DataFrame:
    """The persons of a tree of cohorts: {"any": [...]}, {"all": [...]}, {"first_without": [...]},
    whose items are cohorts (subject_id) or trees."""
    if isinstance(tree, DataFrame):
        return tree.select("subject_id").distinct()
    ((how, parts),) = tree.items()
    word = {"any": "union", "all": "intersect", "first_without": "setdiff"}[how]
    return reduce(lambda a, b: combine(a, b, word), [population(p) for p in parts])


def within(rows: DataFrame, persons: DataFrame) -> DataFrame:
    """Rows of the persons in scope."""
    return rows.join(persons, rows["person_id"] == persons["subject_id"], "left_semi")
