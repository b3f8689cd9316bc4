"""Operators on dates: windows around an index, selection, chains, bins and intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def around(cohort: DataFrame, events: DataFrame, date: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Events of each episode within days of its start, with ``day`` relative to it."""
    e = events.withColumnRenamed("person_id", "subject_id")
    out = cohort.select("subject_id", "episode_id", "cohort_start_date").join(e, "subject_id").withColumn("day", F.datediff(date, "cohort_start_date"))
    if start is not None:
        out = out.where(F.col("day") >= start)
    if end is not None:
        out = out.where(F.col("day") <= end)
    return out.drop("cohort_start_date")


def calendar(events: DataFrame, date: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Events between two calendar dates, both included; either may be open."""
    if start is None and end is None:
        raise ValueError("a calendar window needs a start or an end")
    if start is not None and end is not None and start > end:
        raise ValueError("a calendar window starts after its end")
    if start is not None:
        events = events.where(F.col(date) >= F.lit(start).cast("date"))
    return events if end is None else events.where(F.col(date) <= F.lit(end).cast("date"))


def select(events: DataFrame, by: Sequence[str], date: str, key: str, order: str = "first", n: int = 1, anchor: str | None = None) -> DataFrame:
    """First, last or nearest (to the column ``anchor``, in days) n events of each group; ties by key."""
    sort = {"first": [F.asc(date), F.asc(key)], "last": [F.desc(date), F.desc(key)], "nearest": [F.abs(F.datediff(date, anchor)).asc() if anchor else F.abs(date).asc(), F.asc(key)]}[order]
    return events.withColumn("_rn", F.row_number().over(W.partitionBy(*by).orderBy(*sort))).where(F.col("_rn") <= n).drop("_rn")


def min_gap(events: DataFrame, by: Sequence[str], date: str, key: str, days: int, keep: str = "first") -> DataFrame:
    """One event of each chain of events that follow each other within ``days`` days."""
    w = W.partitionBy(*by).orderBy(date, key)
    new = F.when(F.datediff(date, F.lag(date).over(w)) <= days, 0).otherwise(1)
    chained = events.withColumn("_new", new).withColumn("_chain", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return select(chained, [*by, "_chain"], date, key, keep).drop("_new", "_chain")


def bins(start: int, end: int, width: int) -> list[tuple[int, int, int]]:
    """(time_id, first day, last day); the last bin is clipped."""
    return [(i, start + i * width, min(end, start + (i + 1) * width - 1)) for i in range((end - start) // width + 1)]


def temporal_covariates(cohort: DataFrame, events: DataFrame, date: str, concept: str, start: int, end: int, width: int) -> DataFrame:
    """Counts by episode, bin of days and concept; absent cells are zero and not listed."""
    near = around(cohort, events, date, start, end)
    return near.groupBy("subject_id", "episode_id", F.floor((F.col("day") - start) / width).cast("int").alias("time_id"), F.col(concept).alias("covariate_id")).agg(F.count("*").alias("covariate_value"))


def person_periods(cohort: DataFrame, start: int, end: int, width: int) -> DataFrame:
    """Every episode by every bin that its observation overlaps, with the days observed."""
    one = F.explode(F.array(*[F.struct(F.lit(i).alias("time_id"), F.lit(a).alias("start_day"), F.lit(b).alias("end_day")) for i, a, b in bins(start, end, width)]))
    out = cohort.withColumn("x", one).select("subject_id", "episode_id", "x.*", F.datediff("obs_start", "cohort_start_date").alias("lo"), F.datediff("obs_end", "cohort_start_date").alias("hi"))
    out = out.withColumn("obs_start_day", F.greatest("start_day", "lo")).withColumn("obs_end_day", F.least("end_day", "hi")).where("obs_start_day <= obs_end_day")
    return out.select("subject_id", "episode_id", "time_id", "start_day", "end_day", "obs_start_day", "obs_end_day", (F.col("obs_end_day") - F.col("obs_start_day") + 1).alias("days_observed"))


def intervals(cohort: DataFrame, rows: DataFrame, start: str, end: str, concept: str, match: str = "overlaps", window: tuple[int, int] | None = None, at: int = 0) -> DataFrame:
    """Intervals of an episode's person that overlap, start in, end in the window (the
    episode itself if none), or are active at a day; a missing end is the start."""
    r = rows.select(F.col("person_id").alias("subject_id"), F.col(concept).alias("concept_id"), F.col(start).alias("s"), F.coalesce(end, start).alias("e"))
    j = cohort.select("subject_id", "episode_id", "cohort_start_date", "cohort_end_date").join(r, "subject_id")
    a, b = F.datediff("s", "cohort_start_date"), F.datediff("e", "cohort_start_date")
    lo, hi = (F.lit(window[0]), F.lit(window[1])) if window else (F.lit(0), F.datediff("cohort_end_date", "cohort_start_date"))
    test = {"overlaps": (a <= hi) & (b >= lo), "starts_in": a.between(lo, hi), "ends_in": b.between(lo, hi), "active_at": (a <= at) & (b >= at)}[match]
    return j.where(test).select("subject_id", "episode_id", "concept_id", a.alias("start_days_from_index"), b.alias("end_days_from_index"))


def wide(events: DataFrame, by: Sequence[str], concept: str, concepts: Sequence[int], value: str) -> DataFrame:
    """A column of values for each of a closed list of concepts, as conditional aggregates. Two
    rows of a group and concept are an error; reduce or select them before."""
    one = lambda c: F.when(F.count_if(F.col(concept) == c) > 1, F.raise_error(F.lit(f"several rows of concept {c} in a group")).cast(events.schema[value].dataType)).otherwise(F.max(F.when(F.col(concept) == c, F.col(value))))
    return events.where(F.col(concept).isin(*concepts)).groupBy(*by).agg(*[one(c).alias(f"c_{c}") for c in concepts])


def sparse(events: DataFrame, by: Sequence[str], concept: str) -> DataFrame:
    return events.groupBy(*by, F.col(concept).alias("covariate_id")).agg(F.count("*").alias("covariate_value"))


def select_intervals(found: DataFrame, order: str = "first", n: int = 1, anchor: int = 0, by_concept: bool = False) -> DataFrame:
    """First, last or nearest (to day ``anchor``) n intervals of an episode, or of each
    concept in it; ties by end, then concept."""
    key = F.col("start_days_from_index")
    first = {"first": key.asc(), "last": key.desc(), "nearest": F.abs(key - anchor).asc()}[order]
    w = W.partitionBy("subject_id", "episode_id", *(["concept_id"] if by_concept else [])).orderBy(first, "end_days_from_index", "concept_id", "start_days_from_index")
    return found.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
