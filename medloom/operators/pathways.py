"""Treatment pathways: the order in which a person's treatments follow and join each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def _begun_last(active: Column) -> Column:
    """Of eras, that which began last; ties: the smaller name."""
    return F.array_min(F.transform(active, lambda x: F.struct((-x["a"]).alias("a"), x["name"].alias("name"), x["b"].alias("b"))))


def steps(cohort: DataFrame, eras: DataFrame, name: str, days: int, overlap: int = 30, gap: int = 0, least: int = 1) -> DataFrame:
    """(subject_id, episode_id, step, treatment, start_day, end_day) of each episode.

    eras: (subject_id, name, era_start, era_end), one treatment's eras apart from each other
    (see eras.collapse). Those that begin from the episode's start to ``days`` days later
    and last ``least`` days count, up to that last day. On each day the treatment is that
    which began last (ties: the smaller name) together with those that are active too and
    overlap it for at least ``overlap`` days; names of several stand in order, joined by +.
    Days in a row with the same treatment are a step, also over at most ``gap`` days with
    none. Episodes without treatment give no row.

    The eras of an episode are folded in the JVM, between the days on which one begins or
    ends; there are at most days * treatments of them, whatever the rows behind.
    """
    c = cohort.select("subject_id", "episode_id", "cohort_start_date")
    day = lambda d: F.datediff(d, "cohort_start_date")
    e = eras.select("subject_id", F.col(name).cast("string").alias("name"), "era_start", "era_end")
    j = c.join(e, "subject_id").select("subject_id", "episode_id", "name", day("era_start").alias("a"), F.least(day("era_end"), F.lit(days)).alias("b"))
    j = j.where(F.col("a").between(0, days) & (F.col("b") - F.col("a") + 1 >= least) & F.col("name").isNotNull())
    all_of = j.groupBy("subject_id", "episode_id").agg(F.collect_list(F.struct("a", "b", "name")).alias("eras"))
    cuts = F.array_sort(F.array_distinct(F.concat(F.transform("eras", lambda x: x["a"]), F.transform("eras", lambda x: x["b"] + 1))))
    all_of = all_of.withColumn("cuts", cuts)

    def piece(s: Column, i: Column) -> Column:
        end = F.get("cuts", i + 1) - 1
        active = F.filter("eras", lambda x: (x["a"] <= s) & (x["b"] >= end))
        z = _begun_last(active)
        joined = F.filter(active, lambda x: (x["name"] == z["name"]) | (F.least(x["b"], z["b"]) + z["a"] + 1 >= overlap))  # z.a is negated
        return F.struct(s.alias("a"), end.alias("b"), F.when(F.size(active) > 0, F.array_join(F.array_sort(F.array_distinct(F.transform(joined, lambda x: x["name"]))), "+")).alias("name"))

    pieces = F.filter(F.transform(F.slice("cuts", 1, F.size("cuts") - 1), piece), lambda x: x["name"].isNotNull())
    kind = "array<struct<a:int,b:int,name:string>>"

    def grow(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        more = F.struct(last["a"].alias("a"), x["b"].alias("b"), x["name"].alias("name"))
        same = (F.size(done) > 0) & (last["name"] == x["name"]) & (x["a"] - last["b"] - 1 <= gap)
        return F.when(F.coalesce(same, F.lit(False)), F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(more))).otherwise(F.concat(done, F.array(x))).cast(kind)

    merged = F.aggregate(pieces, F.array().cast(kind), grow)
    out = all_of.select("subject_id", "episode_id", F.posexplode(merged).alias("i", "x"))
    return out.select("subject_id", "episode_id", (F.col("i") + 1).alias("step"), F.col("x.name").alias("treatment"), F.col("x.a").alias("start_day"), F.col("x.b").alias("end_day"))


def paths(found: DataFrame, most: int = 5) -> DataFrame:
    """(subject_id, episode_id, step, path): at each of the first ``most`` steps the treatments
    so far, joined by >."""
    w = W.partitionBy("subject_id", "episode_id").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    return found.where(F.col("step") <= most).withColumn("path", F.array_join(F.collect_list("treatment").over(w), ">")).select("subject_id", "episode_id", "step", "path")


def counts(found: DataFrame, most: int = 5, least_persons: int = 1) -> DataFrame:
    """(path, step, n_persons, n_end): persons whose treatments begin with the path, and those
    of them with no further step, or none within ``most``. Paths of fewer persons than
    least_persons are left out."""
    p = paths(found, most)
    last = F.col("step") == F.max("step").over(W.partitionBy("subject_id", "episode_id"))
    g = p.withColumn("last", last).groupBy("path", "step").agg(F.count_distinct("subject_id").alias("n_persons"), F.count_distinct(F.when(F.col("last"), F.col("subject_id"))).alias("n_end"))
    return g.where(F.col("n_persons") >= least_persons)


def durations(found: DataFrame) -> DataFrame:
    """(treatment, n_steps, n_persons, mean_days, least_days, most_days) over all steps."""
    days = F.col("end_day") - F.col("start_day") + 1
    return found.groupBy("treatment").agg(F.count("*").alias("n_steps"), F.count_distinct("subject_id").alias("n_persons"), F.avg(days).alias("mean_days"), F.min(days).alias("least_days"), F.max(days).alias("most_days"))
