"""Named analyses within a cohort, and tables of results that were computed elsewhere."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.dates import age_at
from ..functions.quantiles import exact, pick
from ..sources.schemas import family

#: Most rows that a result table gives at once; a higher limit of the caller counts as this one.
LIMIT = 5000


def cohort_prevalence(events: DataFrame, concept: str, cohort: DataFrame, least_persons: int = 3, top: int = 50) -> DataFrame:
    """(concept_id, n_persons, prevalence): persons of the cohort with each concept, and their share."""
    people = cohort.select(F.col("subject_id").alias("person_id")).distinct()
    g = events.join(people, "person_id", "left_semi").groupBy(F.col(concept).alias("concept_id")).agg(F.count_distinct("person_id").alias("n_persons")).where(F.col("n_persons") >= least_persons)
    all_of = people.agg(F.count("*").alias("n"))
    return g.orderBy(F.desc("n_persons"), "concept_id").limit(top).crossJoin(F.broadcast(all_of)).select("concept_id", "n_persons", F.try_divide("n_persons", "n").alias("prevalence"))  # one row


def distribution(events: DataFrame, concept: str, value: str, cohort: DataFrame | None = None) -> DataFrame:
    """Count, mean, deviation, median and deciles 1 and 9 of a value by concept."""
    if cohort is not None:
        events = events.join(cohort.select(F.col("subject_id").alias("person_id")), "person_id", "left_semi")
    rows = events.where(F.col(value).isNotNull()).select(F.col(concept).alias("concept_id"), F.col(value).cast("double").alias("v"))
    g = rows.groupBy("concept_id").agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("sd")).withColumnRenamed("concept_id", "c")
    q = exact(rows, "v", (0.1, 0.5, 0.9), ["concept_id"])
    return g.join(q, F.col("c").eqNullSafe(F.col("concept_id"))).select("concept_id", "n", "mean", "sd", pick(0).alias("p10"), pick(1).alias("median"), pick(2).alias("p90"))


def of_episodes(cohort: DataFrame, person: DataFrame, metric: str) -> DataFrame:
    """(person_id, covariate, value) of each episode: its age in years at the start (age), or
    its days from start to end (time_in_cohort)."""
    p = person.select(F.col("person_id").alias("subject_id"), "year_of_birth")
    value = {"age": age_at(F.col("cohort_start_date"), F.col("year_of_birth")), "time_in_cohort": F.datediff("cohort_end_date", "cohort_start_date")}[metric]
    return cohort.join(p, "subject_id").select(F.col("subject_id").alias("person_id"), F.lit(metric).alias("covariate"), value.alias("value"))


def status(known: Sequence[str], tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, present, n_columns, n_rows) of the result tables that are known; a table is
    counted only if it is there."""
    out = None
    for name in sorted(known):
        if name in tables:
            part = tables[name].agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), F.lit(True).alias("present"), F.lit(len(tables[name].columns)).alias("n_columns"), "n_rows")
        else:
            spark = next(iter(tables.values())).sparkSession
            part = spark.range(1).select(F.lit(name).alias("table_name"), F.lit(False).alias("present"), F.lit(None).cast("int").alias("n_columns"), F.lit(None).cast("long").alias("n_rows"))
        out = part if out is None else out.unionByName(part)
    return out


def harmonised(parts: dict[str, DataFrame], factors: Sequence[str] = ()) -> DataFrame:
    """The rows of all sites with a ``site`` column, made to agree: the columns that all sites
    have in one type family, numbers as the wider type; a factor column as the place of its
    value among the values of all sites, in order, from 1."""
    kinds = {c: [next(f.dataType for f in p.schema if f.name == c) for p in parts.values()] for c in next(iter(parts.values())).columns if all(c in p.columns for p in parts.values())}
    common = [c for c, k in kinds.items() if len(set(map(family, k))) == 1]
    wide = lambda c: "double" if family(kinds[c][0]) == "numeric" and len(set(kinds[c])) > 1 and {"float", "double"} & {k.simpleString() for k in kinds[c]} else "long" if family(kinds[c][0]) == "numeric" and len(set(kinds[c])) > 1 else None
    out = reduce(DataFrame.unionByName, [p.select(F.lit(s).alias("site"), *[F.col(c).cast(wide(c)).alias(c) if wide(c) else F.col(c) for c in common]) for s, p in parts.items()])
    for c in factors:
        levels = out.where(F.col(c).isNotNull()).select(F.col(c).alias("_level")).distinct().withColumn("_code", F.row_number().over(W.orderBy("_level")))  # a row per level
        out = out.join(levels, F.col(c) == F.col("_level"), "left").withColumn(c, F.col("_code")).drop("_level", "_code")
    return out


def read_results(table: DataFrame, columns: Sequence[str] | None = None, equal: dict | None = None, order_by: str | None = None, descending: bool = False, limit: int = LIMIT) -> DataFrame:
    """Rows of a result table: equality filters, columns, one sort column with nulls last."""
    out = reduce(lambda df, kv: df.where(F.col(kv[0]) == kv[1]), (equal or {}).items(), table)
    if order_by:
        out = out.orderBy(F.desc_nulls_last(order_by) if descending else F.asc_nulls_last(order_by), *[c for c in table.columns if c != order_by])
    out = out.limit(min(limit, LIMIT))
    return out.select(*columns) if columns else out


def by_site(parts: dict[str, DataFrame]) -> DataFrame:
    """The rows of all sites with a ``site`` column, by the columns that all sites have."""
    common = [c for c in next(iter(parts.values())).columns if all(c in p.columns for p in parts.values())]
    return reduce(DataFrame.unionByName, [p.select(F.lit(s).alias("site"), *common) for s, p in parts.items()])


def union_of_sites(parts: Sequence[DataFrame]) -> DataFrame:
    """Distinct rows of metadata over sites, by the columns that all have."""
    common = [c for c in parts[0].columns if all(c in p.columns for p in parts)]
    return reduce(DataFrame.unionByName, [p.select(*common) for p in parts]).distinct()
