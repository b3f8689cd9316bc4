"""What sites with different limits agree on, and results brought to it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .pooling import SITE, counts


def agreed(policies: DataFrame, sites: int, site: str = SITE) -> DataFrame:
    """(setting, value) of policies (site, setting, value): the strictest of the sites' limits,
    that is the lowest of those named most_ and the highest of those named least_; of any
    other setting the value that all share. Null where a site has none, or they differ."""
    name = F.col("setting")
    strict = F.when(name.startswith("most_"), F.min("value")).when(name.startswith("least_"), F.max("value")).when(F.count_distinct("value") == 1, F.min("value"))
    whole = F.count_distinct(F.when(F.col("value").isNotNull(), F.col(site))) == sites
    return policies.groupBy("setting").agg(F.when(whole, strict).alias("value"))


def common_grid(grids: DataFrame, sites: int, site: str = SITE) -> DataFrame:
    """(age_from, age_to) of the bands whose edges are in every site's grid (site, age_from),
    the last without an end: the finest that each site's own bands fit in. It is an error
    if they don't all begin at 0."""
    edges = grids.groupBy("age_from").agg(F.count_distinct(site).alias("n")).where(F.col("n") == sites)
    w = W.orderBy("age_from")  # a row for each year of age at most
    begins = F.min("age_from").over(W.partitionBy(F.lit(1))) == 0
    out = edges.withColumn("age_to", F.lead("age_from").over(w)).withColumn("ok", begins)
    wrong = F.raise_error(F.lit("the sites' grids don't all begin at 0")).cast("int")
    return out.select(F.when(F.col("ok"), F.col("age_from")).otherwise(wrong).alias("age_from"), "age_to")


def site_counts(persons: DataFrame, age: str, grids: DataFrame, bands: DataFrame, site: str = SITE) -> DataFrame:
    """(site, age_from, n): what each site gives: persons by its own age bands, counts rounded
    down to its own band (site, band)."""
    w = W.partitionBy(site).orderBy("age_from")
    g = grids.select(site, "age_from").distinct().withColumn("age_to", F.lead("age_from").over(w))
    in_band = (F.col(age) >= F.col("age_from")) & (F.col("age_to").isNull() | (F.col(age) < F.col("age_to")))
    n = persons.join(F.broadcast(g), site).where(in_band).groupBy(site, "age_from").agg(F.count("*").alias("n"))  # a row for each year of age and site at most
    return n.join(F.broadcast(bands), site).select(site, "age_from", (F.floor(F.col("n") / F.col("band")) * F.col("band")).cast("long").alias("n"))


def pooled_ages(given: DataFrame, grids: DataFrame, bands: DataFrame, sites: int, site: str = SITE) -> DataFrame:
    """(age_from, age_to, n): the sites' counts on their common grid, into whose bands their own
    fall whole. n is null where a site gives none, and everywhere if the sites' counts are
    rounded to different bands, as such sums would mix them."""
    grid = common_grid(grids, sites, site)
    own = given.withColumnRenamed("age_from", "own")
    mapped = own.join(F.broadcast(grid), (F.col("own") >= F.col("age_from")) & (F.col("age_to").isNull() | (F.col("own") < F.col("age_to"))))
    each = mapped.groupBy(site, "age_from", "age_to").agg(F.sum("n").alias("n"))
    same = bands.agg((F.count_distinct("band") == 1).alias("same"))
    pooled = counts(each, ["age_from", "age_to"], ["n"], sites, site=site)
    return pooled.crossJoin(F.broadcast(same)).select("age_from", "age_to", F.when(F.col("same"), F.col("n")).alias("n"))  # one row


def grid_rows(spark, grids: dict[object, Sequence[int]], kind: str = "int", site: str = SITE) -> DataFrame:
    """(site, age_from) of a dict of grids."""
    return spark.createDataFrame([(s, int(a)) for s, g in grids.items() for a in g], f"{site} {kind}, age_from int")
