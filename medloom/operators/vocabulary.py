"""Lookups in the vocabulary tables: concepts, their hierarchy, names and relationships."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sets import among
from ..sources.tables import cut

#: Most rows of a page; a higher limit of the caller counts as this one.
PAGE = 1000


def lookup(concept: DataFrame, ids: Sequence[int] | DataFrame) -> DataFrame:
    return among(concept, "concept_id", ids)


def search(concept: DataFrame, pattern: str | None = None, domain: str | None = None, vocabulary: str | None = None, standard_only: bool = True, valid_only: bool = False, limit: int = 50) -> DataFrame:
    """Concepts whose name contains the pattern, upper and lower case alike, by concept_id."""
    out = concept
    if pattern:
        out = out.where(F.contains(F.lower("concept_name"), F.lit(pattern.lower())))
    for column, value in (("domain_id", domain), ("vocabulary_id", vocabulary)):
        if value is not None:
            out = out.where(F.col(column) == value)
    if standard_only:
        out = out.where(F.col("standard_concept") == "S")
    if valid_only:
        out = out.where(F.col("invalid_reason").isNull())
    return out.orderBy("concept_id").limit(limit)


def page(concept: DataFrame, equal: dict[str, str] | None = None, order: str = "concept_id", offset: int = 0, limit: int = 100) -> DataFrame:
    """A page of concepts with ``total_count``, the number of all that fit; ties by concept_id."""
    fit = reduce(lambda df, kv: df.where(F.col(kv[0]) == kv[1]), (equal or {}).items(), concept)
    total = fit.agg(F.count("*").alias("total_count"))
    return fit.orderBy(F.asc_nulls_last(order), "concept_id").offset(offset).limit(min(limit, PAGE)).crossJoin(F.broadcast(total))  # one row


def descendants(ancestor: DataFrame, ids: Sequence[int] | DataFrame, include_self: bool = True) -> DataFrame:
    """(ancestor_concept_id, concept_id) below the given concepts, a list or a table."""
    out = among(ancestor, "ancestor_concept_id", ids).select("ancestor_concept_id", F.col("descendant_concept_id").alias("concept_id"))
    same = F.col("ancestor_concept_id") == F.col("concept_id")
    if not include_self:
        return out.where(~same)
    own = ids if isinstance(ids, DataFrame) else ancestor.sparkSession.createDataFrame([(int(c),) for c in ids], "concept_id int")
    return out.union(own.select(*[F.col(own.columns[0]).alias(c) for c in ("ancestor_concept_id", "concept_id")])).distinct()


def relatives(ancestor: DataFrame, ids: Sequence[int] | DataFrame) -> DataFrame:
    """Ancestors and descendants: (seed_concept_id, concept_id, direction, levels_of_separation)."""
    a, d, n = "ancestor_concept_id", "descendant_concept_id", F.col("min_levels_of_separation").alias("levels_of_separation")
    rows = ancestor.where(F.col(a) != F.col(d))
    up = among(rows, d, ids).select(F.col(d).alias("seed_concept_id"), F.col(a).alias("concept_id"), F.lit("ancestor").alias("direction"), n)
    down = among(rows, a, ids).select(F.col(a).alias("seed_concept_id"), F.col(d).alias("concept_id"), F.lit("descendant").alias("direction"), n)
    return up.unionByName(down)


def relationships(relationship: DataFrame, ids: Sequence[int] | DataFrame, kind: str | None = None) -> DataFrame:
    """Relationships from and to the given concepts: (seed_concept_id, concept_id, relationship_id, direction)."""
    r = relationship if kind is None else relationship.where(F.col("relationship_id") == kind)
    one = lambda own, other, way: among(r, own, ids).select(F.col(own).alias("seed_concept_id"), F.col(other).alias("concept_id"), "relationship_id", F.lit(way).alias("direction"))
    return one("concept_id_1", "concept_id_2", "from").unionByName(one("concept_id_2", "concept_id_1", "to"))


def expand(concepts: Sequence[int], ancestor: DataFrame, relationship: DataFrame | None = None, include_descendants: bool = False, include_mapped: bool = False, exclude: Sequence[int] = ()) -> DataFrame:
    """A concept set as concept_id: the concepts, those below, and those that map to any of
    these, without the excluded ones."""
    seed = ancestor.sparkSession.createDataFrame([(int(c),) for c in concepts], "concept_id int")
    out = seed.union(descendants(ancestor, concepts).select("concept_id")) if include_descendants else seed
    if include_mapped:
        maps = relationship.where(F.col("relationship_id") == "Maps to").select(F.col("concept_id_1").alias("source"), F.col("concept_id_2").alias("concept_id"))
        out = out.union(maps.join(out.distinct(), "concept_id", "left_semi").select("source"))
    return out.where(~F.col("concept_id").isin(*exclude)).distinct() if exclude else out.distinct()


def synonyms(synonym: DataFrame, ids: Sequence[int]) -> DataFrame:
    return synonym.where(F.col("concept_id").isin(*ids))


def names(concept: DataFrame, column: str) -> DataFrame:
    """The vocabularies, domains or classes in use, with their number of concepts."""
    return concept.groupBy(column).agg(F.count("*").alias("n_concepts"))


def translate(rows: DataFrame, concept: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A ``_name`` column beside each concept column; unknown concepts get null."""
    for c in columns:
        own = concept.select(F.col("concept_id").alias(c), F.col("concept_name").alias(f"{c}_name"))
        rows = rows.join(own, c, "left")
    return rows


def dictionary(outputs: dict[str, tuple[DataFrame, Sequence[str]]], concept: DataFrame) -> DataFrame:
    """Concepts that outputs use: (concept_id, concept_name, domain_id, outputs), outputs a sorted list."""
    parts = [df.select(F.col(c).alias("concept_id"), F.lit(name).alias("output")).where(F.col(c).isNotNull()).distinct() for name, (df, columns) in outputs.items() for c in columns]
    used = reduce(DataFrame.unionByName, parts).groupBy("concept_id").agg(F.array_join(F.array_sort(F.collect_set("output")), ",").alias("outputs"))
    return used.join(concept.select("concept_id", "concept_name", "domain_id"), "concept_id", "left")


def levels(rows: DataFrame, column: str, most: int = 40) -> DataFrame:
    """Codes of a column's values: (level, code) from 1, numbers by size and texts by code
    point; no rows when there are more than ``most`` values, so the list stays small."""
    found = rows.where(F.col(column).isNotNull()).select(F.col(column).alias("level")).distinct().limit(most + 1)
    coded = found.agg(F.array_sort(F.collect_list("level")).alias("all")).where(F.size("all") <= most)
    return coded.select(F.posexplode("all").alias("code", "level")).select("level", (F.col("code") + 1).alias("code"))


def closure(relationship: DataFrame, kind: str = "Is a", own: bool = True) -> DataFrame:
    """(ancestor_concept_id, descendant_concept_id, min_levels_of_separation) of the hierarchy
    that the relationships concept_id_1 ``kind`` concept_id_2 make, without a table of it.

    From the pairs found last, one level further on, until nothing new comes: a pair is found
    first at its least distance, and a pair that is known isn't followed again, so diamonds
    count once and cycles end. A concept in a cycle isn't its own descendant; with ``own``
    each concept of the hierarchy stands at distance 0 from itself. Each level is written to
    the shared folder and read again, so the plan doesn't grow with the levels. Rows with a
    null or with the same concept twice are left out.
    """
    a, d, n = "ancestor_concept_id", "descendant_concept_id", "min_levels_of_separation"
    rows = relationship.where((F.col("relationship_id") == kind) & (F.col("concept_id_1") != F.col("concept_id_2")))
    edges = cut(rows.select(F.col("concept_id_2").alias(a), F.col("concept_id_1").alias(d)).distinct(), "edges")
    found = [edges.withColumn(n, F.lit(1))]
    front = edges
    while not front.isEmpty():
        step = front.join(edges.toDF(d, "_next"), d).where(F.col(a) != F.col("_next")).select(a, F.col("_next").alias(d)).distinct()
        front = cut(step.join(reduce(DataFrame.unionByName, found).select(a, d), [a, d], "left_anti"), "level")
        found.append(front.withColumn(n, F.lit(len(found) + 1)))
    if own:
        every = edges.select(F.explode(F.array(a, d)).alias(a)).distinct()
        found.append(every.select(a, F.col(a).alias(d), F.lit(0).alias(n)))
    return reduce(DataFrame.unionByName, found)
