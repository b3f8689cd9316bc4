"""Schemas of the tables of a site, their joins, and how sites differ."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, BooleanType, DataType, DateType, NumericType, StructType, TimestampNTZType, TimestampType


def family(kind: DataType) -> str:
    """The family in which types of sites have to agree."""
    for name, kinds in (("binary", BinaryType), ("logical", BooleanType), ("numeric", NumericType), ("temporal", (DateType, TimestampType, TimestampNTZType))):
        if isinstance(kind, kinds):
            return name
    return "character"


def columns(tables: dict[str, DataFrame]) -> list[tuple[str, str, str, str]]:
    """(table, column, type, family) of all tables; nothing is read but schemas."""
    return [(t, f.name, f.dataType.simpleString(), family(f.dataType)) for t, df in sorted(tables.items()) for f in df.schema]


def joins(tables: dict[str, DataFrame]) -> list[tuple[str, str, str, str]]:
    """(from table, from column, to table, to column) by the model's keys: persons, visits and concepts."""

    def edges() -> Iterator[tuple[str, str, str, str]]:
        for t, df in sorted(tables.items()):
            for c in df.columns:
                to = "concept" if c.endswith("concept_id") else c.removesuffix("_id")
                if c.endswith("_id") and to in tables and to != t:
                    yield t, c, to, f"{to}_id"

    return list(edges())


def compare(sites: dict[str, dict[str, StructType]]) -> dict[str, object]:
    """What all sites share, by table and column, and where they differ.

    common: {table: columns that all sites have in one type family}; only: {site: tables
    that not all have}; mismatches: (table, column, {site: family}).
    """
    tables = set.intersection(*[set(s) for s in sites.values()])
    common, wrong = {}, []
    for t in sorted(tables):
        kinds = {site: {f.name: family(f.dataType) for f in s[t]} for site, s in sites.items()}
        shared = set.intersection(*[set(k) for k in kinds.values()])
        common[t] = []
        for c in sorted(shared):
            seen = {site: k[c] for site, k in kinds.items()}
            if len(set(seen.values())) == 1:
                common[t].append(c)
            else:
                wrong.append((t, c, seen))
    return {"common": common, "only": {site: sorted(set(s) - tables) for site, s in sites.items()}, "mismatches": wrong}


def snapshot(tables: dict[str, DataFrame], spark: SparkSession) -> DataFrame:
    """(table_name, n_columns, n_joins): each table with its columns and its keys to others."""
    edges = joins(tables)
    rows = [(t, len(df.columns), sum(e[0] == t for e in edges)) for t, df in sorted(tables.items())]
    return spark.createDataFrame(rows, "table_name string, n_columns int, n_joins int")


def as_table(spark: SparkSession, rows: list[tuple[str, str, str, str]], names: str) -> DataFrame:
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names.split()))
