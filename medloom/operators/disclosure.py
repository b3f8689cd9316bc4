"""The limits under which a site gives results, and the steps that keep them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .explore import banded


@dataclass(frozen=True)
class Settings:
    """A site's limits. The defaults are fixed values: persons a result needs, persons a cell
    needs, levels a column may have and their share of the rows, the width of bands of
    counts, ages and dates, and the most features, columns, bins and events of a group."""

    least_persons: int = 3
    least_in_cell: int = 3
    most_levels: int = 40
    most_level_share: float = 0.33
    band: int = 5
    age_band_years: int = 5
    date_band_days: int = 30
    most_features: int = 1000
    most_columns: int = 5000
    most_bins: int = 10000
    most_events: int = 100


def described(sites: dict[str, Settings], spark: SparkSession) -> DataFrame:
    """(site, setting, value) of all sites."""
    rows = [(site, k, float(v)) for site, s in sorted(sites.items()) for k, v in asdict(s).items()]
    return spark.createDataFrame(rows, "site string, setting string, value double")


def gated(rows: DataFrame, result: DataFrame, settings: Settings) -> DataFrame:
    """The result if the rows it comes from are of enough persons, else none of it."""
    ok = rows.agg((F.count_distinct("person_id") >= settings.least_persons).alias("_ok"))
    return result.crossJoin(F.broadcast(ok)).where("_ok").drop("_ok")  # one row


def without_small_cells(result: DataFrame, persons: str, settings: Settings, counts: Sequence[str] = ()) -> DataFrame:
    """Rows of at least the persons a cell needs, with their counts in bands."""
    out = result.where(F.col(persons) >= settings.least_in_cell)
    return out.withColumns({c: banded(c, settings.band) for c in counts}) if counts else out


def checked(result: DataFrame, settings: Settings) -> DataFrame:
    """The result, unless it has more columns than a site gives."""
    if len(result.columns) > settings.most_columns:
        raise ValueError(f"{len(result.columns)} columns; a site gives {settings.most_columns} at most")
    return result
