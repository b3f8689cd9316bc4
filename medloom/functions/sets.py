"""Rows whose value is in a set that is given as a list or as a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def among(df: DataFrame, column: str, values: Sequence | DataFrame) -> DataFrame:
    """Rows whose column is among the values: a short list becomes part of the plan; a table,
    of which the first column counts, is joined, so it can be of any size."""
    if isinstance(values, DataFrame):
        own = values.select(F.col(values.columns[0]).alias("_value")).distinct()
        return df.join(own, F.col(column) == F.col("_value"), "left_semi")
    return df.where(F.col(column).isin(*values))
