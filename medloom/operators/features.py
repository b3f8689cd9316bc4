"""Features of persons or episodes: reducers that share one grouped pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def reducers(value: str, date: str, key: str, concept: str, low: str | None = None, high: str | None = None, when: Column | None = None) -> dict[str, Column]:
    """Aggregates by name. ``when`` restricts the rows of a feature without a pass of its
    own. First and latest value are recorded ones, ties by key; deviation and slope of a
    single value are null, as is a ratio by zero."""
    own = (lambda c: F.when(when, c)) if when is not None else (lambda c: c)
    v = own(F.col(value))
    place = F.when(F.col(value).isNotNull(), F.struct(date, key)) if when is None else F.when(when & F.col(value).isNotNull(), F.struct(date, key))
    out = {
        "boolean": F.coalesce(F.max(own(F.lit(True))), F.lit(False)),
        "count": F.count(own(F.lit(1))),
        "latest_value": F.max_by(v, place),
        "first_value": F.min_by(v, place),
        "mean_value": F.avg(v),
        "min_value": F.min(v),
        "max_value": F.max(v),
        "sum_value": F.sum(v),
        "n_distinct": F.count_distinct(own(F.col(concept))),
        "sd_value": F.stddev_samp(v),
        "cv_value": F.try_divide(F.stddev_samp(v), F.avg(v)) * 100,
        "slope_value": F.regr_slope(v.cast("double"), F.datediff(date, F.lit("1970-01-01").cast("date")).cast("double")),
        "latest_date": F.max(own(F.col(date))),
    }
    if high:
        out["abnormal_high"] = F.count(own(F.when(F.col(value) > F.col(high), 1)))
    if low:
        out["abnormal_low"] = F.count(own(F.when(F.col(value) < F.col(low), 1)))
    return out


def features(events: DataFrame, by: Sequence[str], specs: dict[str, Column]) -> DataFrame:
    return events.groupBy(*by).agg(*[c.alias(name) for name, c in specs.items()])


def on_roster(roster: DataFrame, found: DataFrame, by: Sequence[str]) -> DataFrame:
    """Features for all of the roster: absent rows are FALSE and 0 for flags and counts, else null."""
    zero = {c: F.lit(False) if t == "boolean" else F.lit(0) for c, t in found.dtypes if c not in by and (t == "boolean" or c in ("count", "n_distinct", "abnormal_high", "abnormal_low"))}
    out = roster.join(found, list(by), "left")
    return out.withColumns({c: F.coalesce(F.col(c), z) for c, z in zero.items()})


def gaps(events: DataFrame, by: Sequence[str], date: str, key: str) -> DataFrame:
    """Longest and mean days between consecutive events; null for a single one."""
    gap = F.datediff(date, F.lag(date).over(W.partitionBy(*by).orderBy(date, key)))
    return events.withColumn("_gap", gap).groupBy(*by).agg(F.max("_gap").alias("gap_max_days"), F.avg("_gap").alias("gap_mean_days"))


def durations(events: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """Days from start to end, a missing end being the start."""
    days = F.datediff(F.coalesce(end, start), start)
    return events.groupBy(*by).agg(F.avg(days).alias("duration_mean"), F.sum(days).alias("duration_sum"), F.max(days).alias("duration_max"))


def block(events: DataFrame, by: Sequence[str], concept: str, concepts: Sequence[int], make: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """The same features for each of several concepts, in one pass: ``make`` gives the
    features of the rows for which its argument holds; columns are name_concept."""
    specs = {f"{name}_{c}": column for c in concepts for name, column in make(F.col(concept) == c).items()}
    return features(events.where(F.col(concept).isin(*concepts)), by, specs)
