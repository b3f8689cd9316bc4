"""Releases with bounded contributions: sufficient statistics, and keyed noise on them."""

from __future__ import annotations

import datetime
import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def bounded_count(df: DataFrame, cap: int) -> DataFrame:
    return df.groupBy("person_id").agg(F.count("*").alias("n")).agg(F.sum(F.least("n", F.lit(cap))).alias("value"))


def reduced(df: DataFrame, column: str, how: str, order: Sequence[str] = (), cap: int = 1) -> DataFrame:
    """(person_id, v): what each person contributes. One value: the min, max, mean, median or
    mode (the lowest of equals) of the person's values, or the first or last in ``order``
    (ties: the lowest value). Several: the first ``cap`` records in order, or of the distinct
    values (presence) the ``cap`` lowest. Rows without a value contribute nothing.
    """
    rows = df.where(F.col(column).isNotNull()).select("person_id", F.col(column).alias("v"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)])
    place = [f"_o{i}" for i in range(len(order))]
    if how in ("first", "last", "records") and not order:
        raise ValueError(f"{how} needs an order")
    if how in ("records", "presence"):
        if how == "presence":
            rows = rows.select("person_id", "v").distinct()
        w = W.partitionBy("person_id").orderBy(*(place if how == "records" else []), "v")
        return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap).select("person_id", "v")
    if how == "mode":
        n = rows.groupBy("person_id", "v").agg(F.count("*").alias("n"))
        return n.groupBy("person_id").agg(F.min(F.struct((-F.col("n")).alias("n"), "v"))["v"].alias("v"))
    if how == "last":  # of rows equal in order, the lowest value
        w = W.partitionBy("person_id").orderBy(*[F.desc(p) for p in place], "v")
        return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("person_id", "v")
    one = {"min": lambda: F.min("v"), "max": lambda: F.max("v"), "mean": lambda: F.avg("v"), "median": lambda: F.median("v"), "first": lambda: F.min(F.struct(*place, "v"))["v"]}[how]()
    return rows.groupBy("person_id").agg(one.alias("v"))


def categorical(df: DataFrame, column: str, levels: Sequence, cap: int = 1, how: str = "presence", order: Sequence[str] = ()) -> DataFrame:
    """Persons (records: records) by level, each in at most ``cap``; all levels are listed."""
    own = reduced(df.where(F.col(column).isin(*levels)), column, how, order, cap)
    kind = df.schema[column].dataType.simpleString()
    spine = df.sparkSession.createDataFrame([(x,) for x in levels], f"level {kind}")
    return spine.join(own.groupBy(F.col("v").alias("level")).agg(F.count("*").alias("n")), "level", "left").select("level", F.coalesce("n", F.lit(0)).alias("n"))


def distinct(df: DataFrame, column: str, cap: int) -> DataFrame:
    return reduced(df, column, "presence", cap=cap).agg(F.count_distinct("v").alias("value"))


def mean(df: DataFrame, column: str, lower: float, upper: float, grid: int = 1000, how: str = "mean", order: Sequence[str] = ()) -> DataFrame:
    """Persons' values, clipped and put on a grid: count, sum on the grid, and the value they give."""
    one = reduced(df, column, how, order)
    step = F.floor((F.greatest(F.lit(lower), F.least(F.lit(upper), F.col("v"))) - lower) / (upper - lower) * grid + 0.5)
    g = one.agg(F.count("*").alias("n"), F.sum(step).cast("long").alias("sum_grid"))
    return g.withColumn("value", lower + (upper - lower) * F.try_divide(F.col("sum_grid"), F.col("n") * grid))


def numeric(df: DataFrame, column: str, breaks: Sequence, how: str = "mean", order: Sequence[str] = (), cap: int = 1) -> DataFrame:
    """Persons (records: records) by the bin of their value: [a, b), the last one closed; all
    bins are listed. Breaks are numbers, or dates."""
    one = reduced(df, column, how, order, cap)
    last = len(breaks) - 2
    bin_ = F.when(F.col("v") == breaks[-1], last)
    for i in range(last + 1):
        bin_ = bin_.when((F.col("v") >= breaks[i]) & (F.col("v") < breaks[i + 1]), i)
    kind = "date" if isinstance(breaks[0], datetime.date) else "double"
    edges = [x if kind == "date" else float(x) for x in breaks]
    spine = df.sparkSession.createDataFrame([(i, edges[i], edges[i + 1]) for i in range(last + 1)], f"bin int, bin_start {kind}, bin_end {kind}")
    n = one.withColumn("bin", bin_).where("bin is not null").groupBy("bin").agg(F.count("*").alias("n"))
    return spine.join(n, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def rate(df: DataFrame, test: Column, how: str = "any", order: Sequence[str] = (), persons: DataFrame | None = None) -> DataFrame:
    """Share of persons for whom the test holds: on any row, on all, on the first or the last in
    order. Rows for which the test is null don't count. The denominator is the persons with a
    row that counts, or all of ``persons``."""
    rows = df.withColumn("_test", test).where("_test is not null")
    one = rows.groupBy("person_id").agg((F.bool_or("_test") if how == "any" else F.bool_and("_test")).alias("v")) if how in ("any", "all") else reduced(rows, "_test", how, order)
    if persons is not None:
        one = persons.select("person_id").distinct().join(one, "person_id", "left")
    g = one.agg(F.count_if("v").alias("num"), F.count("*").alias("den"))
    return g.withColumn("value", F.try_divide(F.col("num"), F.col("den")))


def keyed(secret: bytes, *message: Column) -> Column:
    """The hex HMAC-SHA256 of the parts of a message under a secret, in the plan. A part is its
    length and its text, so that different messages differ; null differs from every text.

    The two pads that the secret gives are literals of the plan: keep plans and event logs
    of such jobs where the secret may be.
    """
    key = (hashlib.sha256(secret).digest() if len(secret) > 64 else secret).ljust(64, b"\0")
    inner, outer = (bytes(b ^ x for b in key) for x in (0x36, 0x5C))
    text = [c.cast("string") for c in message]
    whole = F.concat(*[F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in text])
    first = F.sha2(F.concat(F.lit(inner), whole.cast("binary")), 256)
    return F.sha2(F.concat(F.lit(outer), F.unhex(first)), 256)


def laplace(digest: Column, scale: float) -> Column:
    """Discrete Laplace noise of a scale, the difference of two geometric draws that the first
    and the next 13 digits of a hex digest give."""
    draw = lambda i: (F.conv(F.substring(digest, i, 13), 16, 10).cast("long") + 1) / float(16**13 + 1)
    steps = lambda i: F.floor(-scale * F.log(draw(i)))
    return (steps(1) - steps(14)).cast("long")


def release(cells: DataFrame, keys: Sequence[str], sensitivity: dict[str, float], secret: bytes, identity: str, epsilon: float) -> DataFrame:
    """cells with noise on the statistics that ``sensitivity`` names, epsilon being shared out
    equally over them.

    Noise is a function of the secret, the request's identity, the statistic and the cell's
    keys: the same request gives the same noise, whatever the partitions, so asking again
    doesn't average it away. All cells that the request lists must be there, with 0 where
    none is: which cells exist isn't protected. Null statistics stay null.
    """
    scale = lambda s: s * len(sensitivity) / epsilon
    draw = lambda c, s: laplace(keyed(secret, F.lit(identity), F.lit(c), *[F.col(k) for k in keys]), scale(s))
    return cells.withColumns({c: F.col(c) + draw(c, s) for c, s in sensitivity.items()})


def released_mean(df: DataFrame, column: str, lower: float, upper: float, secret: bytes, identity: str, epsilon: float, grid: int = 1000) -> DataFrame:
    """(n, sum_grid, value): ``mean`` with half of epsilon on the count and half on the sum."""
    g = release(mean(df, column, lower, upper, grid).select("n", F.coalesce("sum_grid", F.lit(0)).alias("sum_grid")), [], {"n": 1, "sum_grid": grid}, secret, identity, epsilon)
    value = F.when(F.col("n") > 0, lower + (upper - lower) * F.col("sum_grid") / (F.col("n") * grid))
    return g.withColumn("value", F.when(value.isNotNull(), F.greatest(F.lit(lower), F.least(F.lit(upper), value))))


def released_rate(df: DataFrame, test: Column, secret: bytes, identity: str, epsilon: float) -> DataFrame:
    """(num, den, value): ``rate`` with half of epsilon on each count, kept between 0 and 1."""
    g = release(rate(df, test).select("num", "den"), [], {"num": 1, "den": 1}, secret, identity, epsilon)
    return g.withColumn("value", F.when(F.col("den") > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("num") / F.col("den")))))
