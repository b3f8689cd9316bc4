"""Pooling of results by site: each a grouped aggregation over rows (site, keys, statistics)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.quantiles import exact, pick
from .explore import listed_bins

Z = 1.959963984540054
#: Values that differ by no more than this part of them are the same one computed twice: sums of
#: doubles depend in their last digits on the order in which tasks end.
SAME = 1e-9


SITE = "site_id"


def _sites(site: str = SITE) -> Column:
    """How many sites give a row for a key. A site that gives several is an error, as they
    would count for another site that gives none."""
    n = F.count_distinct(site)
    return F.when(F.count("*") == n, n).otherwise(F.raise_error(F.lit("a site has several rows for a key")).cast("long"))


def _total(items: Column, value) -> Column:
    """Sum of value(x) over an array of one struct a site."""
    return F.aggregate(items, F.lit(0.0), lambda s, x: s + value(x))


def counts(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], sites: int, strict: bool = True, site: str = SITE) -> DataFrame:
    """Sums over sites of rows (site, keys, columns); strict: null where a site is missing or
    has no value, else what the other sites have."""
    each = lambda c: F.when(F.count(c) == sites, F.sum(c)) if strict else F.sum(c)
    g = rows.groupBy(*keys).agg(_sites(site).alias("_sites"), *[each(c).alias(c) for c in columns])
    return g.where("_sites > 0").drop("_sites")


def moments(rows: DataFrame, keys: Sequence[str], n: str = "n", mean: str = "mean", variance: str = "variance", site: str = SITE) -> DataFrame:
    """Count, mean and sample variance of all sites together from those of each, rows (site,
    keys, n, mean, variance). What lies between the sites is summed about the pooled mean."""
    r = rows.where(F.col(n) > 0)
    own = F.collect_list(F.struct(F.col(n).alias("n"), F.col(mean).cast("double").alias("m"), F.coalesce(variance, F.lit(0.0)).alias("v")))  # one a site
    g = r.groupBy(*keys).agg(_sites(site).alias("_sites"), F.sum(n).alias("n"), (F.sum(F.col(n) * F.col(mean)) / F.sum(n)).alias("mean"), own.alias("own")).where("_sites > 0")
    spread = _total(F.col("own"), lambda x: (x["n"] - 1) * x["v"] + x["n"] * (x["m"] - F.col("mean")) * (x["m"] - F.col("mean")))
    return g.select(*keys, "n", "mean", F.try_divide(spread, F.col("n") - 1).alias("variance"))


def _columns(names: str | Sequence[str]) -> list[Column]:
    return [F.col(c) for c in ([names] if isinstance(names, str) else names)]


def _quotient(numerator: str | Sequence[str], denominator: str | Sequence[str], scale: float) -> tuple[Column, Column, Column]:
    """Aggregates: the sums of the numerator's and the denominator's columns over rows that have
    a value in all of them, and the quotient, null unless it is of something above 0."""
    tops, bottoms = _columns(numerator), _columns(denominator)
    whole = reduce(lambda a, b: a & b, [c.isNotNull() for c in (*tops, *bottoms)])
    num, den = (F.sum(F.when(whole, reduce(lambda a, b: a + b, cs))) for cs in (tops, bottoms))
    return num, den, F.when((num >= 0) & (den > 0), num / den * scale)


def ratio(rows: DataFrame, keys: Sequence[str], numerator: str | Sequence[str], denominator: str | Sequence[str], scale: float = 1.0, site: str = SITE) -> DataFrame:
    """The quotient of the sites' sums, each of a column or of several together."""
    num, den, value = _quotient(numerator, denominator, scale)
    g = rows.groupBy(*keys).agg(_sites(site).alias("_sites"), num.alias("numerator"), den.alias("denominator"), value.alias("ratio"))
    return g.where("_sites > 0").drop("_sites")


def effects(rows: DataFrame, keys: Sequence[str], estimate: str = "log_estimate", se: str = "se", strict: bool = True, site: str = SITE) -> DataFrame:
    """Inverse-variance meta-analysis with fixed and random effects of rows (site, keys,
    estimate, se). Rows without an estimate or with a standard error of 0 or none are left
    out. A site may repeat its estimate of a key, also one computed anew, whose last digits may
    differ (by a part of 1e-9 at most); if it gives different ones, none can stand for it:
    strict, all of the key's results are null, else the site is left out of it."""
    r = rows.where((F.col(se) > 0) & F.col(estimate).isNotNull())
    y, s = F.col(estimate).cast("double"), F.col(se).cast("double")
    pair = F.struct(y.alias("y"), s.alias("s"))
    # an estimate may be 0 but for rounding, so its digits are told by its error too
    near = (F.max(y) - F.min(y) <= SAME * F.greatest(F.max(F.abs(y)), F.min(s))) & (F.max(s) - F.min(s) <= SAME * F.min(s))
    r = r.groupBy(*keys, F.col(site).alias("_site")).agg(F.min(pair).alias("p"), ((F.min(pair) == F.max(pair)) | near).alias("one"))
    y, s = F.when(F.col("one"), F.col("p.y")), F.when(F.col("one"), F.col("p.s"))
    w = 1 / (s * s)
    own = F.collect_list(F.when(F.col("one"), F.struct(y.alias("y"), (s * s).alias("v"))))  # one a site
    g = r.groupBy(*keys).agg(F.count_if("one").alias("k"), F.sum(w).alias("sw"), F.sum(w * w).alias("sww"), (F.sum(w * y) / F.sum(w)).alias("fixed"), own.alias("own"), F.bool_and("one").alias("ok"))
    g = g.withColumn("q", _total(F.col("own"), lambda x: (x["y"] - F.col("fixed")) * (x["y"] - F.col("fixed")) / x["v"]))
    over = F.col("q") - (F.col("k") - 1)
    g = g.withColumn("tau2", F.greatest(F.lit(0.0), F.coalesce(F.try_divide(over, F.col("sw") - F.col("sww") / F.col("sw")), F.lit(0.0))))
    g = g.withColumn("i2", F.greatest(F.lit(0.0), F.coalesce(F.try_divide(over, F.col("q")), F.lit(0.0)) * 100))
    g = g.withColumn("sws", _total(F.col("own"), lambda x: 1 / (x["v"] + F.col("tau2"))))
    g = g.withColumn("random", F.try_divide(_total(F.col("own"), lambda x: x["y"] / (x["v"] + F.col("tau2"))), F.col("sws"))).withColumn("random_se", F.sqrt(F.try_divide(F.lit(1.0), F.col("sws"))))
    g = g.withColumn("fixed_se", F.sqrt(1 / F.col("sw"))).withColumn("lower", F.col("random") - Z * F.col("random_se")).withColumn("upper", F.col("random") + Z * F.col("random_se"))
    known = (F.col("ok") if strict else F.lit(True)) & (F.col("k") > 0)
    return g.select(*keys, *[F.when(known, F.col(c)).alias(c) for c in ("k", "fixed", "fixed_se", "q", "i2", "tau2", "random", "random_se", "lower", "upper")])


def top(rows: DataFrame, key: str, value: str, sites: int, k: int, strict: bool = True, site: str = SITE) -> DataFrame:
    """Largest sums among keys; strict: among those that every site has."""
    g = rows.where(F.col(value).isNotNull()).groupBy(key).agg(F.sum(value).alias(value), _sites(site).alias("_sites")).where(F.col("_sites") >= (sites if strict else 1))
    return g.select(key, value).orderBy(F.desc(value), key).limit(k)


def histogram(rows: DataFrame, sites: int, strict: bool = True, site: str = SITE) -> DataFrame:
    """Sum of bins (site, bin, bin_start, bin_end, n). Strict: null where a site's bin is missing
    or suppressed, and unequal edges are an error; else those sites count whose edges are
    those of the first site, by name, that has the bin."""
    first = lambda c: F.min_by(c, site).over(W.partitionBy("bin"))
    r = rows.withColumns({"_start": first("bin_start"), "_end": first("bin_end")})
    same = (F.abs(F.col("bin_start") - F.col("_start")) <= 1e-6) & (F.abs(F.col("bin_end") - F.col("_end")) <= 1e-6)
    wrong = F.raise_error(F.lit("sites have different edges")).cast("boolean")
    r = r.where(F.when(same, F.lit(True)).otherwise(wrong if strict else F.lit(False)))
    g = r.groupBy("bin").agg(F.min("_start").alias("bin_start"), F.min("_end").alias("bin_end"), F.count("n").alias("held"), F.sum("n").alias("total"), _sites(site).alias("_sites")).where("_sites > 0")
    return g.select("bin", "bin_start", "bin_end", F.when(F.col("held") >= (sites if strict else 1), F.col("total")).alias("n"))


def tabular(rows: DataFrame, keys: Sequence[str], roles: dict[str, tuple], sites: int, strict: bool = True, site: str = SITE) -> DataFrame:
    """Site results pooled by the role of each column, in one grouped pass.

    roles: {new column: (role, source columns...)} with the roles sum, min, max; ratio
    (numerator, denominator, scale), of the pooled sums, either of a column or of a list of
    columns taken together; weighted_mean (value, weight);
    pooled_sd (n, mean, sd), Cochrane's; label, null when sites differ; and nonpoolable
    (type), always null. Strict keeps only the keys of all sites. A site that gives a key
    more than once is an error.
    """
    c = F.col

    def pooled(role: str, *x) -> Column:
        if role in ("sum", "min", "max"):
            return getattr(F, role)(x[0])
        if role == "nonpoolable":
            return F.first(F.lit(None).cast(x[0] if x else "double"))
        if role == "label":
            return F.when(F.count_distinct(x[0]) == 1, F.min(x[0]))
        if role == "ratio":
            return _quotient(x[0], x[1], x[2] if len(x) > 2 else 1.0)[2]
        if role == "weighted_mean":
            ok = (c(x[1]) > 0) & c(x[0]).isNotNull()
            return F.try_divide(F.sum(F.when(ok, c(x[0]) * c(x[1]))), F.sum(F.when(ok, c(x[1]))))
        if role == "pooled_sd":
            n, m, sd = map(c, x)
            ok = (n >= 1) & m.isNotNull()
            own = F.collect_list(F.when(ok, F.struct(n.cast("double").alias("n"), m.cast("double").alias("m"), F.coalesce(sd, F.lit(0.0)).alias("sd"))))  # one a site
            total, mean = F.sum(F.when(ok, n)), F.try_divide(F.sum(F.when(ok, n * m)), F.sum(F.when(ok, n)))
            spread = _total(own, lambda x: (x["n"] - 1) * x["sd"] * x["sd"] + x["n"] * (x["m"] - mean) * (x["m"] - mean))
            return F.when(total > 1, F.sqrt(F.greatest(F.lit(0.0), F.try_divide(spread, total - 1))))
        raise ValueError(f"no such role: {role}")

    g = rows.groupBy(*keys).agg(_sites(site).alias("_sites"), *[pooled(*how).alias(name) for name, how in roles.items()])
    return g.where(c("_sites") >= (sites if strict else 1)).drop("_sites")


def survival_curves(rows: DataFrame, keys: Sequence[str], sites: int, site: str = SITE) -> DataFrame:
    """Kaplan-Meier curves of sites (keys, time, at_risk, events) pooled on their common grid.

    A curve ends before the first time at which a site is missing or suppressed.
    """
    g = rows.groupBy(*keys, "time").agg(F.sum("at_risk").alias("at_risk"), F.sum("events").alias("events"), ((_sites(site) == sites) & (F.count("at_risk") == sites) & (F.count("events") == sites)).alias("ok"))
    w = W.partitionBy(*keys).orderBy("time").rowsBetween(W.unboundedPreceding, 0)
    g = g.withColumn("ok", F.bool_and("ok").over(w)).where("ok")
    factor = F.when(F.col("at_risk") > 0, 1 - F.col("events") / F.col("at_risk")).otherwise(1.0)
    return g.select(*keys, "time", "at_risk", "events", F.product(factor).over(w).alias("survival"))


def site_histograms(rows: DataFrame, site: str, value: str, bins: int = 20, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """(site, bin, bin_start, bin_end, n) on edges that all sites share: from the least lower
    to the greatest upper quantile of a site. Values beyond go to the outer bins."""
    v = rows.where(F.col(value).isNotNull()).select(F.col(site).alias("site"), F.col(value).cast("double").alias("v"))
    own = exact(v, "v", (low, high), ["site"]).select("site", pick(0).alias("lo"), pick(1).alias("hi"))
    edge = own.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("lo", ((F.col("hi") - F.col("lo")) / bins).alias("w"))
    put = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("lo"), F.col("w"))), F.lit(0)))).cast("int")
    found = v.crossJoin(F.broadcast(edge)).groupBy("site", "lo", "w", put.alias("bin")).agg(F.count("*").alias("n"))  # one row of edges
    return listed_bins(found, ["site"], bins)


def released_mean(rows: DataFrame, lower: float, upper: float, grid: int = 1000, site: str = SITE) -> DataFrame:
    """The mean that the sites' released counts and grid sums (site, n, sum_grid) give together,
    kept within its bounds."""
    g = rows.agg(_sites(site).alias("_sites"), F.sum("n").alias("n"), F.sum("sum_grid").alias("sum_grid")).where("_sites >= 0").drop("_sites")
    value = lower + (upper - lower) * F.try_divide(F.col("sum_grid"), F.col("n") * grid)
    return g.withColumn("value", F.when(value.isNotNull(), F.greatest(F.lit(lower), F.least(F.lit(upper), value))))


def released(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], sites: int, strict: bool = True, site: str = SITE) -> DataFrame:
    """Sums of the sites' released counts or histograms. What is released is noisy, so a sum
    below 0 counts as 0."""
    g = counts(rows, keys, columns, sites, strict, site)
    return g.select(*keys, *[F.greatest(F.col(c), F.lit(0)).alias(c) for c in columns]) if columns else g


def released_rate(rows: DataFrame, site: str = SITE) -> DataFrame:
    """The rate that the sites' released numerators and denominators (site, num, den) give
    together, kept between 0 and 1."""
    g = rows.agg(_sites(site).alias("_sites"), F.sum("num").alias("num"), F.sum("den").alias("den")).where("_sites >= 0").drop("_sites")
    value = F.when(F.col("den") > 0, F.col("num") / F.col("den"))
    return g.withColumn("value", F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))))
