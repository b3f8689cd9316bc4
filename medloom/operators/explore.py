"""Profiles of tables: counts by distinct persons, gated and banded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.quantiles import exact, pick
from ..functions.sets import among


def banded(n: str | Column, width: int = 5) -> Column:
    c = F.col(n) if isinstance(n, str) else n
    return (F.floor(c / width) * width).cast("long")


def table_stats(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct("person_id").alias("n_persons"))


def column_stats(df: DataFrame, column: str) -> DataFrame:
    """Counts of a column, and mean and deviation of one mean per person. Rows are grouped by
    person and value once; both results come from those groups."""
    pairs = df.groupBy("person_id", F.col(column).alias("v")).agg(F.count("*").alias("n"))
    some = F.sum(F.when(F.col("v").isNotNull(), F.col("n")))
    person = pairs.groupBy("person_id").agg(F.sum("n").alias("n"), F.coalesce(some, F.lit(0)).alias("some"), F.try_divide(F.sum(F.col("v") * F.col("n")), some).alias("m"))
    values = pairs.agg(F.count_distinct("v").alias("n_distinct"))
    return person.agg(F.sum("n").alias("n"), F.count("*").alias("n_persons"), (F.sum("n") - F.sum("some")).alias("n_missing"), F.avg("m").alias("mean"), F.stddev_samp("m").alias("sd")).crossJoin(values)  # one row each


def coverage(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_records"), F.count_distinct("person_id").alias("n_persons")) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missingness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a value by column, in one pass."""
    columns = list(columns or df.columns)
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = one.unpivot("_n", columns, "column_name", "n_missing")
    return long.select("column_name", F.col("_n").alias("n_total"), "n_missing", F.try_divide(F.col("n_missing"), F.col("_n")).alias("missing_rate"))


def value_counts(df: DataFrame, column: str, top: int = 20, least_persons: int = 3) -> DataFrame:
    """Most frequent values; values of too few persons go before the top is taken."""
    g = df.groupBy(column).agg(F.count("*").alias("n"), F.count_distinct("person_id").alias("persons")).where(F.col("persons") >= least_persons)
    return g.select(F.col(column).alias("value"), banded("n").alias("n"), banded("persons").alias("n_persons")).orderBy(F.desc("n"), "value").limit(top)


def crosstab(df: DataFrame, row: str, col: str, by: str = "persons", least_persons: int = 3) -> DataFrame:
    g = df.groupBy(F.col(row).alias("row_value"), F.col(col).alias("col_value")).agg(F.count_distinct("person_id").alias("n_persons"), F.count("*").alias("n_records"))
    return g.where(F.col("n_persons") >= least_persons).select("row_value", "col_value", F.col(f"n_{by}").alias("n"))


def comorbidity(df: DataFrame, concept: str, a: int, b: int, other: tuple[DataFrame, str] | None = None, least_persons: int = 1) -> DataFrame:
    """Persons with and without each of two concepts; the second may be of another table,
    (rows, concept column). Cells of fewer than least_persons are left out."""
    rows, column = other or (df, concept)
    both = df.select("person_id", (F.col(concept) == a).alias("a"), F.lit(False).alias("b")).unionByName(rows.select("person_id", F.lit(False).alias("a"), (F.col(column) == b).alias("b")))
    has = lambda c: F.max(F.when(F.col(c), 1).otherwise(0))
    flags = both.groupBy("person_id").agg(has("a").alias("has_a"), has("b").alias("has_b"))
    return flags.groupBy("has_a", "has_b").agg(F.count("*").alias("n_persons")).where(F.col("n_persons") >= least_persons)


def _numbered(df: DataFrame) -> bool:
    """Whether persons are whole numbers."""
    return isinstance(df.select("person_id").schema[0].dataType, IntegralType)


def _marked(df: DataFrame, concept: str, numbered: bool) -> DataFrame:
    """(concept_id, word, mask, n): rows with their person as a bit. 64 neighbouring numbers share
    a word, so a group holds up to 64 persons; other ids are words of their own, of one bit."""
    bit = F.expr("shiftleft(1L, cast(cast(person_id as long) & 63 as int))") if numbered else F.when(F.col("person_id").isNotNull(), F.lit(1).cast("long"))
    word = F.shiftright(F.col("person_id").cast("long"), 6) if numbered else F.col("person_id")
    return df.select(F.col(concept).alias("concept_id"), word.alias("word"), bit.alias("mask"), F.lit(1).cast("long").alias("n"))


def _merged(marked: DataFrame) -> DataFrame:
    return marked.groupBy("concept_id", "word").agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n"))


def _most(merged: DataFrame, metric: str, top: int, offset: int, least_persons: int) -> DataFrame:
    g = merged.groupBy("concept_id").agg(F.coalesce(F.sum(F.bit_count("mask")), F.lit(0)).alias("n_persons"), F.sum("n").alias("n_records")).where(F.col("n_persons") >= least_persons)
    return g.orderBy(F.desc(f"n_{metric}"), "concept_id").offset(offset).limit(top)


def prevalence(df: DataFrame, concept: str, metric: str = "persons", top: int = 50, offset: int = 0, least_persons: int = 3) -> DataFrame:
    """Records and distinct persons by concept, the most frequent ones."""
    return _most(_merged(_marked(df, concept, _numbered(df))), metric, top, offset, least_persons)


def histogram(df: DataFrame, value: str, bins: int = 20, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Equal bins between two quantiles; values beyond go to the outer bins; all bins are listed."""
    v = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    edge = exact(v, "v", (low, high)).select(pick(0).alias("lo"), pick(1).alias("hi")).withColumn("w", (F.col("hi") - F.col("lo")) / bins)
    put = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("lo"), F.col("w"))), F.lit(0)))).cast("int")
    counts = v.crossJoin(F.broadcast(edge)).groupBy("lo", "w", put.alias("bin")).agg(F.count("*").alias("n"))  # one row of edges
    return listed_bins(counts, [], bins)


def listed_bins(counts: DataFrame, keys: Sequence[str], bins: int) -> DataFrame:
    """(keys, bin, bin_start, bin_end, n) of counts (keys, lo, w, bin, n): all bins of each group."""
    one = F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("found")  # ``bins`` entries at most
    all_of = (counts.groupBy(*keys) if keys else counts.groupBy()).agg(F.first("lo").alias("lo"), F.first("w").alias("w"), one)
    out = all_of.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    start = lambda i: F.col("lo") + (F.col("bin") + i) * F.col("w")
    return out.select(*keys, "bin", start(0).alias("bin_start"), start(1).alias("bin_end"), F.coalesce(F.try_element_at("found", F.col("bin")), F.lit(0)).alias("n"))


def quantiles(df: DataFrame, value: str, probs: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95), digits: int = 2) -> DataFrame:
    """Exact quantiles; probabilities are kept within 0.05 and 0.95."""
    ps = sorted({min(0.95, max(0.05, p)) for p in probs})
    one = exact(df, value, ps)
    return one.select(F.explode(F.arrays_zip(F.array(*map(F.lit, ps)).alias("prob"), F.col("q").alias("value"))).alias("x")).select("x.prob", F.round("x.value", digits).alias("value"))


def date_counts(df: DataFrame, date: str, granularity: str = "year") -> DataFrame:
    period = F.to_date(F.date_trunc(granularity, F.col(date)))
    return df.where(F.col(date).isNotNull()).groupBy(period.alias("period")).agg(F.count("*").alias("n_records"), F.count_distinct("person_id").alias("n_persons"))


def locate(tables: dict[str, tuple[DataFrame, str]], concepts: Sequence[int] | DataFrame) -> DataFrame:
    """Where concepts stand: tables maps a name to (rows, concept column). Concepts are a list,
    or a table of one column."""
    out = None
    for name, (df, column) in tables.items():
        part = among(df, column, concepts).groupBy(F.col(column).alias("concept_id")).agg(F.count("*").alias("n_records"), F.count_distinct("person_id").alias("n_persons"))
        part = part.select(F.lit(name).alias("table_name"), F.lit(column).alias("concept_column"), "concept_id", "n_records", "n_persons")
        out = part if out is None else out.unionByName(part)
    return out


def safe_cutpoints(df: DataFrame, value: str, bins: int = 10, least_persons: int = 3) -> DataFrame:
    """Edges of equal bins over persons' means if each bin holds enough persons, else no rows."""
    means = df.where(F.col(value).isNotNull()).groupBy("person_id").agg(F.avg(value).alias("v"))
    h = histogram(means, "v", bins)
    ok = h.agg((F.min("n") >= least_persons).alias("ok"))
    return h.crossJoin(F.broadcast(ok)).where("ok").select("bin", "bin_start", "bin_end")  # one row


def drilldown(df: DataFrame, concept: str, concept_id: int, value: str, date: str, category: str) -> dict[str, DataFrame]:
    """A profile of one concept: summary, histogram and quantiles of its values, its
    categories, and rows without a value."""
    own = df.where(F.col(concept) == concept_id)
    summary = own.agg(F.count("*").alias("n_records"), F.count_distinct("person_id").alias("n_persons"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))
    return {"summary": summary, "histogram": histogram(own, value), "quantiles": quantiles(own, value), "categories": value_counts(own, category), "missingness": missingness(own, [value, category])}


def summary(df: DataFrame, column: str) -> DataFrame:
    """Value counts of a concept column, else counts, mean, deviation and quantiles of the column."""
    if column.endswith("concept_id"):
        return value_counts(df, column)
    q = quantiles(df, column).agg(F.map_from_entries(F.collect_list(F.struct("prob", "value"))).alias("quantiles"))
    return column_stats(df, column).crossJoin(F.broadcast(q))  # one row each


def prevalence_of_all(tables: dict[str, tuple[DataFrame, str]], metric: str = "persons", top: int = 50, offset: int = 0, least_persons: int = 3) -> DataFrame:
    """Prevalence over several tables as one; tables maps a name to (rows, concept column).
    Each table is merged by itself first: a stage that reads them all gets tasks as large as
    the tables together ask for, and each holds a join and the groups."""
    numbered = all(_numbered(df) for df, _ in tables.values())
    parts = [_merged(_marked(df, column, numbered)) for df, column in tables.values()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _most(_merged(out), metric, top, offset, least_persons)


def crosstab_slices(df: DataFrame, row: str, col: str, stratum: str, by: str = "persons", least_persons: int = 3) -> DataFrame:
    """A crosstab for each value of a third column; small cells of each go."""
    g = df.groupBy(F.col(stratum).alias("stratum"), F.col(row).alias("row_value"), F.col(col).alias("col_value"))
    g = g.agg(F.count_distinct("person_id").alias("n_persons"), F.count("*").alias("n_records")).where(F.col("n_persons") >= least_persons)
    return g.select("stratum", "row_value", "col_value", F.col(f"n_{by}").alias("n"))
