"""Queries of named analyses, result tables, pooled results and releases, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .cdm.fixture import view
from .operators import explore as E
from .operators import pooling as P
from .operators import privacy as D
from .operators import results as Q
from .registry import index, index_sql, query, rounded


@query(index_sql() + """, n AS (SELECT count(DISTINCT subject_id) AS n FROM idx) SELECT condition_concept_id AS concept_id, count(DISTINCT person_id) AS n_persons, round(count(DISTINCT person_id) / CAST(min(n) AS DOUBLE), 6) AS prevalence
FROM condition_occurrence, n WHERE person_id IN (SELECT subject_id FROM idx) GROUP BY 1 HAVING count(DISTINCT person_id) >= 3 ORDER BY 2 DESC, 1 LIMIT 50""")
def analysis_prevalence(spark, d):
    return Q.cohort_prevalence(view(spark, d, "condition_occurrence"), "condition_concept_id", index(spark, d)).select("concept_id", "n_persons", *rounded("prevalence"))


@query("""SELECT measurement_concept_id AS concept_id, count(*) AS n, round(avg(value_as_number), 6) AS mean, round(stddev_samp(value_as_number), 6) AS sd, round(quantile_cont(value_as_number, 0.1), 6) AS p10, round(quantile_cont(value_as_number, 0.5), 6) AS median, round(quantile_cont(value_as_number, 0.9), 6) AS p90
FROM measurement WHERE value_as_number IS NOT NULL GROUP BY 1""")
def analysis_distribution(spark, d):
    return Q.distribution(view(spark, d, "measurement"), "measurement_concept_id", "value_as_number").select("concept_id", "n", *rounded("mean", "sd", "p10", "median", "p90"))


@query("SELECT site_id, stratum_1, stratum_2, count_value FROM achilles_results WHERE analysis_id = 200 AND stratum_1 = 'F' ORDER BY count_value DESC NULLS LAST, site_id, stratum_1, stratum_2 LIMIT 10")
def results_read(spark, d):
    t = view(spark, d, "achilles_results").select("site_id", "stratum_1", "stratum_2", "count_value", "analysis_id")
    return Q.read_results(t, ["site_id", "stratum_1", "stratum_2", "count_value"], {"analysis_id": 200, "stratum_1": "F"}, "count_value", True, 10)


@query("SELECT DISTINCT analysis_id FROM achilles_results")
def results_catalog(spark, d):
    sites = [view(spark, d, "achilles_results").where(F.col("site_id") == s).select("analysis_id") for s in range(3)]
    return Q.union_of_sites(sites)


@query("SELECT CAST(site_id AS VARCHAR) AS site, analysis_id, stratum_1, count_value FROM achilles_results_dist")
def results_by_site(spark, d):
    t = view(spark, d, "achilles_results_dist")
    return Q.by_site({str(s): t.where(F.col("site_id") == s).select("analysis_id", "stratum_1", "count_value") for s in range(3)})


@query("SELECT analysis_id, stratum_1, stratum_2, CASE WHEN count(count_value) = 3 THEN CAST(sum(count_value) AS BIGINT) END AS count_value FROM achilles_results GROUP BY 1, 2, 3")
def results_pooled(spark, d):
    return P.counts(view(spark, d, "achilles_results"), ["analysis_id", "stratum_1", "stratum_2"], ["count_value"], 3)


@query("SELECT o_orderstatus AS stratum_1, count(*) AS n, round(avg(CAST(o_totalprice AS DOUBLE)), 4) AS mean, round(stddev_samp(CAST(o_totalprice AS DOUBLE)), 3) AS sd, round(min(CAST(o_totalprice AS DOUBLE)), 4) AS low, round(max(CAST(o_totalprice AS DOUBLE)), 4) AS high FROM orders WHERE o_custkey IN (SELECT person_id FROM person) GROUP BY 1")
def results_distribution_pooled(spark, d):
    roles = {"n": ("sum", "count_value"), "mean": ("weighted_mean", "avg_value", "count_value"), "sd": ("pooled_sd", "count_value", "avg_value", "stdev_value"), "low": ("min", "min_value"), "high": ("max", "max_value")}
    out = P.tabular(view(spark, d, "achilles_results_dist"), ["stratum_1"], roles, 3)
    return out.select("stratum_1", "n", F.round("mean", 4).alias("mean"), F.round("sd", 3).alias("sd"), F.round("low", 4).alias("low"), F.round("high", 4).alias("high"))


@query("""WITH s AS (SELECT p.site_id, visit_concept_id, count(*) AS den, count(CASE WHEN visit_end_date > visit_start_date THEN 1 END) AS num, 'visits' AS label FROM visit_occurrence v JOIN person p ON v.person_id = p.person_id GROUP BY 1, 2)
SELECT visit_concept_id, round(sum(num) * 1000.0 / sum(den), 6) AS per_1000, 'visits' AS label FROM s GROUP BY 1 HAVING count(*) = 3""")
def pool_tabular(spark, d):
    v = view(spark, d, "visit_occurrence").join(view(spark, d, "person").select("person_id", "site_id"), "person_id")
    g = v.groupBy("site_id", "visit_concept_id").agg(F.count("*").alias("den"), F.count_if(F.col("visit_end_date") > F.col("visit_start_date")).alias("num")).withColumn("label", F.lit("visits"))
    return P.tabular(g, ["visit_concept_id"], {"per_1000": ("ratio", "num", "den", 1000.0), "label": ("label", "label")}, 3).select("visit_concept_id", *rounded("per_1000"), "label")


_GRID = """WITH c AS (SELECT p.site_id, CAST(date_diff('day', DATE '2000-06-30', death_date) AS INT) AS day FROM death d JOIN person p ON d.person_id = p.person_id), t AS (SELECT DISTINCT CAST(30 * i AS INT) AS time FROM range(10) x(i)),
s AS (SELECT site_id, time, count(CASE WHEN day >= time THEN 1 END) AS at_risk, count(CASE WHEN day >= time AND day < time + 30 THEN 1 END) AS events FROM c CROSS JOIN t GROUP BY 1, 2)"""


@query(_GRID + """, g AS (SELECT time, sum(at_risk) AS at_risk, sum(events) AS events FROM s GROUP BY time HAVING count(*) = 3) SELECT 'all' AS stratum, time, CAST(at_risk AS BIGINT) AS at_risk, CAST(events AS BIGINT) AS events,
round(product(CASE WHEN at_risk > 0 THEN 1 - events / CAST(at_risk AS DOUBLE) ELSE 1 END) OVER (ORDER BY time ROWS UNBOUNDED PRECEDING), 6) AS survival FROM g""")
def pool_survival(spark, d):
    dead = view(spark, d, "death").join(view(spark, d, "person").select("person_id", "site_id"), "person_id").withColumn("day", F.datediff("death_date", F.lit("2000-06-30").cast("date")))
    grid = dead.withColumn("time", F.explode(F.sequence(F.lit(0), F.lit(270), F.lit(30))))  # ten times a row
    s = grid.groupBy("site_id", "time").agg(F.count_if(F.col("day") >= F.col("time")).alias("at_risk"), F.count_if((F.col("day") >= F.col("time")) & (F.col("day") < F.col("time") + 30)).alias("events"))
    return P.survival_curves(s.withColumn("stratum", F.lit("all")), ["stratum"], 3).select("stratum", "time", "at_risk", "events", *rounded("survival"))


@query("""WITH s AS (SELECT p.site_id, CAST(date_trunc('year', visit_start_date) AS DATE) AS period, count(*) AS n FROM visit_occurrence v JOIN person p ON v.person_id = p.person_id GROUP BY 1, 2) SELECT period, CAST(sum(n) AS BIGINT) AS n_records FROM s GROUP BY 1 HAVING count(*) = 3""")
def pool_date_counts(spark, d):
    parts = []
    people = view(spark, d, "person").select("person_id", "site_id")
    for s in range(3):
        rows = view(spark, d, "visit_occurrence").join(people.where(F.col("site_id") == s), "person_id", "left_semi")
        parts.append(E.date_counts(rows, "visit_start_date", "year").withColumn("site_id", F.lit(s)))
    return P.tabular(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["period"], {"n_records": ("sum", "n_records")}, 3)


@query("""WITH c AS (SELECT site_id, gender_concept_id AS row_value, race_concept_id AS col_value, count(DISTINCT person_id) AS n FROM person GROUP BY 1, 2, 3 HAVING count(DISTINCT person_id) >= 3) SELECT row_value, col_value, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY 1, 2 HAVING count(*) = 3""")
def pool_crosstab(spark, d):
    parts = [E.crosstab(view(spark, d, "person").where(F.col("site_id") == s), "gender_concept_id", "race_concept_id").withColumn("site_id", F.lit(s)) for s in range(3)]
    return P.tabular(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["row_value", "col_value"], {"n": ("sum", "n")}, 3)


@query("""WITH o AS (SELECT avg(value_as_number) AS v FROM measurement WHERE value_as_number IS NOT NULL GROUP BY person_id), b AS (SELECT * FROM (VALUES (0, 0.0, 100.0), (1, 100.0, 200.0), (2, 200.0, 210.0), (3, 210.0, 400.0)) t(bin, bin_start, bin_end))
SELECT bin, CAST(bin_start AS DOUBLE) AS bin_start, CAST(bin_end AS DOUBLE) AS bin_end, count(v) AS n FROM b LEFT JOIN o ON v >= bin_start AND (v < bin_end OR (bin = 3 AND v = bin_end)) GROUP BY 1, 2, 3""")
def privacy_numeric(spark, d):
    return D.numeric(view(spark, d, "measurement"), "value_as_number", [0.0, 100.0, 200.0, 210.0, 400.0])
