"""Queries of pooled profiles, cohort scopes and selections, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .cdm.fixture import view
from .operators import cohort as C
from .operators import explore as E
from .operators import features as R
from .operators import people as H
from .operators import pooling as P
from .operators import privacy as D
from .operators import temporal as T
from .registry import index, index_sql, query, rounded
from .sources import tables as S

SITES = 3
_CONCEPT = {"condition_occurrence": "condition_concept_id", "procedure_occurrence": "procedure_concept_id", "drug_exposure": "drug_concept_id", "measurement": "measurement_concept_id"}


def _by_site(spark, d, table):
    return view(spark, d, table).join(view(spark, d, "person").select("person_id", "site_id"), "person_id")


@query("""WITH m AS (SELECT site_id, value_as_number AS v FROM measurement JOIN person ON measurement.person_id = person.person_id WHERE value_as_number IS NOT NULL),
e AS (SELECT quantile_cont(v, 0.05) AS lo, quantile_cont(v, 0.95) AS hi FROM m GROUP BY site_id), r AS (SELECT min(lo) AS lo, (max(hi) - min(lo)) / 10 AS w FROM e),
c AS (SELECT CAST(greatest(0, least(9, floor((v - lo) / w))) AS INT) AS bin, count(*) AS n FROM m, r GROUP BY 1), s AS (SELECT CAST(i AS INT) AS bin FROM range(10) t(i))
SELECT s.bin, round(lo + s.bin * w, 6) AS bin_start, round(lo + (s.bin + 1) * w, 6) AS bin_end, coalesce(n, 0) AS n FROM s CROSS JOIN r LEFT JOIN c ON s.bin = c.bin""")
def pool_histogram(spark, d):
    each = P.site_histograms(_by_site(spark, d, "measurement"), "site_id", "value_as_number", 10)
    return P.histogram(each, SITES, site="site").select("bin", *rounded("bin_start", "bin_end"), "n")


@query("""SELECT 'value_as_number' AS column_name, count(*) - count(value_as_number) AS numerator, count(*) AS denominator, round((count(*) - count(value_as_number)) / CAST(count(*) AS DOUBLE), 6) AS ratio
FROM measurement JOIN person ON measurement.person_id = person.person_id""")
def pool_missingness(spark, d):
    each = _by_site(spark, d, "measurement").groupBy("site_id").agg(F.lit("value_as_number").alias("column_name"), F.count_if(F.col("value_as_number").isNull()).alias("n_missing"), F.count("*").alias("n_total"))
    return P.ratio(each, ["column_name"], "n_missing", "n_total").select("column_name", "numerator", "denominator", *rounded("ratio"))


@query("""WITH p AS (SELECT avg(value_as_number) AS m FROM measurement JOIN person ON measurement.person_id = person.person_id GROUP BY measurement.person_id)
SELECT count(m) AS n, round(avg(m), 6) AS mean, round(stddev_samp(m), 6) AS sd FROM p""")
def pool_column_stats(spark, d):
    persons = _by_site(spark, d, "measurement").groupBy("site_id", "person_id").agg(F.avg("value_as_number").alias("m"))
    each = persons.groupBy("site_id").agg(F.count("m").alias("n"), F.avg("m").alias("mean"), F.var_samp("m").alias("variance"))
    return P.moments(each, []).select("n", *rounded("mean"), F.round(F.sqrt("variance"), 6).alias("sd"))


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, CASE WHEN count(DISTINCT site_id) = 3 THEN count(*) END AS n_records, CASE WHEN count(DISTINCT site_id) = 3 THEN count(DISTINCT p.person_id) END AS n_persons FROM {t} t JOIN person p ON t.person_id = p.person_id" for t in (*_CONCEPT, "death")))
def pool_coverage(spark, d):
    parts = [_by_site(spark, d, t).select(F.lit(t).alias("table_name"), "site_id", "person_id") for t in (*_CONCEPT, "death")]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    each = rows.groupBy("site_id", "table_name").agg(F.count("*").alias("n_records"), F.count_distinct("person_id").alias("n_persons"))
    return P.counts(each, ["table_name"], ["n_records", "n_persons"], SITES)


_LOCATED = " UNION ALL ".join(f"SELECT '{t}' AS table_name, {c} AS concept_id, site_id FROM {t} t JOIN person p ON t.person_id = p.person_id WHERE {c} IN (2001, 3001, 4001)" for t, c in _CONCEPT.items())


@query(f"WITH u AS ({_LOCATED}) SELECT table_name, concept_id, CASE WHEN count(DISTINCT site_id) = 3 THEN count(*) END AS n_records FROM u GROUP BY ALL")
def pool_locate(spark, d):
    out = None
    for t, c in _CONCEPT.items():
        part = _by_site(spark, d, t).where(F.col(c).isin(2001, 3001, 4001)).groupBy("site_id", F.lit(t).alias("table_name"), F.col(c).alias("concept_id")).agg(F.count("*").alias("n_records"))
        out = part if out is None else out.unionByName(part)
    return P.counts(out, ["table_name", "concept_id"], ["n_records"], SITES)


@query("""WITH o AS (SELECT avg(days_supply) AS v FROM drug_exposure JOIN person ON drug_exposure.person_id = person.person_id WHERE days_supply IS NOT NULL GROUP BY drug_exposure.person_id),
g AS (SELECT count(*) AS n, CAST(sum(floor((greatest(10.0, least(40.0, v)) - 10.0) / 30.0 * 1000 + 0.5)) AS BIGINT) AS sum_grid FROM o)
SELECT n, sum_grid, round(greatest(10, least(40, 10 + 30.0 * sum_grid / (n * 1000))), 6) AS value FROM g""")
def pool_privacy_mean(spark, d):
    rows = _by_site(spark, d, "drug_exposure")
    parts = [D.mean(rows.where(F.col("site_id") == s), "days_supply", 10.0, 40.0).withColumn("site_id", F.lit(s)) for s in range(SITES)]
    return P.released_mean(parts[0].unionByName(parts[1]).unionByName(parts[2]), 10.0, 40.0).select("n", "sum_grid", *rounded("value"))


_EVERY = " UNION ALL ".join(f"SELECT person_id, {c} AS concept_id FROM {t}" for t, c in _CONCEPT.items())


@query(f"WITH u AS ({_EVERY}) SELECT concept_id, count(DISTINCT person_id) AS n_persons, count(*) AS n_records FROM u GROUP BY concept_id HAVING count(DISTINCT person_id) >= 3 ORDER BY 3 DESC, 1 LIMIT 25")
def prevalence_of_all(spark, d):
    return E.prevalence_of_all({t: (view(spark, d, t), c) for t, c in _CONCEPT.items()}, "records", 25)


@query("""SELECT site_id AS stratum, gender_concept_id AS row_value, ethnicity_concept_id AS col_value, count(*) AS n FROM person GROUP BY ALL HAVING count(DISTINCT person_id) >= 3""")
def crosstab_slices(spark, d):
    return E.crosstab_slices(view(spark, d, "person"), "gender_concept_id", "ethnicity_concept_id", "site_id", "records")


@query("SELECT CAST(date_trunc('quarter', drug_exposure_start_date) AS DATE) AS period, count(*) AS n_records, count(DISTINCT person_id) AS n_persons FROM drug_exposure GROUP BY 1")
def date_counts_quarter(spark, d):
    return E.date_counts(view(spark, d, "drug_exposure"), "drug_exposure_start_date", "quarter")


@query("SELECT DISTINCT person_id AS subject_id FROM death")
def cohort_from_table(spark, d):
    return C.from_table(view(spark, d, "death"))


_SCOPED = "SELECT count(*) AS n_rows, count(DISTINCT person_id) AS n_persons FROM condition_occurrence WHERE person_id IN (SELECT subject_id FROM cohort WHERE cohort_definition_id = 1) {how} person_id IN (SELECT subject_id FROM cohort WHERE cohort_definition_id = 2)"


def _scoped(spark, d, how):
    cohort = view(spark, d, "cohort")
    return E.table_stats(C.within(view(spark, d, "condition_occurrence"), C.scope([cohort.where(F.col("cohort_definition_id") == i) for i in (1, 2)], how)))


@query(_SCOPED.replace("{how}", "OR"))
def scope_union(spark, d):
    return _scoped(spark, d, "union")


@query(_SCOPED.replace("{how}", "AND"))
def scope_intersect(spark, d):
    return _scoped(spark, d, "intersect")


@query("SELECT cohort_definition_id, subject_id, cohort_start_date, cohort_end_date FROM cohort WHERE cohort_definition_id = 2")
def cohort_kept(spark, d):
    path = f"{S.shared_root(spark)}/medloom/cohorts-{uuid.uuid4().hex}"
    S.write_cohort(view(spark, d, "cohort"), path)
    return S.read_cohort(spark, path, 2)


_INTERVALS = index_sql() + """, j AS (SELECT subject_id, episode_id, drug_concept_id AS concept_id, CAST(date_diff('day', cohort_start_date, drug_exposure_start_date) AS INT) AS s, CAST(date_diff('day', cohort_start_date, drug_exposure_end_date) AS INT) AS e
  FROM idx JOIN drug_exposure ON subject_id = person_id), k AS (SELECT *, row_number() OVER (PARTITION BY subject_id, episode_id{also} ORDER BY {order}, e, concept_id, s) AS rn FROM j WHERE s <= 365 AND e >= -365)
SELECT subject_id, episode_id, concept_id, s AS start_days_from_index, e AS end_days_from_index FROM k WHERE rn <= {n}"""


def _intervals(spark, d):
    return T.intervals(index(spark, d), view(spark, d, "drug_exposure"), "drug_exposure_start_date", "drug_exposure_end_date", "drug_concept_id", "overlaps", (-365, 365))


@query(_INTERVALS.replace("{also}", "").replace("{order}", "abs(s - 30)").replace("{n}", "2"))
def intervals_nearest(spark, d):
    return T.select_intervals(_intervals(spark, d), "nearest", 2, 30)


@query(_INTERVALS.replace("{also}", ", concept_id").replace("{order}", "s DESC").replace("{n}", "1"))
def intervals_last_by_concept(spark, d):
    return T.select_intervals(_intervals(spark, d), "last", by_concept=True)


@query("SELECT person_id, " + ", ".join(f"count(CASE WHEN measurement_concept_id = {c} THEN 1 END) AS count_{c}, round(avg(CASE WHEN measurement_concept_id = {c} THEN value_as_number END), 6) AS mean_value_{c}" for c in (4001, 4003)) + " FROM measurement WHERE measurement_concept_id IN (4001, 4003) GROUP BY person_id")
def feature_block(spark, d):
    def make(when):
        all_of = R.reducers("value_as_number", "measurement_date", "measurement_id", "measurement_concept_id", when=when)
        return {k: all_of[k] for k in ("count", "mean_value")}

    out = R.block(view(spark, d, "measurement"), ["person_id"], "measurement_concept_id", (4001, 4003), make)
    return out.select("person_id", "count_4001", *rounded("mean_value_4001"), "count_4003", *rounded("mean_value_4003"))


@query(index_sql() + """, j AS (SELECT subject_id, episode_id, date_diff('day', cohort_start_date, condition_start_date) AS day FROM idx JOIN condition_occurrence ON subject_id = person_id)
SELECT subject_id, episode_id, count(CASE WHEN day BETWEEN -365 AND -1 THEN 1 END) AS n_before, count(CASE WHEN day BETWEEN 0 AND 90 THEN 1 END) AS n_after FROM j WHERE day BETWEEN -365 AND 90 GROUP BY ALL""")
def feature_windows(spark, d):
    rows = T.around(index(spark, d), view(spark, d, "condition_occurrence"), "condition_start_date", -365, 90)
    inside = lambda a, b: F.count(F.when(F.col("day").between(a, b), 1))
    return R.features(rows, ["subject_id", "episode_id"], {"n_before": inside(-365, -1), "n_after": inside(0, 90)})


@query("SELECT visit_occurrence_id, CAST(date_trunc('week', visit_start_date) AS DATE) AS visit_start_date, CAST(date_trunc('week', visit_end_date) AS DATE) AS visit_end_date FROM visit_occurrence")
def dates_binned_week(spark, d):
    rows = view(spark, d, "visit_occurrence").select("visit_occurrence_id", "visit_start_date", "visit_end_date")
    return H.dated(rows, ["visit_start_date", "visit_end_date"], "binned", width="week")
