"""Queries of the clinical operators, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import catalog_people, catalog_results, catalog_sites, catalog_vocabulary  # noqa: F401  (they add their queries)
from .cdm.fixture import sql, view
from .functions.dates import complete_months, week
from .operators import cohort as C
from .operators import explore as E
from .operators import features as R
from .operators import people as H
from .operators import pooling as P
from .operators import privacy as D
from .operators import survival as S
from .operators import temporal as T
from .operators import verbs as V
from .operators import vocabulary as O
from .registry import QUERIES, SQL, index, index_sql, query, rounded
from .sources.tables import read_staged, shared_root, write_staged

@query("SELECT count(*) AS n_rows, count(DISTINCT person_id) AS n_persons FROM measurement")
def table_stats(spark, d):
    return E.table_stats(view(spark, d, "measurement"))


@query("""WITH p AS (SELECT person_id, count(*) AS n, count(value_as_number) AS s, avg(value_as_number) AS m FROM measurement GROUP BY person_id)
SELECT CAST(sum(n) AS BIGINT) AS n, count(*) AS n_persons, CAST(sum(n) - sum(s) AS BIGINT) AS n_missing, (SELECT count(DISTINCT value_as_number) FROM measurement) AS n_distinct, round(avg(m), 6) AS mean, round(stddev_samp(m), 6) AS sd FROM p""")
def column_stats(spark, d):
    return E.column_stats(view(spark, d, "measurement"), "value_as_number").select("n", "n_persons", "n_missing", "n_distinct", *rounded("mean", "sd"))


_TABLES = ("visit_occurrence", "condition_occurrence", "procedure_occurrence", "drug_exposure", "measurement", "death")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_records, count(DISTINCT person_id) AS n_persons FROM {t}" for t in _TABLES))
def domain_coverage(spark, d):
    return E.coverage({t: view(spark, d, t) for t in _TABLES})


_PERSON = ("gender_concept_id", "month_of_birth", "day_of_birth", "ethnicity_concept_id")


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_total, count(*) - count({c}) AS n_missing, round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 6) AS missing_rate FROM person" for c in _PERSON))
def missingness(spark, d):
    return E.missingness(view(spark, d, "person"), _PERSON).select("column_name", "n_total", "n_missing", *rounded("missing_rate"))


@query("""SELECT value_as_concept_id AS value, CAST(floor(count(*) / 5) * 5 AS BIGINT) AS n, CAST(floor(count(DISTINCT person_id) / 5) * 5 AS BIGINT) AS n_persons
FROM measurement GROUP BY value_as_concept_id HAVING count(DISTINCT person_id) >= 3 ORDER BY 2 DESC, 1 LIMIT 20""")
def value_counts(spark, d):
    return E.value_counts(view(spark, d, "measurement"), "value_as_concept_id")


@query("SELECT gender_concept_id AS row_value, race_concept_id AS col_value, count(DISTINCT person_id) AS n FROM person GROUP BY ALL HAVING count(DISTINCT person_id) >= 3")
def crosstab(spark, d):
    return E.crosstab(view(spark, d, "person"), "gender_concept_id", "race_concept_id")


@query("""SELECT has_a, has_b, count(*) AS n_persons FROM (SELECT person_id, max(CASE WHEN condition_concept_id = 2001 THEN 1 ELSE 0 END) AS has_a, max(CASE WHEN condition_concept_id = 2002 THEN 1 ELSE 0 END) AS has_b
FROM condition_occurrence GROUP BY person_id) x GROUP BY ALL""")
def comorbidity(spark, d):
    return E.comorbidity(view(spark, d, "condition_occurrence"), "condition_concept_id", 2001, 2002)


@query("""SELECT condition_concept_id AS concept_id, count(DISTINCT person_id) AS n_persons, count(*) AS n_records FROM condition_occurrence GROUP BY 1 HAVING count(DISTINCT person_id) >= 3 ORDER BY 2 DESC, 1 LIMIT 10 OFFSET 5""")
def concept_prevalence(spark, d):
    return E.prevalence(view(spark, d, "condition_occurrence"), "condition_concept_id", top=10, offset=5)


_HIST = """WITH v AS (SELECT value_as_number AS v FROM measurement WHERE value_as_number IS NOT NULL), e AS (SELECT quantile_cont(v, 0.05) AS lo, (quantile_cont(v, 0.95) - quantile_cont(v, 0.05)) / {n} AS w FROM v),
c AS (SELECT CAST(greatest(0, least({n} - 1, floor((v - lo) / w))) AS INT) AS bin, count(*) AS n FROM v, e GROUP BY 1), s AS (SELECT CAST(i AS INT) AS bin FROM range({n}) t(i))
SELECT s.bin, round(lo + s.bin * w, 6) AS bin_start, round(lo + (s.bin + 1) * w, 6) AS bin_end, coalesce(c.n, 0) AS n FROM s CROSS JOIN e LEFT JOIN c ON s.bin = c.bin"""


@query(_HIST.replace("{n}", "20"))
def value_histogram(spark, d):
    return E.histogram(view(spark, d, "measurement"), "value_as_number").select("bin", *rounded("bin_start", "bin_end"), "n")


@query(" UNION ALL ".join(f"SELECT CAST({p} AS DOUBLE) AS prob, round(quantile_cont(value_as_number, {p}), 2) AS value FROM measurement" for p in (0.05, 0.25, 0.5, 0.75, 0.95)))
def value_quantiles(spark, d):
    return E.quantiles(view(spark, d, "measurement"), "value_as_number")


@query("SELECT CAST(date_trunc('month', condition_start_date) AS DATE) AS period, count(*) AS n_records, count(DISTINCT person_id) AS n_persons FROM condition_occurrence GROUP BY 1")
def date_counts(spark, d):
    return E.date_counts(view(spark, d, "condition_occurrence"), "condition_start_date", "month")


@query("""SELECT 'condition_occurrence' AS table_name, 'condition_concept_id' AS concept_column, condition_concept_id AS concept_id, count(*) AS n_records, count(DISTINCT person_id) AS n_persons FROM condition_occurrence WHERE condition_concept_id IN (2001, 2007, 3001) GROUP BY 3
UNION ALL SELECT 'drug_exposure', 'drug_concept_id', drug_concept_id, count(*), count(DISTINCT person_id) FROM drug_exposure WHERE drug_concept_id IN (2001, 2007, 3001) GROUP BY 3""")
def concept_locate(spark, d):
    return E.locate({"condition_occurrence": (view(spark, d, "condition_occurrence"), "condition_concept_id"), "drug_exposure": (view(spark, d, "drug_exposure"), "drug_concept_id")}, [2001, 2007, 3001])


@query("""WITH m AS (SELECT person_id, avg(value_as_number) AS v FROM measurement WHERE value_as_number IS NOT NULL GROUP BY person_id), e AS (SELECT quantile_cont(v, 0.05) AS lo, (quantile_cont(v, 0.95) - quantile_cont(v, 0.05)) / 4 AS w FROM m),
c AS (SELECT CAST(greatest(0, least(3, floor((v - lo) / w))) AS INT) AS bin, count(*) AS n FROM m, e GROUP BY 1), s AS (SELECT CAST(i AS INT) AS bin FROM range(4) t(i)), h AS (SELECT s.bin, coalesce(n, 0) AS n FROM s LEFT JOIN c ON s.bin = c.bin)
SELECT h.bin, round(lo + h.bin * w, 6) AS bin_start, round(lo + (h.bin + 1) * w, 6) AS bin_end FROM h, e WHERE (SELECT min(n) FROM h) >= 3""")
def safe_cutpoints(spark, d):
    return E.safe_cutpoints(view(spark, d, "measurement"), "value_as_number", 4).select("bin", *rounded("bin_start", "bin_end"))


@query(index_sql() + "SELECT subject_id, episode_id, cohort_start_date, cohort_end_date FROM idx")
def cohort_index_first(spark, d):
    return index(spark, d).select("subject_id", "episode_id", "cohort_start_date", "cohort_end_date")


@query(index_sql("last", 90) + "SELECT subject_id, episode_id, cohort_start_date, cohort_end_date FROM idx")
def cohort_index_last_offset(spark, d):
    return index(spark, d, "last", 90).select("subject_id", "episode_id", "cohort_start_date", "cohort_end_date")


@query(index_sql("all") + "SELECT subject_id, episode_id, cohort_start_date, cohort_end_date FROM idx")
def cohort_index_all(spark, d):
    return index(spark, d, "all").select("subject_id", "episode_id", "cohort_start_date", "cohort_end_date")


def _setop(how: str, word: str):
    def f(spark, d):
        other = view(spark, d, "condition_occurrence").where("condition_concept_id = 2003").select(F.col("person_id").alias("subject_id"))
        return C.combine(index(spark, d), other, how)

    f.__name__ = f"cohort_{how}"
    query(index_sql() + f"SELECT subject_id FROM idx {word} SELECT person_id FROM condition_occurrence WHERE condition_concept_id = 2003")(f)


_setop("union", "UNION")
_setop("intersect", "INTERSECT")
_setop("setdiff", "EXCEPT")

_HAS = index_sql() + "SELECT subject_id, episode_id FROM idx i WHERE {test} (SELECT count(*) FROM condition_occurrence c WHERE c.person_id = i.subject_id AND c.condition_concept_id IN (2001, 2002, 2003) AND date_diff('day', i.cohort_start_date, c.condition_start_date) BETWEEN -365 AND 365) {op}"


def _three(spark, d) -> DataFrame:
    return view(spark, d, "condition_occurrence").where(F.col("condition_concept_id").isin(2001, 2002, 2003))


@query(_HAS.replace("{test}", "").replace("{op}", ">= 1"))
def filter_has_concept(spark, d):
    return C.with_count(index(spark, d), _three(spark, d), "condition_start_date", (-365, 365)).select("subject_id", "episode_id")


@query(_HAS.replace("{test}", "").replace("{op}", ">= 2"))
def filter_concept_count(spark, d):
    return C.with_count(index(spark, d), _three(spark, d), "condition_start_date", (-365, 365), 2).select("subject_id", "episode_id")


@query(_HAS.replace("{test}", "").replace("{op}", "= 0"))
def filter_not_has_concept(spark, d):
    return C.with_count(index(spark, d), _three(spark, d), "condition_start_date", (-365, 365), 0).select("subject_id", "episode_id")


@query(index_sql() + "SELECT subject_id, episode_id FROM idx i JOIN person p ON i.subject_id = p.person_id WHERE gender_concept_id = 8532 AND year(cohort_start_date) - year_of_birth BETWEEN 20 AND 50 AND date_diff('day', obs_start, cohort_start_date) >= 100 AND date_diff('day', cohort_start_date, obs_end) >= 365")
def filter_population(spark, d):
    return C.eligible(index(spark, d), view(spark, d, "person"), 8532, (20, 50), 100, 365).select("subject_id", "episode_id")


@query("""SELECT measurement_id, person_id FROM measurement WHERE (measurement_concept_id IN (4001, 4003) AND value_as_number >= 100 AND value_as_number < 300) OR (measurement_concept_id NOT IN (4001, 4003) AND value_as_number IS NULL)""")
def filter_row_tree(spark, d):
    both = {"and": [{"var": "measurement_concept_id", "op": "in", "value": [4001, 4003]}, {"var": "value_as_number", "op": "value_bin", "value": [100, 300]}]}
    none = {"and": [{"var": "measurement_concept_id", "op": "not_in", "value": [4001, 4003]}, {"var": "value_as_number", "op": "is_null"}]}
    return V.where(view(spark, d, "measurement"), {"or": [both, none]}).select("measurement_id", "person_id")


@query("""SELECT measurement_id AS id, v.person_id AS person, gender_concept_id AS sex FROM (SELECT * FROM measurement WHERE measurement_date BETWEEN DATE '1998-02-01' AND DATE '1998-03-31') v JOIN person p ON v.person_id = p.person_id""")
def verbs_select_merge(spark, d):
    rows = view(spark, d, "measurement").where(F.col("measurement_date").between("1998-02-01", "1998-03-31"))
    return V.select(V.merge(rows, view(spark, d, "person"), ["person_id"]), {"id": "measurement_id", "person": "person_id", "sex": "gender_concept_id"})


@query("""SELECT concept_id FROM (SELECT descendant_concept_id AS concept_id FROM concept_ancestor WHERE ancestor_concept_id IN (1901, 1902) UNION SELECT 1901 UNION SELECT 1902) x
WHERE concept_id NOT IN (SELECT descendant_concept_id FROM concept_ancestor WHERE ancestor_concept_id = 2001 UNION SELECT 2001)""")
def concept_set(spark, d):
    return C.concept_set([1901, 1902], view(spark, d, "concept_ancestor"), True, [2001])


@query("SELECT concept_id, concept_name FROM concept WHERE lower(concept_name) LIKE '%group%' ORDER BY concept_id LIMIT 5")
def concept_search(spark, d):
    return O.search(view(spark, d, "concept"), "Group", standard_only=False, limit=5).select("concept_id", "concept_name")


_FEATURES = ("latest_value", "first_value", "mean_value", "min_value", "max_value", "sum_value", "sd_value", "cv_value", "slope_value")


@query("""SELECT person_id, true AS boolean, count(*) AS count, round(arg_max(value_as_number, (measurement_date, measurement_id)) FILTER (WHERE value_as_number IS NOT NULL), 6) AS latest_value,
round(arg_min(value_as_number, (measurement_date, measurement_id)) FILTER (WHERE value_as_number IS NOT NULL), 6) AS first_value, round(avg(value_as_number), 6) AS mean_value, round(min(value_as_number), 6) AS min_value,
round(max(value_as_number), 6) AS max_value, round(sum(value_as_number), 6) AS sum_value, count(DISTINCT measurement_concept_id) AS n_distinct, round(stddev_samp(value_as_number), 6) AS sd_value,
round(stddev_samp(value_as_number) / nullif(avg(value_as_number), 0) * 100, 6) AS cv_value, CASE WHEN count(value_as_number) > 1 AND count(DISTINCT CASE WHEN value_as_number IS NOT NULL THEN measurement_date END) > 1 THEN round(regr_slope(value_as_number, date_diff('day', DATE '1970-01-01', measurement_date)), 6) END AS slope_value,
count(CASE WHEN value_as_number > range_high THEN 1 END) AS abnormal_high, count(CASE WHEN value_as_number < range_low THEN 1 END) AS abnormal_low FROM measurement GROUP BY person_id""")
def feature_reducers(spark, d):
    m = view(spark, d, "measurement")
    specs = R.reducers("value_as_number", "measurement_date", "measurement_id", "measurement_concept_id", "range_low", "range_high")
    out = R.features(m, ["person_id"], specs)
    return out.select("person_id", "boolean", "count", *rounded(*_FEATURES), "n_distinct", "abnormal_high", "abnormal_low")


@query("""SELECT p.person_id, count(m.measurement_id) > 0 AS boolean, count(m.measurement_id) AS count, round(avg(value_as_number), 6) AS mean_value FROM person p LEFT JOIN measurement m ON p.person_id = m.person_id AND measurement_concept_id = 4003 GROUP BY p.person_id""")
def feature_roster(spark, d):
    specs = R.reducers("value_as_number", "measurement_date", "measurement_id", "measurement_concept_id", when=F.col("measurement_concept_id") == 4003)
    found = R.features(view(spark, d, "measurement"), ["person_id"], {k: specs[k] for k in ("boolean", "count", "mean_value")})
    return R.on_roster(view(spark, d, "person").select("person_id"), found, ["person_id"]).select("person_id", "boolean", "count", *rounded("mean_value"))


@query("""WITH g AS (SELECT person_id, date_diff('day', lag(measurement_date) OVER (PARTITION BY person_id ORDER BY measurement_date, measurement_id), measurement_date) AS g FROM measurement)
SELECT person_id, CAST(max(g) AS INT) AS gap_max_days, round(avg(g), 6) AS gap_mean_days FROM g GROUP BY person_id""")
def feature_gaps(spark, d):
    return R.gaps(view(spark, d, "measurement"), ["person_id"], "measurement_date", "measurement_id").select("person_id", "gap_max_days", *rounded("gap_mean_days"))


@query("""SELECT person_id, round(avg(date_diff('day', s, e)), 6) AS duration_mean, CAST(sum(date_diff('day', s, e)) AS BIGINT) AS duration_sum, CAST(max(date_diff('day', s, e)) AS INT) AS duration_max
FROM (SELECT person_id, condition_start_date AS s, coalesce(condition_end_date, condition_start_date) AS e FROM condition_occurrence) x GROUP BY person_id""")
def feature_durations(spark, d):
    return R.durations(view(spark, d, "condition_occurrence"), ["person_id"], "condition_start_date", "condition_end_date").select("person_id", *rounded("duration_mean"), "duration_sum", "duration_max")


@query("""SELECT person_id, CAST(date_diff('day', m, DATE '2002-01-15') AS INT) AS days_since, CAST((2002 * 12 + 1) - (year(m) * 12 + month(m)) - CASE WHEN 15 < day(m) THEN 1 ELSE 0 END AS INT) AS months_since FROM (SELECT person_id, max(condition_start_date) AS m FROM condition_occurrence GROUP BY person_id) x""")
def feature_time_since(spark, d):
    last = view(spark, d, "condition_occurrence").groupBy("person_id").agg(F.max("condition_start_date").alias("m"))
    ref = F.lit("2002-01-15").cast("date")
    return last.select("person_id", F.datediff(ref, "m").alias("days_since"), complete_months(F.col("m"), ref).alias("months_since"))


@query(index_sql() + """SELECT subject_id, episode_id, cohort_start_date, concat(CAST(CAST(floor((year(cohort_start_date) - year_of_birth) / 10.0) * 10 AS BIGINT) AS VARCHAR), '-', CAST(CAST(floor((year(cohort_start_date) - year_of_birth) / 10.0) * 10 AS BIGINT) + 9 AS VARCHAR)) AS age_group,
CAST(date_diff('day', obs_start, cohort_start_date) AS INT) AS prior_observation, CAST(date_diff('day', cohort_start_date, obs_end) AS INT) AS future_observation FROM idx JOIN person ON subject_id = person_id""")
def output_baseline(spark, d):
    return H.baseline(index(spark, d), view(spark, d, "person"))


_AROUND = index_sql() + ", ev AS (SELECT i.subject_id, i.episode_id, c.condition_occurrence_id, c.condition_concept_id, c.condition_start_date, CAST(date_diff('day', i.cohort_start_date, c.condition_start_date) AS INT) AS day FROM idx i JOIN condition_occurrence c ON i.subject_id = c.person_id WHERE date_diff('day', i.cohort_start_date, c.condition_start_date) BETWEEN -180 AND 180) "


def _around(spark, d) -> DataFrame:
    return T.around(index(spark, d), view(spark, d, "condition_occurrence"), "condition_start_date", -180, 180)


@query(_AROUND + "SELECT subject_id, episode_id, condition_occurrence_id, day, CAST(date_trunc('week', condition_start_date) AS DATE) AS week FROM ev")
def output_long_window(spark, d):
    return _around(spark, d).select("subject_id", "episode_id", "condition_occurrence_id", "day", week(F.col("condition_start_date")).alias("week"))


@query(_AROUND + "SELECT subject_id, episode_id, condition_occurrence_id FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, episode_id, condition_concept_id ORDER BY condition_start_date, condition_occurrence_id) AS rn FROM ev) x WHERE rn <= 2")
def event_select_first(spark, d):
    return T.select(_around(spark, d), ["subject_id", "episode_id", "condition_concept_id"], "condition_start_date", "condition_occurrence_id", "first", 2).select("subject_id", "episode_id", "condition_occurrence_id")


@query(_AROUND + "SELECT subject_id, episode_id, condition_occurrence_id FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, episode_id ORDER BY abs(day), condition_occurrence_id) AS rn FROM ev) x WHERE rn <= 1")
def event_select_nearest(spark, d):
    return T.select(_around(spark, d), ["subject_id", "episode_id"], "day", "condition_occurrence_id", "nearest", 1).select("subject_id", "episode_id", "condition_occurrence_id")


@query("""WITH l AS (SELECT *, CASE WHEN date_diff('day', lag(condition_start_date) OVER (PARTITION BY person_id ORDER BY condition_start_date, condition_occurrence_id), condition_start_date) <= 30 THEN 0 ELSE 1 END AS f FROM condition_occurrence),
c AS (SELECT *, sum(f) OVER (PARTITION BY person_id ORDER BY condition_start_date, condition_occurrence_id ROWS UNBOUNDED PRECEDING) AS ch FROM l),
n AS (SELECT *, row_number() OVER (PARTITION BY person_id, ch ORDER BY condition_start_date, condition_occurrence_id) AS rn FROM c) SELECT person_id, condition_occurrence_id FROM n WHERE rn = 1""")
def event_min_gap(spark, d):
    return T.min_gap(view(spark, d, "condition_occurrence"), ["person_id"], "condition_start_date", "condition_occurrence_id", 30).select("person_id", "condition_occurrence_id")


@query(_AROUND + "SELECT subject_id, episode_id, CAST(floor((day + 180) / 30.0) AS INT) AS time_id, condition_concept_id AS covariate_id, count(*) AS covariate_value FROM ev GROUP BY ALL")
def temporal_covariates(spark, d):
    return T.temporal_covariates(index(spark, d), view(spark, d, "condition_occurrence"), "condition_start_date", "condition_concept_id", -180, 180, 30)


@query(index_sql() + """, b AS (SELECT CAST(i AS INT) AS time_id, CAST(-180 + i * 50 AS INT) AS start_day, CAST(least(180, -180 + i * 50 + 49) AS INT) AS end_day FROM range(8) t(i)),
r AS (SELECT subject_id, episode_id, b.*, CAST(greatest(start_day, date_diff('day', cohort_start_date, obs_start)) AS INT) AS obs_start_day, CAST(least(end_day, date_diff('day', cohort_start_date, obs_end)) AS INT) AS obs_end_day FROM idx, b)
SELECT *, CAST(obs_end_day - obs_start_day + 1 AS INT) AS days_observed FROM r WHERE obs_start_day <= obs_end_day""")
def person_period(spark, d):
    return T.person_periods(index(spark, d), -180, 180, 50)


def _interval(match: str, test: str, **how):
    def f(spark, d):
        return T.intervals(index(spark, d), view(spark, d, "condition_occurrence"), "condition_start_date", "condition_end_date", "condition_concept_id", match, **how)

    f.__name__ = f"intervals_{match}"
    query(index_sql() + f""", j AS (SELECT subject_id, episode_id, condition_concept_id AS concept_id, CAST(date_diff('day', cohort_start_date, condition_start_date) AS INT) AS start_days_from_index,
      CAST(date_diff('day', cohort_start_date, coalesce(condition_end_date, condition_start_date)) AS INT) AS end_days_from_index FROM idx JOIN condition_occurrence ON subject_id = person_id) SELECT * FROM j WHERE {test}""")(f)


_interval("overlaps", "start_days_from_index <= 100 AND end_days_from_index >= -100", window=(-100, 100))
_interval("starts_in", "start_days_from_index BETWEEN -100 AND 100", window=(-100, 100))
_interval("ends_in", "end_days_from_index BETWEEN -100 AND 100", window=(-100, 100))
_interval("active_at", "start_days_from_index <= 10 AND end_days_from_index >= 10", at=10)


@query("WITH f AS (SELECT *, row_number() OVER (PARTITION BY person_id, measurement_concept_id ORDER BY measurement_date, measurement_id) AS rn FROM measurement) SELECT person_id, " + ", ".join(f"max(CASE WHEN measurement_concept_id = {c} THEN value_as_number END) AS c_{c}" for c in (4001, 4002, 4003)) + " FROM f WHERE rn = 1 AND measurement_concept_id IN (4001, 4002, 4003) GROUP BY person_id")
def output_wide(spark, d):
    first = T.select(view(spark, d, "measurement"), ["person_id", "measurement_concept_id"], "measurement_date", "measurement_id")
    return T.wide(first, ["person_id"], "measurement_concept_id", [4001, 4002, 4003], "value_as_number")


@query("SELECT person_id, drug_concept_id AS covariate_id, count(*) AS covariate_value FROM drug_exposure GROUP BY ALL")
def output_sparse(spark, d):
    return T.sparse(view(spark, d, "drug_exposure"), ["person_id"], "drug_concept_id")


_RISK = index_sql() + """, risk AS (SELECT subject_id, episode_id, cohort_start_date, 0 AS entry_day, CAST(date_diff('day', cohort_start_date, least(cohort_end_date, coalesce(death_date, cohort_end_date), cohort_start_date + 730)) AS INT) AS exit_day FROM idx LEFT JOIN death ON subject_id = person_id),
o AS (SELECT person_id, condition_start_date AS d, 'x' AS outcome_name FROM condition_occurrence WHERE condition_concept_id = 2001 UNION ALL SELECT person_id, condition_start_date, 'y' FROM condition_occurrence WHERE condition_concept_id = 2002),
e AS (SELECT r.subject_id, r.episode_id, outcome_name, CAST(date_diff('day', cohort_start_date, d) AS INT) AS day FROM risk r JOIN o ON subject_id = person_id WHERE exit_day >= 0 AND date_diff('day', cohort_start_date, d) BETWEEN entry_day AND exit_day) """


def _risk(spark, d) -> DataFrame:
    return S.censored(index(spark, d), 0, 730, view(spark, d, "death"))


def _outcomes(spark, d) -> dict:
    c = view(spark, d, "condition_occurrence")
    return {"x": (c.where("condition_concept_id = 2001"), "condition_start_date"), "y": (c.where("condition_concept_id = 2002"), "condition_start_date")}


_FIRST = "f AS (SELECT r.subject_id, r.episode_id, r.exit_day, min((day, outcome_name)) AS f FROM risk r LEFT JOIN e ON r.subject_id = e.subject_id AND r.episode_id = e.episode_id {w} WHERE exit_day >= 0 GROUP BY ALL)"


@query(_RISK + ", g AS (SELECT r.subject_id, r.episode_id, r.exit_day, min(day) AS day FROM risk r LEFT JOIN e ON r.subject_id = e.subject_id AND r.episode_id = e.episode_id AND outcome_name = 'x' WHERE exit_day >= 0 GROUP BY ALL) SELECT subject_id, episode_id, CASE WHEN day IS NULL THEN 0 ELSE 1 END AS event, CAST(coalesce(day, exit_day) AS INT) AS time_to_event_days FROM g")
def survival_single(spark, d):
    return S.time_to_event(_risk(spark, d), {"x": _outcomes(spark, d)["x"]}).select("subject_id", "episode_id", "event", "time_to_event_days")


@query(_RISK + ", g AS (SELECT subject_id, episode_id, day, outcome_name, row_number() OVER (PARTITION BY subject_id, episode_id ORDER BY day, outcome_name) AS rn FROM e) SELECT r.subject_id, r.episode_id, CASE WHEN day IS NULL THEN 0 ELSE 1 END AS event, outcome_name, CAST(coalesce(day, exit_day) AS INT) AS time_to_event_days FROM risk r LEFT JOIN g ON r.subject_id = g.subject_id AND r.episode_id = g.episode_id AND rn = 1 WHERE exit_day >= 0")
def survival_competing_risk(spark, d):
    return S.time_to_event(_risk(spark, d), _outcomes(spark, d))


@query(_RISK + ", u AS (SELECT DISTINCT subject_id, episode_id, outcome_name, day FROM e) SELECT subject_id, episode_id, outcome_name, CAST(row_number() OVER (PARTITION BY subject_id, episode_id, outcome_name ORDER BY day) AS INT) AS event_number, day AS event_days_from_index FROM u")
def survival_recurrent(spark, d):
    return S.recurrent(_risk(spark, d), _outcomes(spark, d))


@query(_RISK + """, s AS (SELECT subject_id, episode_id, day, max(event) AS event FROM (SELECT subject_id, episode_id, day, 1 AS event FROM e WHERE outcome_name = 'x' UNION ALL SELECT subject_id, episode_id, exit_day, 0 FROM risk WHERE exit_day >= 0) q GROUP BY ALL)
SELECT subject_id, episode_id, CAST(row_number() OVER (PARTITION BY subject_id, episode_id ORDER BY day) AS INT) AS interval_number, CAST(coalesce(lag(day) OVER (PARTITION BY subject_id, episode_id ORDER BY day), 0) AS INT) AS interval_start_days, day AS interval_end_days, event FROM s""")
def survival_counting_process(spark, d):
    return S.counting_process(_risk(spark, d), *_outcomes(spark, d)["x"])


@query(_RISK + """, g AS (SELECT r.subject_id, r.episode_id, r.exit_day, min(day) AS day FROM risk r LEFT JOIN e ON r.subject_id = e.subject_id AND r.episode_id = e.episode_id AND outcome_name = 'x' WHERE exit_day >= 0 GROUP BY ALL),
t AS (SELECT coalesce(day, exit_day) AS time, count(*) AS n, count(day) AS events FROM g GROUP BY 1), k AS (SELECT time, CAST(sum(n) OVER (ORDER BY time DESC) AS BIGINT) AS at_risk, events FROM t)
SELECT CAST(time AS INT) AS time, at_risk, events, round(product(1 - events / CAST(at_risk AS DOUBLE)) OVER (ORDER BY time ROWS UNBOUNDED PRECEDING), 6) AS survival FROM k WHERE events > 0""")
def kaplan_meier(spark, d):
    times = S.time_to_event(_risk(spark, d), {"x": _outcomes(spark, d)["x"]})
    return S.kaplan_meier(times, "time_to_event_days", "event").select("time", "at_risk", "events", *rounded("survival"))


@query(_RISK + """, x AS (SELECT subject_id, episode_id, min(day) AS dx FROM e WHERE outcome_name = 'x' AND day > 0 GROUP BY ALL),
y AS (SELECT subject_id, episode_id, min(day) AS dy FROM e WHERE outcome_name = 'y' AND day > 0 GROUP BY ALL), z AS (SELECT r.subject_id, r.episode_id, exit_day, dx, dy FROM risk r LEFT JOIN x USING (subject_id, episode_id) LEFT JOIN y USING (subject_id, episode_id) WHERE exit_day >= 0),
a AS (SELECT *, CASE WHEN dx IS NOT NULL AND (dy IS NULL OR dx <= dy) THEN dx END AS tx, CASE WHEN dy IS NOT NULL AND (dx IS NULL OR dy < dx) THEN dy END AS ty FROM z),
q AS (SELECT subject_id, episode_id, 'start' AS from_state, 'x' AS to_state, 0 AS t_start, coalesce(tx, ty, exit_day) AS t_stop, CASE WHEN tx IS NULL THEN 0 ELSE 1 END AS status FROM a UNION ALL SELECT subject_id, episode_id, 'start', 'y', 0, coalesce(tx, ty, exit_day), CASE WHEN ty IS NULL THEN 0 ELSE 1 END FROM a
UNION ALL SELECT a.subject_id, a.episode_id, 'x', 'y', tx, coalesce(min(e.day), max(a.exit_day)), CASE WHEN min(e.day) IS NULL THEN 0 ELSE 1 END FROM a LEFT JOIN e ON a.subject_id = e.subject_id AND a.episode_id = e.episode_id AND e.outcome_name = 'y' AND e.day > a.tx WHERE tx IS NOT NULL GROUP BY a.subject_id, a.episode_id, tx)
SELECT subject_id, episode_id, from_state, to_state, CAST(t_start AS INT) AS t_start, CAST(t_stop AS INT) AS t_stop, status FROM q WHERE t_stop > t_start""")
def survival_multi_state(spark, d):
    risk = _risk(spark, d)
    e = S._at_risk(risk, _outcomes(spark, d)).withColumnRenamed("outcome_name", "state")
    return S.multi_state(risk, e, ["start", "x", "y"], [[None, 1, 2], [None, None, 3], [None, None, None]])


_SITE = "SELECT site_id, condition_concept_id, count(*) AS n FROM condition_occurrence c JOIN person p ON c.person_id = p.person_id GROUP BY ALL"


def _by_site(spark, d, table: str) -> DataFrame:
    return view(spark, d, table).join(view(spark, d, "person").select("person_id", "site_id"), "person_id")


@query(f"WITH s AS ({_SITE}) SELECT condition_concept_id, CASE WHEN count(n) = 3 THEN CAST(sum(n) AS BIGINT) END AS n FROM s GROUP BY condition_concept_id")
def pool_counts(spark, d):
    g = _by_site(spark, d, "condition_occurrence").groupBy("site_id", "condition_concept_id").agg(F.count("*").alias("n"))
    return P.counts(g, ["condition_concept_id"], ["n"], 3)


@query(f"WITH s AS ({_SITE}) SELECT condition_concept_id, CAST(sum(n) AS BIGINT) AS n FROM s GROUP BY 1 HAVING count(*) = 3 ORDER BY 2 DESC, 1 LIMIT 10")
def pool_top_k(spark, d):
    g = _by_site(spark, d, "condition_occurrence").groupBy("site_id", "condition_concept_id").agg(F.count("*").alias("n"))
    return P.top(g, "condition_concept_id", "n", 3, 10)


@query("SELECT measurement_concept_id, count(value_as_number) AS n, round(avg(value_as_number), 6) AS mean, round(var_samp(value_as_number), 4) AS variance FROM measurement GROUP BY 1")
def pool_moments(spark, d):
    g = _by_site(spark, d, "measurement").groupBy("site_id", "measurement_concept_id").agg(F.count("value_as_number").alias("n"), F.avg("value_as_number").alias("mean"), F.var_samp("value_as_number").alias("variance"))
    out = P.moments(g, ["measurement_concept_id"])
    return out.select("measurement_concept_id", "n", *rounded("mean"), F.round("variance", 4).alias("variance"))


@query("SELECT visit_concept_id, CAST(count(DISTINCT CASE WHEN visit_end_date > visit_start_date THEN visit_occurrence_id END) AS BIGINT) AS numerator, count(*) AS denominator, round(count(CASE WHEN visit_end_date > visit_start_date THEN 1 END) * 100.0 / count(*), 6) AS ratio FROM visit_occurrence GROUP BY 1")
def pool_ratio(spark, d):
    g = _by_site(spark, d, "visit_occurrence").groupBy("site_id", "visit_concept_id").agg(F.count_if(F.col("visit_end_date") > F.col("visit_start_date")).alias("num"), F.count("*").alias("den"))
    return P.ratio(g, ["visit_concept_id"], "num", "den", 100).select("visit_concept_id", "numerator", "denominator", *rounded("ratio"))


@query("""WITH g AS (SELECT site_id, drug_concept_id % 5 AS stratum, ln(avg(days_supply)) AS y, stddev_samp(days_supply) / sqrt(count(*)) / avg(days_supply) AS se FROM drug_exposure d JOIN person p ON d.person_id = p.person_id GROUP BY ALL),
w AS (SELECT *, 1 / (se * se) AS w FROM g WHERE se > 0), f AS (SELECT stratum, count(*) AS k, sum(w) AS sw, sum(w * y) AS swy, sum(w * w) AS sww, sum(w * y * y) AS swyy FROM w GROUP BY stratum),
h AS (SELECT *, greatest(0, swyy - swy * swy / sw) AS q, sw - sww / sw AS c FROM f), t AS (SELECT *, greatest(0, (q - (k - 1)) / c) AS tau2 FROM h),
r AS (SELECT w.stratum, sum(y / (se * se + tau2)) / sum(1 / (se * se + tau2)) AS random, sqrt(1 / sum(1 / (se * se + tau2))) AS random_se FROM w JOIN t ON w.stratum = t.stratum GROUP BY w.stratum)
SELECT t.stratum, k, round(swy / sw, 6) AS fixed, round(sqrt(1 / sw), 6) AS fixed_se, round(random, 6) AS random, round(random_se, 6) AS random_se, round(random - 1.959963984540054 * random_se, 6) AS lower, round(random + 1.959963984540054 * random_se, 6) AS upper FROM t JOIN r ON t.stratum = r.stratum""")
def pool_effects(spark, d):
    g = _by_site(spark, d, "drug_exposure").groupBy("site_id", (F.col("drug_concept_id") % 5).alias("stratum"))
    g = g.agg(F.log(F.avg("days_supply")).alias("log_estimate"), (F.stddev_samp("days_supply") / F.sqrt(F.count("*")) / F.avg("days_supply")).alias("se"))
    return P.effects(g, ["stratum"]).select("stratum", "k", *rounded("fixed", "fixed_se", "random", "random_se", "lower", "upper"))


@query("SELECT CAST(sum(least(n, 5)) AS BIGINT) AS value FROM (SELECT count(*) AS n FROM condition_occurrence GROUP BY person_id) x")
def privacy_bounded_count(spark, d):
    return D.bounded_count(view(spark, d, "condition_occurrence"), 5)


@query("""WITH o AS (SELECT DISTINCT person_id, condition_concept_id AS level FROM condition_occurrence WHERE condition_concept_id IN (2001, 2002, 2003, 2999)), r AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY level) AS rn FROM o)
SELECT CAST(s.level AS INT) AS level, count(r.person_id) AS n FROM (VALUES (2001), (2002), (2003), (2999)) s(level) LEFT JOIN r ON s.level = r.level AND rn <= 2 GROUP BY s.level""")
def privacy_categorical(spark, d):
    return D.categorical(view(spark, d, "condition_occurrence"), "condition_concept_id", [2001, 2002, 2003, 2999], 2)


@query("WITH o AS (SELECT DISTINCT person_id, drug_concept_id AS v FROM drug_exposure), r AS (SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY v) AS rn FROM o) SELECT count(DISTINCT v) AS value FROM r WHERE rn <= 3")
def privacy_distinct(spark, d):
    return D.distinct(view(spark, d, "drug_exposure"), "drug_concept_id", 3)


@query("""WITH o AS (SELECT avg(days_supply) AS v FROM drug_exposure WHERE days_supply IS NOT NULL GROUP BY person_id), g AS (SELECT count(*) AS n, CAST(sum(floor((greatest(10.0, least(40.0, v)) - 10.0) / 30.0 * 1000 + 0.5)) AS BIGINT) AS sum_grid FROM o)
SELECT n, sum_grid, round(10 + 30.0 * sum_grid / (n * 1000), 6) AS value FROM g""")
def privacy_mean(spark, d):
    return D.mean(view(spark, d, "drug_exposure"), "days_supply", 10.0, 40.0).select("n", "sum_grid", *rounded("value"))


@query("SELECT count(CASE WHEN v THEN 1 END) AS num, count(*) AS den, round(count(CASE WHEN v THEN 1 END) / CAST(count(*) AS DOUBLE), 6) AS value FROM (SELECT bool_or(days_supply > 45) AS v FROM drug_exposure GROUP BY person_id) x")
def privacy_rate(spark, d):
    return D.rate(view(spark, d, "drug_exposure"), F.col("days_supply") > 45).select("num", "den", *rounded("value"))


@query("SELECT * FROM person")
def staged_round_trip(spark, d):
    return read_staged(spark, write_staged({"person": view(spark, d, "person")}, f"{shared_root(spark)}/medloom/staged"))["person"]


from . import catalog_analyses, catalog_characterise, catalog_families  # noqa: E402, F401  (they build on the queries above)
