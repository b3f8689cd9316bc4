"""Queries of persons' variables, scores, filters and cohorts, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cdm.fixture import view
from .functions.dates import age_at
from .operators import cohort as C
from .operators import explore as E
from .operators import features as R
from .operators import people as H
from .operators import temporal as T
from .registry import index, index_sql, query, rounded

_S, _E = "observation_period_start_date", "observation_period_end_date"


@query("""SELECT person_id, CASE gender_concept_id WHEN 8507 THEN 'M' WHEN 8532 THEN 'F' END AS sex, 2002 - year_of_birth AS age,
CAST(coalesce(gender_concept_id = 0, true) AS INT) + CAST(coalesce(year_of_birth = 0, true) AS INT) + CAST(coalesce(month_of_birth = 0, true) AS INT) + CAST(coalesce(day_of_birth = 0, true) AS INT) + CAST(coalesce(race_concept_id = 0, true) AS INT) + CAST(coalesce(ethnicity_concept_id = 0, true) AS INT) AS demo_missingness FROM person""")
def variable_demographics(spark, d):
    age = age_at(F.lit("2002-01-01").cast("date"), F.col("year_of_birth"))
    return view(spark, d, "person").select("person_id", H.sex().alias("sex"), age.alias("age"), H.demographic_missingness().alias("demo_missingness"))


def _duration(policy: str, expression: str) -> None:
    def f(spark, d):
        return H.observed_days(view(spark, d, "observation_period"), policy)

    f.__name__ = f"variable_obs_duration_{policy}"
    query(f"SELECT person_id, CAST({expression} AS BIGINT) AS obs_duration FROM (SELECT person_id, {_S} AS s, {_E} AS e, date_diff('day', {_S}, {_E}) AS n FROM observation_period) x GROUP BY person_id")(f)


for _policy, _expression in {"total": "sum(n)", "first": "arg_min(n, (s, e))", "last": "arg_max(n, (s, e))", "longest": "max(n)"}.items():
    _duration(_policy, _expression)


@query(f"""WITH c AS (SELECT person_id, count(*) AS n, min(date_diff('day', {_S}, DATE '1998-09-01')) AS p, min(date_diff('day', DATE '1998-09-01', {_E})) AS f FROM observation_period WHERE DATE '1998-09-01' BETWEEN {_S} AND {_E} GROUP BY person_id)
SELECT person.person_id, CAST(p AS INT) AS prior_obs, CAST(f AS INT) AS followup FROM person LEFT JOIN c ON person.person_id = c.person_id AND n = 1""")
def variable_reference(spark, d):
    return H.around_reference(view(spark, d, "person"), view(spark, d, "observation_period"), F.lit("1998-09-01").cast("date"))


_SCORE = """WITH w AS (SELECT category, concept_id, max(weight) AS weight FROM ({codes}) x GROUP BY 1, 2), h AS (SELECT person_id, category, max(weight) AS weight FROM {rows} JOIN w ON {column} = w.concept_id GROUP BY 1, 2),
t AS (SELECT person_id, sum(weight) AS points FROM h GROUP BY person_id) SELECT p.person_id, CAST(coalesce(points, 0) + {extra} AS BIGINT) AS score FROM person p LEFT JOIN t ON p.person_id = t.person_id"""
_OWN = "SELECT category, concept_id, weight FROM codeset"
_BELOW = f"{_OWN} UNION ALL SELECT category, descendant_concept_id, weight FROM codeset JOIN concept_ancestor ON concept_id = ancestor_concept_id"
_MAPPED = "SELECT category, concept_id + 7000 AS concept_id, weight FROM codeset"


@query(_SCORE.format(codes=_BELOW, rows="condition_occurrence", column="condition_concept_id", extra="0"))
def score_categories(spark, d):
    codes = H.codes(view(spark, d, "codeset"), view(spark, d, "concept_ancestor"))
    return H.score(view(spark, d, "person"), view(spark, d, "condition_occurrence"), "condition_concept_id", codes)


@query(_SCORE.format(codes=_OWN, rows="condition_occurrence", column="condition_concept_id", extra="CASE WHEN 2002 - year_of_birth >= 75 THEN 2 WHEN 2002 - year_of_birth >= 65 THEN 1 ELSE 0 END + CASE WHEN gender_concept_id = 8532 THEN 1 ELSE 0 END"))
def score_with_age_and_sex(spark, d):
    age = age_at(F.lit("2002-01-01").cast("date"), F.col("year_of_birth"))
    points = F.when(age >= 75, 2).when(age >= 65, 1).otherwise(0) + F.when(F.col("gender_concept_id") == 8532, 1).otherwise(0)
    return H.score(view(spark, d, "person"), view(spark, d, "condition_occurrence"), "condition_concept_id", H.codes(view(spark, d, "codeset")), points)


@query(_SCORE.format(codes=f"{_MAPPED} UNION ALL SELECT category, concept_id_2, weight FROM ({_MAPPED}) s JOIN concept_relationship ON s.concept_id = concept_id_1 AND relationship_id = 'Maps to'", rows="condition_occurrence", column="condition_concept_id", extra="0"))
def score_mapped_codes(spark, d):
    source = view(spark, d, "codeset").withColumn("concept_id", F.col("concept_id") + 7000)  # codes of a source vocabulary
    return H.score(view(spark, d, "person"), view(spark, d, "condition_occurrence"), "condition_concept_id", H.codes(source, relationship=view(spark, d, "concept_relationship")))


def _persons(name: str, test: str):
    """Register a filter on persons; test: SQL on person p."""

    def add(f):
        f.__name__ = f"filter_{name}"
        return query(f"SELECT p.person_id FROM person p WHERE {test}")(f)

    return add


def _people(spark, d) -> DataFrame:
    return view(spark, d, "person").select("person_id")


@_persons("age_group", "2002 - year_of_birth BETWEEN 20 AND 29 OR 2002 - year_of_birth >= 60")
def _(spark, d):
    return view(spark, d, "person").where(H.age_groups(["20-29", "60+"], 2002 - F.col("year_of_birth"))).select("person_id")


@_persons("cohort", "EXISTS (SELECT 1 FROM cohort c WHERE c.subject_id = p.person_id AND cohort_definition_id = 2)")
def _(spark, d):
    return H.members(_people(spark, d), view(spark, d, "cohort"), 2)


@_persons("visit_count", "(SELECT count(*) FROM visit_occurrence v WHERE v.person_id = p.person_id AND visit_concept_id = 9201 AND visit_start_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31') >= 3")
def _(spark, d):
    visits = view(spark, d, "visit_occurrence").where("visit_concept_id = 9201").where(F.col("visit_start_date").between("1996-01-01", "1999-12-31"))
    return H.at_least(_people(spark, d), visits, 3)


@_persons("has_measurement", "EXISTS (SELECT 1 FROM measurement m WHERE m.person_id = p.person_id AND measurement_concept_id = 4003 AND value_as_number >= 100 AND value_as_number < 300)")
def _(spark, d):
    low, high = H.snap_outwards([0.0, 100.0, 200.0, 300.0, 400.0], 120, 280)
    m = view(spark, d, "measurement").where("measurement_concept_id = 4003").where((F.col("value_as_number") >= low) & (F.col("value_as_number") < high))
    return H.at_least(_people(spark, d), m)


@_persons("missing_measurement", "NOT EXISTS (SELECT 1 FROM measurement m WHERE m.person_id = p.person_id AND measurement_concept_id = 4002 AND value_as_number IS NOT NULL)")
def _(spark, d):
    return H.at_least(_people(spark, d), view(spark, d, "measurement").where("measurement_concept_id = 4002 AND value_as_number IS NOT NULL"), 0)


@query("SELECT measurement_id FROM measurement WHERE value_as_number >= 200 AND value_as_number < 400 AND measurement_date BETWEEN DATE '1998-03-01' AND DATE '1998-04-30' AND value_as_concept_id IN (45884084, 45884085)")
def filter_value_date_concept(spark, d):
    low, high = H.snap([0.0, 100.0, 200.0, 300.0, 400.0], 250)
    rows = H.value_in(view(spark, d, "measurement"), "value_as_number", low, high, "measurement_date", ("1998-03-01", "1998-04-30"), "value_as_concept_id", [45884084, 45884085])
    return rows.select("measurement_id")


@query("""SELECT condition_occurrence_id FROM condition_occurrence c WHERE EXISTS (SELECT 1 FROM visit_occurrence v WHERE v.visit_occurrence_id = c.visit_occurrence_id AND visit_concept_id IN (9201, 9203))""")
def filter_visit(spark, d):
    visits = view(spark, d, "visit_occurrence").where("visit_concept_id IN (9201, 9203)")
    return H.of_visits(view(spark, d, "condition_occurrence"), visits).select("condition_occurrence_id")


def _policy_query(policy: str, test: str) -> None:
    def f(spark, d):
        all_of = index(spark, d, "all")
        return H.by_episodes(all_of, C.eligible(all_of, view(spark, d, "person"), prior=500), policy)

    f.__name__ = f"population_{policy}_episode"
    query(index_sql("all") + f"SELECT subject_id FROM (SELECT *, date_diff('day', obs_start, cohort_start_date) >= 500 AS ok FROM idx) x GROUP BY subject_id HAVING {test}")(f)


for _policy, _test in {"any": "bool_or(ok)", "all": "bool_and(ok)", "first": "arg_min(ok, episode_id)", "last": "arg_max(ok, episode_id)"}.items():
    _policy_query(_policy, _test)


@query("""SELECT person_id FROM person WHERE gender_concept_id = 8532 INTERSECT SELECT subject_id FROM cohort WHERE cohort_definition_id IN (1, 2) EXCEPT SELECT person_id FROM death""")
def population_tree(spark, d):
    base = view(spark, d, "person").where("gender_concept_id = 8532").select(F.col("person_id").alias("subject_id"))
    stored = [view(spark, d, "cohort").where(F.col("cohort_definition_id") == i) for i in (1, 2)]
    dead = view(spark, d, "death").select(F.col("person_id").alias("subject_id"))
    return C.population({"first_without": [{"all": [base, {"any": stored}]}, dead]}).withColumnRenamed("subject_id", "person_id")


@query("""WITH c AS (SELECT DISTINCT person_id AS subject_id, drug_exposure_start_date AS cohort_start_date, drug_exposure_end_date AS cohort_end_date FROM drug_exposure WHERE drug_concept_id IN (3001, 3002)
  AND person_id IN (SELECT person_id FROM condition_occurrence WHERE condition_concept_id = 2003) AND person_id IN (SELECT person_id FROM person WHERE gender_concept_id = 8507))
SELECT *, CAST(row_number() OVER (PARTITION BY subject_id ORDER BY cohort_start_date, cohort_end_date) AS INT) AS cohort_row_id FROM c""")
def cohort_create(spark, d):
    criteria = [view(spark, d, "condition_occurrence").where("condition_concept_id = 2003"), view(spark, d, "person").where("gender_concept_id = 8507")]
    return H.create(view(spark, d, "drug_exposure"), "drug_concept_id", [3001, 3002], "drug_exposure_start_date", "drug_exposure_end_date", criteria)


@query("""SELECT c.cohort_definition_id, count(DISTINCT subject_id) AS n_persons, min(cohort_definition_name) AS cohort_definition_name FROM cohort c LEFT JOIN cohort_definition f ON c.cohort_definition_id = f.cohort_definition_id GROUP BY c.cohort_definition_id HAVING count(DISTINCT subject_id) >= 3""")
def cohort_list(spark, d):
    return H.stored(view(spark, d, "cohort"), view(spark, d, "cohort_definition"))


@query("SELECT * FROM cohort_definition WHERE cohort_definition_id = 2")
def cohort_definition(spark, d):
    return H.definition(view(spark, d, "cohort_definition"), 2)


@query(index_sql() + "SELECT subject_id, episode_id, CAST(date_trunc('month', cohort_start_date) AS DATE) AS cohort_start_date, CAST(date_trunc('month', cohort_end_date) AS DATE) AS cohort_end_date FROM idx")
def output_membership(spark, d):
    rows = index(spark, d).select("subject_id", "episode_id", "cohort_start_date", "cohort_end_date")
    return H.dated(rows, ["cohort_start_date", "cohort_end_date"], "binned")


@query(index_sql() + "SELECT subject_id, episode_id, 0 AS cohort_start_date, CAST(date_diff('day', cohort_start_date, cohort_end_date) AS INT) AS cohort_end_date FROM idx")
def dates_relative(spark, d):
    rows = index(spark, d).select("subject_id", "episode_id", "cohort_start_date", "cohort_end_date").withColumn("ref", F.col("cohort_start_date"))
    return H.dated(rows, ["cohort_start_date", "cohort_end_date"], "relative", "ref").drop("ref")


@query("""WITH m AS (SELECT person_id, count(*) AS n_measurements, avg(value_as_number) AS mean_value FROM measurement GROUP BY person_id), c AS (SELECT person_id, count(*) AS n_conditions FROM condition_occurrence GROUP BY person_id)
SELECT p.person_id, gender_concept_id, cause_concept_id, coalesce(n_measurements, 0) AS n_measurements, round(mean_value, 6) AS mean_value, coalesce(n_conditions, 0) AS n_conditions FROM person p LEFT JOIN death d ON p.person_id = d.person_id LEFT JOIN m ON p.person_id = m.person_id LEFT JOIN c ON p.person_id = c.person_id""")
def output_person_level(spark, d):
    m = R.features(view(spark, d, "measurement"), ["person_id"], {"n_measurements": F.count("*"), "mean_value": F.avg("value_as_number")})
    c = R.features(view(spark, d, "condition_occurrence"), ["person_id"], {"n_conditions": F.count("*")})
    out = H.person_level(view(spark, d, "person").select("person_id", "gender_concept_id"), [view(spark, d, "death").select("person_id", "cause_concept_id"), m, c], ("n_measurements", "n_conditions"))
    return out.select("person_id", "gender_concept_id", "cause_concept_id", "n_measurements", "n_conditions", *rounded("mean_value"))


@query(index_sql("all") + """SELECT i.subject_id, i.episode_id, count(c.condition_occurrence_id) AS count, count(DISTINCT condition_concept_id) AS n_distinct FROM idx i LEFT JOIN condition_occurrence c ON c.person_id = i.subject_id AND date_diff('day', cohort_start_date, condition_start_date) BETWEEN -365 AND 0 GROUP BY i.subject_id, i.episode_id""")
def output_features_episode(spark, d):
    episodes = index(spark, d, "all")
    near = T.around(episodes, view(spark, d, "condition_occurrence"), "condition_start_date", -365, 0)
    found = R.features(near, ["subject_id", "episode_id"], {"count": F.count("*"), "n_distinct": F.count_distinct("condition_concept_id")})
    return R.on_roster(episodes.select("subject_id", "episode_id"), found, ["subject_id", "episode_id"])


@query("""SELECT count(*) AS n_records, count(DISTINCT person_id) AS n_persons, min(measurement_date) AS first_date, max(measurement_date) AS last_date FROM measurement WHERE measurement_concept_id = 4003""")
def concept_drilldown(spark, d):
    return E.drilldown(view(spark, d, "measurement"), "measurement_concept_id", 4003, "value_as_number", "measurement_date", "value_as_concept_id")["summary"]


@query("""SELECT value_as_concept_id AS value, CAST(floor(count(*) / 5) * 5 AS BIGINT) AS n, CAST(floor(count(DISTINCT person_id) / 5) * 5 AS BIGINT) AS n_persons FROM measurement WHERE measurement_concept_id = 4003 GROUP BY 1 HAVING count(DISTINCT person_id) >= 3 ORDER BY 2 DESC, 1 LIMIT 20""")
def concept_summary(spark, d):
    return E.summary(view(spark, d, "measurement").where("measurement_concept_id = 4003"), "value_as_concept_id")
