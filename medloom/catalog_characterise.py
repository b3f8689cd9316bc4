"""Queries that describe a cohort, and their SQL."""

from __future__ import annotations

from .catalog_families import _islands
from .cdm.fixture import view
from .operators import characterise as A
from .operators import eras as E
from .registry import index, index_sql, query, rounded

_SICK = "condition_concept_id IN (2001, 2002, 2003)"
_CLEAN, _LONG = 60, 400

#: The SQL lists every day at risk; the operator lists none.
_DAYS = index_sql("all", _LONG) + f""", days AS (SELECT DISTINCT subject_id, CAST(unnest(generate_series(cohort_start_date, cohort_end_date, INTERVAL 1 DAY)) AS DATE) AS day FROM idx),
o AS (SELECT DISTINCT person_id, condition_start_date AS d FROM condition_occurrence WHERE {_SICK}),
gone AS (SELECT DISTINCT person_id, CAST(unnest(generate_series(d + 1, d + {_CLEAN}, INTERVAL 1 DAY)) AS DATE) AS day FROM o),
free AS (SELECT f.subject_id, f.day, o.d, gender_concept_id, CAST(floor((year(f.day) - year_of_birth) / 10) * 10 AS INT) AS age_from, CAST(year(f.day) AS INT) AS year
  FROM (SELECT * FROM days WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.person_id = days.subject_id AND gone.day = days.day)) f JOIN person p ON p.person_id = f.subject_id LEFT JOIN o ON o.person_id = f.subject_id AND o.d = f.day)"""


def _risk(spark, d):
    return index(spark, d, "all", _LONG)


def _outcome(spark, d):
    return view(spark, d, "condition_occurrence").where(_SICK)


@query(_DAYS + """ SELECT CAST(grouping_id(gender_concept_id, age_from, year) AS INT) AS strata, gender_concept_id, age_from, year, count(DISTINCT subject_id) AS persons_at_risk, count(*) AS person_days, count(d) AS outcomes,
count(DISTINCT CASE WHEN d IS NOT NULL THEN subject_id END) AS person_outcomes, round(count(d) * 365250.0 / count(*), 6) AS rate FROM free GROUP BY CUBE (gender_concept_id, age_from, year) HAVING count(DISTINCT subject_id) >= 3""")
def incidence_by_age_sex_year(spark, d):
    out = A.incidence_strata(_risk(spark, d), _outcome(spark, d), "condition_start_date", view(spark, d, "person"), _CLEAN, 10, 3)
    return out.select("strata", "gender_concept_id", "age_from", "year", "persons_at_risk", "person_days", "outcomes", "person_outcomes", *rounded("rate"))


@query(_DAYS + " SELECT subject_id, year, count(*) AS person_days, count(d) AS outcomes FROM free GROUP BY subject_id, year")
def person_time_by_year(spark, d):
    return A.person_time(_risk(spark, d), _outcome(spark, d), "condition_start_date", _CLEAN)


@query(f"""WITH {_islands('drug_exposure', '1', 'drug_exposure_start_date', 'drug_exposure_end_date', 30, 'drug_concept_id BETWEEN 3001 AND 3010')},
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY person_id, c ORDER BY d) = 1 AS INT) AS is_first FROM (SELECT DISTINCT person_id, condition_concept_id AS c, condition_start_date AS d FROM condition_occurrence WHERE {_SICK}) x),
j AS (SELECT o.person_id, c, d, is_first, count(CASE WHEN era_start <= d THEN 1 END) AS k, count(*) AS n, min(era_start) AS zero, max(CASE WHEN era_start <= d THEN era_end END) AS e FROM o JOIN era ON o.person_id = era.person_id GROUP BY 1, 2, 3, 4),
t AS (SELECT c, is_first, CASE WHEN k = 0 THEN 'before' WHEN d <= e AND k = 1 THEN 'during first' WHEN d <= e THEN 'during later' WHEN k = n THEN 'after' ELSE 'between' END AS position, date_diff('day', zero, d) AS days FROM j)
SELECT c AS outcome_id, is_first, position, CAST(scale AS INT) AS scale, CAST(floor(days / scale) AS INT) AS bucket, count(*) AS n_events FROM t, (VALUES (1), (30), (365)) s(scale) GROUP BY 1, 2, 3, 4, 5""")
def time_to_event(spark, d):
    drugs = view(spark, d, "drug_exposure").where("drug_concept_id between 3001 and 3010").withColumnRenamed("person_id", "subject_id")
    eras = E.collapse(drugs, ["subject_id"], "drug_exposure_start_date", "drug_exposure_end_date", 30)
    return A.time_to_event(eras, _outcome(spark, d), "condition_start_date", "condition_concept_id")


@query(index_sql("all") + """, j AS (SELECT subject_id, episode_id, visit_concept_id, date_diff('day', cohort_start_date, visit_start_date) AS a, date_diff('day', cohort_start_date, visit_end_date) AS b FROM idx JOIN visit_occurrence v ON v.person_id = subject_id),
c AS (SELECT *, CASE WHEN a = 0 THEN 'on' WHEN a < 0 AND b >= 0 THEN 'during' WHEN b BETWEEN -30 AND -1 THEN 'before' WHEN a BETWEEN 1 AND 30 THEN 'after' END AS context FROM j)
SELECT visit_concept_id, context, count(DISTINCT subject_id) AS n_persons, count(DISTINCT (subject_id, episode_id)) AS n_episodes FROM c WHERE context IS NOT NULL GROUP BY 1, 2""")
def visit_context(spark, d):
    return A.visit_context(index(spark, d, "all"), view(spark, d, "visit_occurrence"))


_SOURCES = {"condition": ("condition_occurrence", "condition_start_date", "condition_concept_id"), "drug": ("drug_exposure", "drug_exposure_start_date", "drug_concept_id"), "procedure": ("procedure_occurrence", "procedure_date", "procedure_concept_id")}


def _breakdown(name: str, days: int) -> None:
    def f(spark, d):
        return A.index_breakdown(index(spark, d, "all"), {k: (view(spark, d, t), date, concept) for k, (t, date, concept) in _SOURCES.items()}, days)

    f.__name__ = name
    every = " UNION ALL ".join(f"SELECT person_id, '{k}' AS source, CAST({concept} AS BIGINT) AS concept_id, {date} AS d FROM {t}" for k, (t, date, concept) in _SOURCES.items())
    query(index_sql("all") + f""", every_ AS ({every}) SELECT source, concept_id, count(DISTINCT subject_id) AS n_persons, count(DISTINCT (subject_id, episode_id)) AS n_episodes, count(*) AS n_events
FROM idx JOIN every_ e ON e.person_id = subject_id AND abs(date_diff('day', cohort_start_date, d)) <= {days} GROUP BY 1, 2""")(f)


_breakdown("index_breakdown", 0)
_breakdown("index_breakdown_week", 7)
