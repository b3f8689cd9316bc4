"""Where clinical queries and their SQL are kept, and the cohort that many of them start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cdm.fixture import sql, view
from .operators import cohort as C

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(text: str):
    """Register a query with its SQL, in which clinical tables stand by name."""

    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql(text)
        return f

    return add


def rounded(*names: str) -> list:
    return [F.round(F.col(n).cast("double"), 6).alias(n) for n in names]


def index(spark, d, limit="first", offset=None) -> DataFrame:
    visits = view(spark, d, "visit_occurrence").where("visit_concept_id = 9201")
    return C.index_events(visits, view(spark, d, "observation_period"), "visit_start_date", "visit_occurrence_id", limit, offset)


def index_sql(limit: str = "first", offset: int | None = None) -> str:
    pick = {"first": "WHERE rn = 1", "last": "WHERE rl = 1", "all": ""}[limit]
    end = "obs_end" if offset is None else f"least(obs_end, d + {offset})"
    return f"""WITH v0 AS (SELECT person_id, visit_start_date AS d, visit_occurrence_id AS k, row_number() OVER (PARTITION BY person_id ORDER BY visit_start_date, visit_occurrence_id) AS rn,
      row_number() OVER (PARTITION BY person_id ORDER BY visit_start_date DESC, visit_occurrence_id DESC) AS rl FROM visit_occurrence WHERE visit_concept_id = 9201),
    v1 AS (SELECT v.person_id, v.d, v.k, min(observation_period_start_date) AS obs_start, max(observation_period_end_date) AS obs_end FROM (SELECT * FROM v0 {pick}) v JOIN observation_period o ON v.person_id = o.person_id
      AND v.d BETWEEN observation_period_start_date AND observation_period_end_date GROUP BY v.person_id, v.d, v.k HAVING count(*) = 1),
    idx AS (SELECT person_id AS subject_id, CAST(row_number() OVER (PARTITION BY person_id ORDER BY d, k) AS INT) AS episode_id, d AS cohort_start_date, {end} AS cohort_end_date, obs_start, obs_end FROM v1)
    """
