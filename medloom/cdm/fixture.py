"""Clinical tables over a sales schema, so that every operator has real rows.

Each view is one SELECT that Spark and other SQL engines read alike.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_LINES = """SELECT o_custkey AS person_id, l_orderkey AS visit_id, l_partkey, l_returnflag, CAST(l_shipdate AS DATE) AS d, CAST(l_quantity AS INT) AS q,
  ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey % 100000) * 64 + CAST(l_quantity AS INT) % 64 AS id FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

VIEWS = {
    "person": """SELECT c_custkey AS person_id, CASE WHEN c_custkey % 20 = 0 THEN 0 WHEN c_custkey % 2 = 0 THEN 8507 ELSE 8532 END AS gender_concept_id,
  CAST(1930 + c_custkey % 70 AS INT) AS year_of_birth, CASE WHEN c_custkey % 3 <> 0 THEN CAST(1 + c_custkey % 12 AS INT) END AS month_of_birth,
  CASE WHEN c_custkey % 4 <> 0 THEN CAST(1 + c_custkey % 28 AS INT) END AS day_of_birth, CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE CAST(8500 + c_nationkey AS INT) END AS race_concept_id,
  CASE WHEN c_custkey % 5 <> 0 THEN CAST(38003563 + c_custkey % 2 AS INT) END AS ethnicity_concept_id, CAST(n_regionkey % 3 AS INT) AS site_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "observation_period": """SELECT 2 * c_custkey AS observation_period_id, c_custkey AS person_id, DATE '1995-01-01' + CAST(c_custkey % 90 AS INT) AS observation_period_start_date,
  CASE WHEN c_custkey % 4 = 0 THEN DATE '1998-06-30' ELSE DATE '2001-12-31' END AS observation_period_end_date FROM customer
  UNION ALL SELECT 2 * c_custkey + 1, c_custkey, DATE '1999-01-01', DATE '2001-12-31' FROM customer WHERE c_custkey % 4 = 0""",
    "visit_occurrence": """SELECT o_orderkey AS visit_occurrence_id, o_custkey AS person_id, CASE o_orderstatus WHEN 'F' THEN 9201 WHEN 'O' THEN 9202 ELSE 9203 END AS visit_concept_id,
  CAST(o_orderdate AS DATE) AS visit_start_date, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 7 AS INT) AS visit_end_date FROM orders""",
    "condition_occurrence": f"""SELECT id AS condition_occurrence_id, person_id, CAST(2000 + l_partkey % 40 AS INT) AS condition_concept_id, d AS condition_start_date,
  CASE WHEN l_partkey % 5 <> 0 THEN d + q END AS condition_end_date, visit_id AS visit_occurrence_id FROM ({_LINES}) x WHERE l_returnflag = 'R'""",
    "procedure_occurrence": f"""SELECT id AS procedure_occurrence_id, person_id, CAST(6000 + l_partkey % 25 AS INT) AS procedure_concept_id, d AS procedure_date, visit_id AS visit_occurrence_id
  FROM ({_LINES}) x WHERE l_returnflag = 'A'""",
    "drug_exposure": f"""SELECT id AS drug_exposure_id, person_id, CAST(3000 + l_partkey % 30 AS INT) AS drug_concept_id, d AS drug_exposure_start_date, d + q AS drug_exposure_end_date,
  q AS days_supply, visit_id AS visit_occurrence_id FROM ({_LINES}) x WHERE l_returnflag = 'N'""",
    "measurement": """SELECT event_id AS measurement_id, user_id AS person_id, CASE event_type WHEN 'click' THEN 4001 WHEN 'error' THEN 4002 WHEN 'purchase' THEN 4003 WHEN 'signup' THEN 4004 ELSE 4005 END AS measurement_concept_id,
  DATE '1998-01-01' + CAST((event_id * 37) % 180 AS INT) AS measurement_date, CASE WHEN event_id % 17 <> 0 THEN value END AS value_as_number, CAST(45884084 + event_id % 3 AS INT) AS value_as_concept_id,
  CAST(8840 + event_id % 2 AS INT) AS unit_concept_id, CAST(50 AS DOUBLE) AS range_low, CAST(400 AS DOUBLE) AS range_high FROM events""",
    "death": """SELECT c_custkey AS person_id, DATE '2000-06-30' + CAST(c_custkey % 300 AS INT) AS death_date, CAST(7000 + c_custkey % 3 AS INT) AS cause_concept_id FROM customer WHERE c_custkey % 13 = 0""",
    "concept": """SELECT DISTINCT CAST(2000 + p_partkey % 40 AS INT) AS concept_id, concat('Condition ', CAST(p_partkey % 40 AS VARCHAR(20))) AS concept_name, 'Condition' AS domain_id, 'SNOMED' AS vocabulary_id, 'Disorder' AS concept_class_id, 'S' AS standard_concept, concat('C', CAST(p_partkey % 40 AS VARCHAR(20))) AS concept_code, CASE WHEN p_partkey % 40 = 39 THEN 'D' END AS invalid_reason FROM part
  UNION ALL SELECT DISTINCT CAST(1900 + p_partkey % 8 AS INT), concat('Group ', CAST(p_partkey % 8 AS VARCHAR(20))), 'Condition', 'Local', 'Group', 'C', concat('G', CAST(p_partkey % 8 AS VARCHAR(20))), CAST(NULL AS VARCHAR(20)) FROM part
  UNION ALL SELECT DISTINCT CAST(3000 + p_partkey % 30 AS INT), concat('Drug ', CAST(p_partkey % 30 AS VARCHAR(20))), 'Drug', 'RxNorm', 'Ingredient', 'S', concat('D', CAST(p_partkey % 30 AS VARCHAR(20))), CAST(NULL AS VARCHAR(20)) FROM part
  UNION ALL SELECT DISTINCT CAST(9000 + p_partkey % 40 AS INT), concat('Source ', CAST(p_partkey % 40 AS VARCHAR(20))), 'Condition', 'ICD10', 'Code', CAST(NULL AS VARCHAR(20)), concat('S', CAST(p_partkey % 40 AS VARCHAR(20))), CAST(NULL AS VARCHAR(20)) FROM part""",
    "concept_ancestor": """SELECT DISTINCT CAST(1900 + p_partkey % 8 AS INT) AS ancestor_concept_id, CAST(2000 + p_partkey % 40 AS INT) AS descendant_concept_id, 1 AS min_levels_of_separation FROM part
  UNION ALL SELECT DISTINCT CAST(2000 + p_partkey % 40 AS INT), CAST(2000 + p_partkey % 40 AS INT), 0 FROM part""",
    "concept_relationship": """SELECT DISTINCT CAST(9000 + p_partkey % 40 AS INT) AS concept_id_1, CAST(2000 + p_partkey % 40 AS INT) AS concept_id_2, 'Maps to' AS relationship_id FROM part
  UNION ALL SELECT DISTINCT CAST(2000 + p_partkey % 40 AS INT), CAST(9000 + p_partkey % 40 AS INT), 'Mapped from' FROM part""",
    "concept_hierarchy": """SELECT DISTINCT CAST(20000 + p_partkey % 240 AS INT) AS concept_id_1, CAST(20000 + floor(p_partkey % 240 / 3) AS INT) AS concept_id_2, 'Is a' AS relationship_id FROM part WHERE p_partkey % 240 > 0
  UNION ALL SELECT DISTINCT CAST(20000 + p_partkey % 240 AS INT), CAST(20001 + floor(p_partkey % 240 / 3) AS INT), 'Is a' FROM part WHERE p_partkey % 10 = 0 AND p_partkey % 240 > 2
  UNION ALL SELECT DISTINCT 20000, 20080, 'Is a' FROM part WHERE p_partkey = 1 UNION ALL SELECT DISTINCT CAST(20000 + p_partkey % 240 AS INT), 20000, 'Maps to' FROM part""",
    "concept_synonym": """SELECT DISTINCT CAST(2000 + p_partkey % 40 AS INT) AS concept_id, concat('Also condition ', CAST(p_partkey % 40 AS VARCHAR(20))) AS concept_synonym_name FROM part""",
    "cdm_source": """SELECT 'Sales fixture' AS cdm_source_name, 'v5.4' AS cdm_version FROM nation WHERE n_nationkey = 0""",
    "codeset": """SELECT DISTINCT CAST(p_partkey % 40 AS INT) % 8 AS category, CAST(2000 + p_partkey % 40 AS INT) AS concept_id, CAST(1 + p_partkey % 40 % 3 AS INT) AS weight FROM part WHERE p_partkey % 40 < 24""",
    "cohort": """SELECT CAST(1 + o_orderkey % 3 AS INT) AS cohort_definition_id, o_custkey AS subject_id, CAST(o_orderdate AS DATE) AS cohort_start_date, CAST(o_orderdate AS DATE) + 30 AS cohort_end_date FROM orders WHERE o_orderkey % 5 = 0
  UNION ALL SELECT 9, o_custkey, CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey = 1""",
    "cohort_definition": """SELECT CAST(n_nationkey AS INT) AS cohort_definition_id, concat('Cohort ', CAST(n_nationkey AS VARCHAR(20))) AS cohort_definition_name FROM nation WHERE n_nationkey < 10""",
    "achilles_results": """SELECT CAST(n_regionkey % 3 AS INT) AS site_id, CAST(200 AS INT) AS analysis_id, o_orderstatus AS stratum_1, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS stratum_2, CASE WHEN o_orderpriority <> '1-URGENT' OR n_regionkey % 3 < 2 THEN count(*) END AS count_value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey % 3, o_orderstatus, o_orderpriority""",
    "achilles_results_dist": """SELECT CAST(n_regionkey % 3 AS INT) AS site_id, CAST(203 AS INT) AS analysis_id, o_orderstatus AS stratum_1, count(*) AS count_value, avg(CAST(o_totalprice AS DOUBLE)) AS avg_value, stddev_samp(CAST(o_totalprice AS DOUBLE)) AS stdev_value, min(CAST(o_totalprice AS DOUBLE)) AS min_value, max(CAST(o_totalprice AS DOUBLE)) AS max_value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey % 3, o_orderstatus""",
}
_TABLES = ("customer", "nation", "orders", "lineitem", "events", "part")
_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the sales schema; its columns are looked up once a session."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    used = {t: table(spark, sf_dir, t) for t in _TABLES if re.search(rf"\b{t}\b", VIEWS[name])}
    return spark.sql(f"WITH {', '.join(f'{t} AS (SELECT * FROM {{{t}}})' for t in used)} {VIEWS[name]}", **used)


def sql(query: str) -> str:
    """query with the views that it names as common table expressions before it."""
    used = [f"{n} AS ({v})" for n, v in VIEWS.items() if re.search(rf"\b{n}\b", query)]
    body = query.strip()
    if not used:
        return body
    for word in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(word):
            return f"{word}{', '.join(used)}, {body[len(word):]}"
    return f"WITH {', '.join(used)} {body}"
