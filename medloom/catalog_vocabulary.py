"""Queries of the schema catalog and the vocabulary, and their SQL."""

from __future__ import annotations

from .cdm.fixture import view
from .operators import vocabulary as Y
from .registry import query
from .sources import schemas as K

_IDS = [1902, 2001, 2007, 2039]
_IN = "(1902, 2001, 2007, 2039)"
_SHOWN = ("condition_occurrence", "death", "person", "visit_occurrence", "concept")


@query("""SELECT * FROM (VALUES ('concept', 'concept_class_id', 'character'), ('concept', 'concept_code', 'character'), ('concept', 'concept_id', 'numeric'), ('concept', 'concept_name', 'character'), ('concept', 'domain_id', 'character'),
('concept', 'invalid_reason', 'character'), ('concept', 'standard_concept', 'character'), ('concept', 'vocabulary_id', 'character'), ('death', 'cause_concept_id', 'numeric'), ('death', 'death_date', 'temporal'), ('death', 'person_id', 'numeric')) t(table_name, column_name, family)""")
def schema_columns(spark, d):
    rows = K.columns({t: view(spark, d, t) for t in ("concept", "death")})
    return K.as_table(spark, rows, "table_name column_name type family").drop("type")


@query("""SELECT * FROM (VALUES ('condition_occurrence', 'person_id', 'person'), ('condition_occurrence', 'condition_concept_id', 'concept'), ('condition_occurrence', 'visit_occurrence_id', 'visit_occurrence'), ('death', 'person_id', 'person'), ('death', 'cause_concept_id', 'concept'),
('person', 'gender_concept_id', 'concept'), ('person', 'race_concept_id', 'concept'), ('person', 'ethnicity_concept_id', 'concept'), ('visit_occurrence', 'person_id', 'person'), ('visit_occurrence', 'visit_concept_id', 'concept')) t(from_table, from_column, to_table)""")
def schema_joins(spark, d):
    rows = K.joins({t: view(spark, d, t) for t in _SHOWN})
    return K.as_table(spark, rows, "from_table from_column to_table to_column").drop("to_column")


@query(f"SELECT * FROM concept WHERE concept_id IN {_IN}")
def concept_lookup(spark, d):
    return Y.lookup(view(spark, d, "concept"), _IDS)


@query("SELECT concept_id, concept_name FROM concept WHERE lower(concept_name) LIKE '%condition 3%' AND domain_id = 'Condition' AND standard_concept = 'S' AND invalid_reason IS NULL ORDER BY concept_id LIMIT 50")
def concept_search_terms(spark, d):
    return Y.search(view(spark, d, "concept"), "CONDITION 3", domain="Condition", valid_only=True).select("concept_id", "concept_name")


@query("SELECT concept_id, concept_name, (SELECT count(*) FROM concept WHERE domain_id = 'Condition') AS total_count FROM concept WHERE domain_id = 'Condition' ORDER BY concept_name, concept_id LIMIT 20 OFFSET 30")
def concept_list(spark, d):
    return Y.page(view(spark, d, "concept"), {"domain_id": "Condition"}, "concept_name", 30, 20).select("concept_id", "concept_name", "total_count")


@query(f"SELECT ancestor_concept_id, descendant_concept_id AS concept_id FROM concept_ancestor WHERE ancestor_concept_id IN {_IN} UNION SELECT i, i FROM (VALUES (1902), (2001), (2007), (2039)) t(i)")
def concept_descendants(spark, d):
    return Y.descendants(view(spark, d, "concept_ancestor"), _IDS)


@query(f"""SELECT descendant_concept_id AS seed_concept_id, ancestor_concept_id AS concept_id, 'ancestor' AS direction, min_levels_of_separation AS levels_of_separation FROM concept_ancestor WHERE descendant_concept_id IN {_IN} AND ancestor_concept_id <> descendant_concept_id
UNION ALL SELECT ancestor_concept_id, descendant_concept_id, 'descendant', min_levels_of_separation FROM concept_ancestor WHERE ancestor_concept_id IN {_IN} AND ancestor_concept_id <> descendant_concept_id""")
def concept_ancestors(spark, d):
    return Y.relatives(view(spark, d, "concept_ancestor"), _IDS)


@query(f"SELECT concept_id, concept_synonym_name FROM concept_synonym WHERE concept_id IN {_IN}")
def concept_synonyms(spark, d):
    return Y.synonyms(view(spark, d, "concept_synonym"), _IDS)


@query(f"""SELECT concept_id_1 AS seed_concept_id, concept_id_2 AS concept_id, relationship_id, 'from' AS direction FROM concept_relationship WHERE concept_id_1 IN {_IN}
UNION ALL SELECT concept_id_2, concept_id_1, relationship_id, 'to' FROM concept_relationship WHERE concept_id_2 IN {_IN}""")
def concept_relationships(spark, d):
    return Y.relationships(view(spark, d, "concept_relationship"), _IDS)


@query("""WITH s AS (SELECT descendant_concept_id AS concept_id FROM concept_ancestor WHERE ancestor_concept_id IN (1901, 2001) UNION SELECT 1901 UNION SELECT 2001),
m AS (SELECT concept_id FROM s UNION SELECT concept_id_1 FROM concept_relationship JOIN s ON concept_id_2 = s.concept_id WHERE relationship_id = 'Maps to') SELECT concept_id FROM m WHERE concept_id NOT IN (2009, 9009)""")
def concept_expand(spark, d):
    return Y.expand([1901, 2001], view(spark, d, "concept_ancestor"), view(spark, d, "concept_relationship"), True, True, [2009, 9009])


def _names(column: str) -> None:
    def f(spark, d):
        return Y.names(view(spark, d, "concept"), column)

    f.__name__ = f"vocabulary_by_{column}"
    query(f"SELECT {column}, count(*) AS n_concepts FROM concept GROUP BY {column}")(f)


for _c in ("vocabulary_id", "domain_id", "concept_class_id"):
    _names(_c)


@query("SELECT * FROM cdm_source")
def cdm_source(spark, d):
    return view(spark, d, "cdm_source")


@query("SELECT drug_exposure_id, drug_concept_id, concept_name AS drug_concept_id_name FROM drug_exposure LEFT JOIN concept ON drug_concept_id = concept_id")
def translate_concepts(spark, d):
    rows = view(spark, d, "drug_exposure").select("drug_exposure_id", "drug_concept_id")
    return Y.translate(rows, view(spark, d, "concept"), ["drug_concept_id"])


@query("""WITH u AS (SELECT DISTINCT condition_concept_id AS concept_id, 'conditions' AS output FROM condition_occurrence UNION ALL SELECT DISTINCT drug_concept_id, 'drugs' FROM drug_exposure UNION ALL SELECT DISTINCT cause_concept_id, 'deaths' FROM death)
SELECT u.concept_id, concept_name, domain_id, string_agg(output, ',' ORDER BY output) AS outputs FROM u LEFT JOIN concept c ON u.concept_id = c.concept_id GROUP BY ALL""")
def concept_dictionary(spark, d):
    used = {"conditions": ("condition_occurrence", "condition_concept_id"), "drugs": ("drug_exposure", "drug_concept_id"), "deaths": ("death", "cause_concept_id")}
    return Y.dictionary({name: (view(spark, d, t), [c]) for name, (t, c) in used.items()}, view(spark, d, "concept"))


@query("SELECT visit_concept_id AS level, CAST(row_number() OVER (ORDER BY visit_concept_id) AS INT) AS code FROM (SELECT DISTINCT visit_concept_id FROM visit_occurrence) x")
def factor_levels(spark, d):
    return Y.levels(view(spark, d, "visit_occurrence"), "visit_concept_id")
