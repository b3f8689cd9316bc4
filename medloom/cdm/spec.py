"""Fixed values of the clinical data model: the columns that operators read."""

from __future__ import annotations

# Concept, start and end columns and primary keys of the model's tables.
CONCEPT = {
    "condition_occurrence": "condition_concept_id",
    "drug_exposure": "drug_concept_id",
    "procedure_occurrence": "procedure_concept_id",
    "device_exposure": "device_concept_id",
    "measurement": "measurement_concept_id",
    "observation": "observation_concept_id",
    "visit_occurrence": "visit_concept_id",
    "death": "cause_concept_id",
}
START = {
    "condition_occurrence": "condition_start_date",
    "drug_exposure": "drug_exposure_start_date",
    "procedure_occurrence": "procedure_date",
    "device_exposure": "device_exposure_start_date",
    "measurement": "measurement_date",
    "observation": "observation_date",
    "visit_occurrence": "visit_start_date",
    "observation_period": "observation_period_start_date",
    "death": "death_date",
}
END = {
    "condition_occurrence": "condition_end_date",
    "drug_exposure": "drug_exposure_end_date",
    "device_exposure": "device_exposure_end_date",
    "visit_occurrence": "visit_end_date",
    "observation_period": "observation_period_end_date",
}
KEY = {t: f"{t}_id" for t in ("condition_occurrence", "drug_exposure", "procedure_occurrence", "device_exposure", "measurement", "observation", "visit_occurrence", "observation_period")} | {"death": "person_id", "person": "person_id"}
MALE, FEMALE = 8507, 8532
