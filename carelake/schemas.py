"""The columns of the written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Table columns and types. TIME columns are HH:mm:ss text, free-form
# objects are VARIANT.
RAW_EVENTS = """event_id string, facility_id string, ingested_at timestamp, execution_date date,
    module_source string, source_table string, namespace string, payload variant, row_hash string,
    _loaded_by string, _loaded_at timestamp, _file_name string"""

CLEAN_EVENTS = """event_id string, facility_id string, event_uuid string, event_time timestamp_ntz,
    event_date date, event_type string, event_category string, amount decimal(38,2), currency string,
    patient_id string, provider_id string, department_id string, payload variant,
    ingested_at timestamp_ntz, processed_at timestamp_ntz, is_duplicate boolean,
    validation_status string, _etl_version string"""

FACT_ENCOUNTERS = """encounter_sk string, encounter_id string, patient_id string, provider_id string,
    facility_id string, department_id string, encounter_type string, admit_date date, admit_time string,
    discharge_date date, discharge_time string, length_of_stay_hours decimal(10,2),
    primary_diagnosis_code string, primary_procedure_code string, drg_code string,
    discharge_disposition string, total_charges decimal(38,2), total_payments decimal(38,2),
    total_adjustments decimal(38,2), net_revenue decimal(38,2), readmission_within_30d boolean,
    created_at timestamp_ntz, updated_at timestamp_ntz, _etl_batch_id string"""

DIM_PATIENT = """patient_sk string, patient_id string, first_name string, last_name string,
    full_name string, date_of_birth date, age int, gender string, marital_status string, race string,
    ethnicity string, language string, phone string, email string, address variant,
    emergency_contact variant, insurance_info variant, patient_source_system string, created_date date,
    last_modified_date date, is_active boolean, patient_hash string, _valid_from timestamp_ntz,
    _valid_to timestamp_ntz, _is_current boolean"""

DIM_PROVIDER_SCD2 = """provider_sk string, provider_id string, provider_name string, specialty string,
    department string, npi_number string, license_number string, credential_status string,
    hire_date date, termination_date date, employment_status string, contact_info variant,
    schedule variant, effective_date date, end_date date, is_current boolean"""

DAILY_METRICS = """metric_date date, facility_id string, total_encounters bigint, unique_patients bigint,
    avg_los_hours decimal(10,2), bed_occupancy_rate decimal(5,2), emergency_visits bigint,
    scheduled_visits bigint, no_show_count bigint, cancellation_count bigint, total_revenue decimal(38,2),
    avg_revenue_per_encounter decimal(38,2), collection_rate decimal(5,2), denial_rate decimal(5,2),
    medication_errors bigint, patient_satisfaction_score decimal(3,1), created_at timestamp_ntz,
    updated_at timestamp_ntz"""

# Per table: its columns, the folders it is written in, the order of rows inside a file.
TABLES = {
    "raw_events": (RAW_EVENTS, ["facility_id", "execution_date"], ["module_source"]),
    "clean_events": (CLEAN_EVENTS, ["facility_id", "event_date"], ["event_type"]),
    "fact_encounters": (FACT_ENCOUNTERS, ["facility_id", "admit_date"], ["encounter_type"]),
    "dim_patient": (DIM_PATIENT, [], ["patient_id"]),
    "dim_provider": (DIM_PROVIDER_SCD2, ["is_current"], ["specialty"]),
    "daily_metrics": (DAILY_METRICS, [], ["metric_date", "facility_id"]),
}

# The fields of an extracted clinical note, in order; the lists among them.
NOTE_FIELDS = [
    "document_type", "document_date", "baby_name", "sex", "gestational_age",
    "age_or_day_of_life", "birth_weight", "current_weight", "delivery_details", "apgar_scores",
    "diagnoses", "clinical_summary", "vitals", "examination_findings", "investigations",
    "treatments", "feeding_and_support", "discharge_plan", "clinician_name", "raw_notes",
]
NOTE_LISTS = ["diagnoses", "investigations", "treatments"]


def note_schema() -> dict:
    """The JSON Schema of a note: every field required, nothing else allowed."""
    text = {"type": ["string", "null"]}
    texts = {"type": "array", "items": {"type": "string"}}
    return {
        "type": "object",
        "additionalProperties": False,
        "properties": {f: texts if f in NOTE_LISTS else text for f in NOTE_FIELDS},
        "required": NOTE_FIELDS,
    }


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """The table's columns in order and type; columns ``df`` lacks are NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in struct(ddl).fields
        ]
    )
