"""Raw (FHIR), clean and gold schemas, and ``conform`` for the gold contracts.

Raw schemas list only the paths the pipeline reads, plus ``resourceType`` (used by
the routing ingest) and the scan's corrupt-record column. Declaring them avoids a
JSON inference pass over the whole raw tier, and keeps empty arrays typed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    LongType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S = StringType()
CORRUPT = "_corrupt_record"
# Column of a raw scan with the text of a line that is no JSON object (NULL for a row).
LINE = "_line"


def _s(*names: str) -> list[StructField]:
    return [StructField(n, S) for n in names]


def _ref() -> StructType:
    return StructType(_s("reference"))


CODING_CODE_DISPLAY = ArrayType(StructType(_s("code", "display")))

PATIENT = StructType(
    _s("resourceType", "id", "gender", "birthDate")
    + [StructField("address", ArrayType(StructType(_s("state", "city"))))]
)

CONDITION = StructType(
    _s("resourceType", "id")
    + [
        StructField("subject", _ref()),
        StructField("code", StructType([StructField("coding", CODING_CODE_DISPLAY)])),
        StructField(
            "clinicalStatus",
            StructType([StructField("coding", ArrayType(StructType(_s("code"))))]),
        ),
        StructField("onsetDateTime", S),
    ]
)

ENCOUNTER = StructType(
    _s("resourceType", "id")
    + [
        StructField("subject", _ref()),
        StructField("class", StructType(_s("code"))),
        StructField(
            "type",
            ArrayType(StructType([StructField("coding", ArrayType(StructType(_s("display"))))])),
        ),
        StructField("period", StructType(_s("start", "end"))),
    ]
)

MEDICATION_REQUEST = StructType(
    _s("resourceType", "id", "status")
    + [
        StructField("subject", _ref()),
        StructField("encounter", _ref()),
        StructField(
            "medicationCodeableConcept",
            StructType([StructField("coding", CODING_CODE_DISPLAY)]),
        ),
        StructField("authoredOn", S),
        StructField("dosageInstruction", ArrayType(StructType(_s("text")))),
    ]
)

# The FHIR resource types the ingest routes (landing directories).
RESOURCE_TYPES = ("Patient", "Condition", "Encounter", "MedicationRequest", "Observation")
UNMATCHED = "_unmatched"

RAW = {
    "Patient": PATIENT,
    "Condition": CONDITION,
    "Encounter": ENCOUNTER,
    "MedicationRequest": MEDICATION_REQUEST,
}

# Clean tier contracts; every column is a string.
CLEAN = {
    "patients": StructType(_s("patient_id", "gender", "birth_year", "state", "city", "age_group")),
    "conditions": StructType(
        _s("condition_id", "patient_id", "icd_code", "diagnosis_name", "clinical_status", "onset_date")
    ),
    "encounters": StructType(
        _s("encounter_id", "patient_id", "encounter_class", "encounter_type", "start_date", "end_date")
    ),
    "medications": StructType(
        _s("med_id", "patient_id", "encounter_id", "start_date", "drug_code", "drug_name",
           "dose", "route", "status")
    ),
}

L = LongType()

# Gold tier contracts (counts are bigint, the percentage a double).
GOLD = {
    "diagnosis_statistics": StructType(
        _s("icd_code", "diagnosis_name")
        + [StructField("total_cases", L), StructField("unique_patients", L),
           StructField("active_cases", L)]
    ),
    "demographics_gender": StructType(
        _s("gender") + [StructField("count", L), StructField("percentage", DoubleType())]
    ),
    "demographics_age_group": StructType(_s("age_group") + [StructField("count", L)]),
    "demographics_geography": StructType(_s("state") + [StructField("patient_count", L)]),
    "diagnosis_by_gender": StructType(
        _s("icd_code", "diagnosis_name", "gender") + [StructField("cases", L)]
    ),
    "diagnosis_by_age_group": StructType(
        _s("icd_code", "diagnosis_name", "age_group") + [StructField("cases", L)]
    ),
    "pipeline_runs": StructType(
        [StructField("run_id", S), StructField("run_time", TimestampType()),
         StructField("patients_processed", L), StructField("conditions_processed", L),
         StructField("status", S)]
    ),
}

ALL_TABLES = {**CLEAN, **GOLD}


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project ``df`` onto the declared contract of table ``name``: declared column
    order and types; a missing column is an error, extra columns are dropped."""
    schema = ALL_TABLES[name]
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def conform_raw(df: DataFrame, resource: str) -> DataFrame:
    """Cast a hand-built nested frame to the declared raw schema of ``resource``."""
    schema = RAW[resource]
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
