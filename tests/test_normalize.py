"""Edge cases of the normalisers (hand-written FHIR lines, expected rows by hand)."""

import hashlib

from pyspark.sql import Observation

from clinark.operators.normalize import (
    normalize_conditions,
    normalize_encounters,
    normalize_medications,
    normalize_patients,
)


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def rows(df, order):
    return [r.asDict() for r in df.orderBy(order).collect()]


def test_patients_edge_cases(raw_lines):
    obs = Observation()
    raw = raw_lines("Patient", [
        {"id": "1", "address": []},
        "not json",
        {"id": None, "gender": "male"},
        {"gender": "female"},
        {"id": "2", "birthDate": "abcd"},
        {"id": "3"},
        {"id": "4", "birthDate": "2000-01-01", "address": [{"state": "S", "city": "C"}]},
        {"id": "5", "birthDate": "1999-12-31"},
        {"id": "6", "birthDate": "1975-06-01"},
        {"id": "7", "birthDate": "1974"},
        {"id": "8", "birthDate": "1950-01-01"},
        {"id": "9", "birthDate": "1949-01-01"},
        {"id": "9", "birthDate": "1949-01-01", "gender": "x"},
    ], corrupt=obs)
    out = {r["patient_id"]: r for r in normalize_patients(raw).collect()}
    assert obs.get["corrupt_lines"] == 1
    assert len(normalize_patients(raw).collect()) == 10  # duplicates kept
    assert out[h("1")]["state"] is None and out[h("1")]["city"] is None
    assert out[h("2")]["birth_year"] == "abcd" and out[h("2")]["age_group"] == "75+"
    assert out[h("3")]["birth_year"] is None and out[h("3")]["age_group"] == "75+"
    assert out[h("4")]["state"] == "S" and out[h("4")]["city"] == "C"
    got = [out[h(str(i))]["age_group"] for i in range(4, 10)]
    assert got == ["0-25", "26-50", "26-50", "51-75", "51-75", "75+"]


def test_conditions_reference_and_filters(raw_lines):
    raw = raw_lines("Condition", [
        {"id": "c1", "subject": {"reference": "Patient/x"},
         "code": {"coding": [{"code": "A", "display": "Foo (disorder)"}]},
         "clinicalStatus": {"coding": [{"code": "active"}]}, "onsetDateTime": "2023-01-01"},
        {"id": "c2", "subject": {"reference": "urn:uuid:x"},
         "code": {"coding": [{"code": "B"}]}},
        {"id": "c3", "subject": {"reference": "Patient/y"}, "code": {"coding": []}},
        {"id": "c4", "subject": {"reference": "Patient/y"}},
        {"id": "c5", "code": {"coding": [{"code": "C"}]}, "clinicalStatus": {"coding": []}},
    ])
    got = rows(normalize_conditions(raw), "condition_id")
    assert [r["condition_id"] for r in got] == ["c1", "c2", "c5"]
    assert got[0]["patient_id"] == h("x") and got[0]["clinical_status"] == "active"
    assert got[0]["diagnosis_name"] == "Foo (disorder)"
    assert got[1]["patient_id"] is None  # no '/': NULL key, row kept
    assert got[2]["patient_id"] is None and got[2]["clinical_status"] is None


def test_encounters_nested_first_and_no_filter(raw_lines):
    raw = raw_lines("Encounter", [
        {"id": "e1", "subject": {"reference": "Patient/x"}, "class": {"code": "AMB"},
         "type": [{"coding": [{"display": "Visit"}]}],
         "period": {"start": "2023-05-01T23:30:00-04:00", "end": "2023-05-02"}},
        {"id": "e2", "type": []},
        {"id": "e3", "type": [{"coding": []}]},
        {},
    ])
    got = rows(normalize_encounters(raw), "encounter_id")
    assert len(got) == 4
    by = {r["encounter_id"]: r for r in got}
    assert by["e1"]["encounter_type"] == "Visit" and by["e1"]["patient_id"] == h("x")
    assert by["e1"]["start_date"] == "2023-05-01T23:30:00-04:00"
    assert by["e2"]["encounter_type"] is None and by["e3"]["encounter_type"] is None


MED = {"id": "m1", "status": "active", "subject": {"reference": "Patient/x"},
       "encounter": {"reference": "Encounter/e1"},
       "medicationCodeableConcept": {"coding": [{"code": "RX1", "display": "Drug"}]},
       "authoredOn": "2023-05-01T23:30:00-04:00", "dosageInstruction": [{"text": "1 tablet"}]}


def test_medications_keys_dates_dedup(raw_lines):
    lines = [
        MED,
        {**MED, "dosageInstruction": [{"text": "2 tablets"}]},    # duplicate med_id
        {**MED, "id": "m2", "encounter": {"reference": "e9"}, "authoredOn": "nope",
         "dosageInstruction": []},
        {**MED, "id": None},
    ]
    plain = rows(normalize_medications(raw_lines("MedicationRequest", lines)), "med_id")
    assert [r["med_id"] for r in plain] == ["m1", "m2"]
    m1, m2 = plain
    assert m1["patient_id"] == "x" and m1["encounter_id"] == "e1"
    assert m1["start_date"] == "2023-05-01" and m1["dose"] == "1 tablet"  # smallest row kept
    assert m1["route"] == ""
    assert m2["encounter_id"] == "e9" and m2["start_date"] is None and m2["dose"] is None
    hashed = rows(normalize_medications(raw_lines("MedicationRequest", lines), "hashed"), "med_id")
    assert hashed[0]["patient_id"] == h("x")


def test_medication_dedup_nulls_first(raw_lines):
    lines = [MED, {**MED, "status": None}]
    got = normalize_medications(raw_lines("MedicationRequest", lines)).collect()
    assert len(got) == 1 and got[0]["status"] is None
