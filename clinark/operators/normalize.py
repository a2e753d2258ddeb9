"""Normalisers: nested FHIR resources → flat clean tables (all columns string).

Each is one projection (plus a NOT NULL filter) over the raw frame, so Catalyst
prunes the raw scan to the referenced paths and pushes the filter into it.
Medications are also de-duplicated by ``med_id``.

A raw frame with a ``_line`` column (``sources.raw.read_lines``) keeps it, and its malformed
lines pass every filter, so that one write can split rows from lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinark.functions import exprs as X
from clinark.schemas import LINE


def _line(raw: DataFrame) -> list[str]:
    return [LINE] if LINE in raw.columns else []


def _rows(raw: DataFrame, keep: Column) -> Column:
    return keep | F.col(LINE).isNotNull() if LINE in raw.columns else keep


def _key(plain: Column, hashed: bool) -> Column:
    return X.patient_key(plain) if hashed else plain


def normalize_patients(raw: DataFrame, hashed: bool = True) -> DataFrame:
    """patients(patient_id, gender, birth_year, state, city, age_group).

    Rows without an id are dropped; the filter is on the raw id (sha2 keeps NULL),
    so it reaches the scan and the hash is computed once per kept row. Duplicate
    patients are kept (as the source does). Without ``hashed`` the key is the plain id, to be
    hashed where the rows are laid out (``sources.parquet.write_split``), as in the other two.
    """
    addr = X.first("address")
    year = X.birth_year("birthDate")
    return raw.where(_rows(raw, F.col("id").isNotNull())).select(
        _key(F.col("id"), hashed).alias("patient_id"),
        F.col("gender"),
        year.alias("birth_year"),
        addr["state"].alias("state"),
        addr["city"].alias("city"),
        X.age_group(year).alias("age_group"),
        *_line(raw),
    )


def normalize_conditions(raw: DataFrame, hashed: bool = True) -> DataFrame:
    """conditions(condition_id, patient_id, icd_code, diagnosis_name, clinical_status,
    onset_date); rows without a first code are dropped. A subject reference without
    ``/`` gives a NULL patient_id, and the row is kept."""
    coding = X.first(F.col("code.coding"))
    return raw.select(
        F.col("id").alias("condition_id"),
        _key(X.id_of_ref("subject.reference"), hashed).alias("patient_id"),
        coding["code"].alias("icd_code"),
        coding["display"].alias("diagnosis_name"),
        X.first(F.col("clinicalStatus.coding"))["code"].alias("clinical_status"),
        F.col("onsetDateTime").alias("onset_date"),
        *_line(raw),
    ).where(_rows(raw, F.col("icd_code").isNotNull()))


def normalize_encounters(raw: DataFrame, hashed: bool = True) -> DataFrame:
    """encounters(encounter_id, patient_id, encounter_class, encounter_type, start_date,
    end_date); no row filter."""
    return raw.select(
        F.col("id").alias("encounter_id"),
        _key(X.id_of_ref("subject.reference"), hashed).alias("patient_id"),
        F.col("class.code").alias("encounter_class"),
        X.first(X.first("type")["coding"])["display"].alias("encounter_type"),
        F.col("period.start").alias("start_date"),
        F.col("period.end").alias("end_date"),
        *_line(raw),
    )


# Output columns of the medication table, in order.
MED_COLUMNS = ["med_id", "patient_id", "encounter_id", "start_date", "drug_code", "drug_name",
               "dose", "route", "status"]


def first_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per ``key``: the smallest by the remaining columns in order, ascending,
    NULLs first — a deterministic DISTINCT ON.

    Expressed as ``min(struct(...))`` per key, an aggregate, so each map task
    combines its rows per key before the shuffle: a key holding a third of the
    table ships one row per task, never the whole group.
    """
    rest = [c for c in df.columns if c != key]
    return (df.groupBy(key)
              .agg(F.min(F.struct(*rest)).alias("_first"))
              .select(key, *[F.col("_first")[c].alias(c) for c in rest]))


def normalize_medications(raw: DataFrame, patient_key: str = "plain") -> DataFrame:
    """medications(med_id, patient_id, encounter_id, start_date, drug_code, drug_name,
    dose, route, status), one row per med_id.

    ``patient_key="plain"`` keeps the id with the ``Patient/`` prefix stripped (the
    source behaviour: not anonymised, does not join patients); ``"hashed"`` hashes
    it, so it joins ``patients.patient_id``.
    """
    if patient_key not in ("plain", "hashed"):
        raise ValueError("patient_key must be 'plain' or 'hashed'")
    pid = X.strip_prefix("subject.reference", X.PATIENT_PREFIX)
    coding = X.first(F.col("medicationCodeableConcept.coding"))
    flat = raw.where(_rows(raw, F.col("id").isNotNull())).select(
        F.col("id").alias("med_id"),
        pid.alias("patient_id"),
        X.strip_prefix("encounter.reference", X.ENCOUNTER_PREFIX).alias("encounter_id"),
        X.iso_date_text("authoredOn").alias("start_date"),
        coding["code"].cast("string").alias("drug_code"),
        coding["display"].cast("string").alias("drug_name"),
        X.first("dosageInstruction")["text"].cast("string").alias("dose"),
        F.lit("").alias("route"),
        F.col("status"),
        *_line(raw),
    )
    if LINE in raw.columns:
        # Equal malformed lines meet as one group and its count, and are dealt out again.
        rest = MED_COLUMNS[1:]
        out = flat.groupBy("med_id", LINE).agg(F.min(F.struct(*rest)).alias("_first"), F.count(F.lit(1)).alias("_n"))
        copies = F.explode(F.sequence(F.lit(1), F.when(F.col(LINE).isNull(), 1).otherwise(F.col("_n")).cast("int")))
        out = out.select("med_id", "_first", LINE, copies.alias("_copy"))
        out = out.select("med_id", *[F.col("_first")[c].alias(c) for c in rest], LINE)
    else:
        out = first_row_per_key(flat, "med_id").select(*MED_COLUMNS)
    # Hashed after the row is chosen: both forms keep the same row, and the shuffle carries plain ids.
    return out.withColumn("patient_id", X.patient_key("patient_id")) if patient_key == "hashed" else out
