"""Lazy access to the tiers of one dataset built from the star-schema tables.

``Dataset(spark, sf_dir)`` gives the raw FHIR frames, the clean tables and the
gold tables as DataFrame plans (nothing runs until an action). Each property
builds a fresh plan, so one query's plan only contains what it reads.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from clinark.operators import gold, normalize
from clinark.sources import fixtures


@dataclass
class Dataset:
    spark: SparkSession
    sf_dir: str

    # raw tier -----------------------------------------------------------------
    def raw(self, resource: str) -> DataFrame:
        return fixtures.RAW_BUILDERS[resource](self.spark, self.sf_dir)

    # clean tier ---------------------------------------------------------------
    @property
    def patients(self) -> DataFrame:
        return normalize.normalize_patients(self.raw("Patient"))

    @property
    def conditions(self) -> DataFrame:
        return normalize.normalize_conditions(self.raw("Condition"))

    @property
    def encounters(self) -> DataFrame:
        return normalize.normalize_encounters(self.raw("Encounter"))

    def medications(self, patient_key: str = "plain") -> DataFrame:
        return normalize.normalize_medications(self.raw("MedicationRequest"), patient_key)

    # gold tier ----------------------------------------------------------------
    @property
    def diagnosis_statistics(self) -> DataFrame:
        return gold.diagnosis_statistics(self.conditions)

    @property
    def demographics_gender(self) -> DataFrame:
        return gold.demographics_gender(self.patients)

    @property
    def demographics_age_group(self) -> DataFrame:
        return gold.demographics_age_group(self.patients)

    @property
    def demographics_geography(self) -> DataFrame:
        return gold.demographics_geography(self.patients)

    @property
    def diagnosis_by_gender(self) -> DataFrame:
        return gold.diagnosis_by_gender(self.conditions, self.patients)

    @property
    def diagnosis_by_age_group(self) -> DataFrame:
        return gold.diagnosis_by_age_group(self.conditions, self.patients)
