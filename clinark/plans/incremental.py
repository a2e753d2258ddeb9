"""A1, A3-A6 by batch: gold tables that follow new patients and conditions without reading the old ones.

The state is small mergeable counts: conditions per (patient, code, name) and patients per (patient,
gender, age group, state). A batch adds its own counts as a delta and never rewrites old ones. Batch and
old state meet per patient and diagnosis, and each such row that the batch changes gives its differences of
the gold tables: distinct patients stay exact, a patient who comes after their conditions moves these out of
the NULL group, and a repeated patient fans out as in the join. Gold tables are merged with these differences
and written anew (they are small). The state lies by patient in its files, so that it is small there and in
the shuffle by patient that reads it.

Every batch is a version (``sources.tiers``) named after it: it is published whole or not at all, and a batch
that was published is not applied again. ``compact`` merges the deltas into one when there are many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinark.functions import exprs as X
from clinark.operators import gold
from clinark.plans.audit import run_concurrently
from clinark.schemas import GOLD, conform
from clinark.sources import tiers
from clinark.sources.parquet import read_clean, write_parquet

COMPACTED = "compacted"
# Folders of a version that go when its gold tables are written.
CHANGES, CELLS = "_changes", "_cells"
STATE = {
    "conditions": "patient_id string, icd_code string, diagnosis_name string, _n bigint, _active bigint",
    "patients": "patient_id string, gender string, age_group string, state string, _m bigint",
}
#: Gold tables: their group columns and the counts that differences are added to.
TABLES = {
    "diagnosis_statistics": (["icd_code", "diagnosis_name"], ["total_cases", "unique_patients", "active_cases"]),
    "demographics_gender": (["gender"], ["count"]),
    "demographics_age_group": (["age_group"], ["count"]),
    "demographics_geography": (["state"], ["patient_count"]),
    "diagnosis_by_gender": (["icd_code", "diagnosis_name", "gender"], ["cases"]),
    "diagnosis_by_age_group": (["icd_code", "diagnosis_name", "age_group"], ["cases"]),
}


def patient_counts(patients: DataFrame) -> DataFrame:
    """Patients per (patient_id, gender, age_group, state): ``_m`` rows."""
    return patients.groupBy("patient_id", "gender", "age_group", "state").agg(F.count(F.lit(1)).alias("_m"))


def merged(state: DataFrame) -> DataFrame:
    """Deltas of either state as one: counts added per key."""
    counts = [c for c in state.columns if c.startswith("_")]
    keys = [c for c in state.columns if c not in counts]
    return state.groupBy(*keys).agg(*(F.sum(c).cast("long").alias(c) for c in counts))


def state_versions(spark: SparkSession, root: str) -> list[str]:
    """The published versions whose deltas make up the state: all since the last compaction."""
    done = tiers.published(spark, root)
    since = max((i for i, v in enumerate(done) if v.endswith(f"-{COMPACTED}")), default=0)
    return done[since:]


def read_state(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All deltas of one state."""
    paths = [f"{tiers.version_root(root, v)}/state/{name}" for v in state_versions(spark, root)]
    if not paths:
        return spark.createDataFrame([], STATE[name])
    return spark.read.schema(STATE[name]).parquet(*paths)


def _differences(cells: DataFrame, patients: DataFrame) -> dict[str, DataFrame]:
    """What a batch adds to the gold tables, from its cells (``gold.diagnosis_cells``) and its patients' counts."""
    def count(column: str, name: str) -> DataFrame:
        return patients.groupBy(column).agg(F.sum("_m").alias(name))

    def cases(column: str) -> DataFrame:
        return cells.groupBy("icd_code", "diagnosis_name", column).agg(F.sum("cases").alias("cases"))
    return {
        "diagnosis_statistics": gold.diagnosis_statistics_of_cells(cells),
        "demographics_gender": count("gender", "count"),
        "demographics_age_group": count("age_group", "count"),
        "demographics_geography": count("state", "patient_count"),
        "diagnosis_by_gender": cases("gender"),
        "diagnosis_by_age_group": cases("age_group"),
    }


def _with_difference(old: DataFrame, difference: DataFrame, name: str) -> DataFrame:
    """``old`` and what a batch adds or takes away; groups that no row is left in go."""
    keys, counts = TABLES[name]
    rows = old.select(*keys, *counts).unionByName(difference.select(*keys, *counts))
    out = rows.groupBy(*keys).agg(*(F.sum(c).cast("long").alias(c) for c in counts)).where(F.col(counts[0]) > 0)
    if name == "demographics_gender":
        out = gold.gender_shares(out)
    return conform(out, name)


def _changes(old: DataFrame, conditions: DataFrame, people: DataFrame) -> DataFrame:
    """Per patient and diagnosis that a batch changes: the cases of the old state and of the batch, with the patient's
    ``_people``. One shuffle by patient serves the counts and the join; old rows lie by patient in their files and
    stay beside each other in it."""
    none = F.lit(0).cast("long")
    rows = gold.packed_diagnoses(conditions).withColumn("_old", none).unionByName(old.select(
        X.packed_key("patient_id").alias("_k"), "icd_code", "diagnosis_name", none.alias("_n"), none.alias("_active"),
        F.col("_n").alias("_old")))
    rows = rows.repartition("_k").groupBy("_k", "icd_code", "diagnosis_name").agg(
        *(F.sum(c).cast("long").alias(c) for c in ("_old", "_n", "_active")))
    return gold.with_people(rows, people)


def apply_batch(spark: SparkSession, root: str, batch: str, conditions: DataFrame, patients: DataFrame,
                max_workers: int = 4) -> str:
    """Bring the gold tables under ``root`` up to date with a batch of clean rows; returns the version that
    holds it (an earlier one if the batch was applied before). One writer at a time."""
    root = root.rstrip("/")
    if not batch or "/" in batch or batch == COMPACTED:
        raise ValueError(f"bad batch name: {batch!r}")
    for version in tiers.published(spark, root):
        if version.partition("-")[2] == batch:
            return version
    for killed in tiers.unfinished(spark, root):
        tiers.fail(spark, root, killed)
    version = tiers.begin(spark, root, batch)
    here = tiers.version_root(root, version)
    old = {name: read_state(spark, root, name) for name in STATE}
    write_parquet(patient_counts(patients), f"{here}/state/patients")
    new_patients = spark.read.schema(STATE["patients"]).parquet(f"{here}/state/patients")

    # The batch's rows and the old state's meet once; the new state and every gold table are read from that.
    changes = _changes(old["conditions"], conditions, gold.people(old["patients"], new_patients))
    write_parquet(changes.sortWithinPartitions("_k"), f"{here}/{CHANGES}")
    changes = spark.read.schema(changes.schema).parquet(f"{here}/{CHANGES}")
    cells = gold.diagnosis_cells(changes)
    delta = changes.where(F.col("_n") > 0).select(X.unpacked_key("_k").alias("patient_id"),
                                                 "icd_code", "diagnosis_name", "_n", "_active")
    run_concurrently({
        "conditions": lambda: write_parquet(delta, f"{here}/state/conditions"),
        "cells": lambda: write_parquet(cells, f"{here}/{CELLS}"),
    }, max_workers)
    difference = _differences(spark.read.schema(cells.schema).parquet(f"{here}/{CELLS}"), new_patients)

    done = tiers.published(spark, root)
    current = f"{tiers.version_root(root, done[-1])}/gold" if done else None

    def write(name: str):
        table = read_clean(spark, current, name) if current else spark.createDataFrame([], GOLD[name])
        return lambda: write_parquet(_with_difference(table, difference[name], name), f"{here}/gold/{name}")
    run_concurrently({name: write(name) for name in TABLES}, max_workers)
    for name in (CHANGES, CELLS):
        tiers.remove(spark, f"{here}/{name}")
    tiers.publish(spark, root, version)
    return version


def compact(spark: SparkSession, root: str) -> str:
    """Merge all deltas into one, in a version of its own with the same gold tables."""
    root = root.rstrip("/")
    now = tiers.current(spark, root)
    version = tiers.begin(spark, root, COMPACTED)
    here = tiers.version_root(root, version)
    for name in STATE:
        state = merged(read_state(spark, root, name).repartition("patient_id")).sortWithinPartitions("patient_id")
        write_parquet(state, f"{here}/state/{name}")
    for name in TABLES:
        write_parquet(read_clean(spark, f"{now}/gold", name), f"{here}/gold/{name}")
    tiers.publish(spark, root, version)
    return version


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A gold table of the current version."""
    return read_clean(spark, f"{tiers.current(spark, root.rstrip('/'))}/gold", name)
