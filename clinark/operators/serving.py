"""Serving queries: each read route of the dashboard API as a DataFrame function.

Inputs are the clean or gold DataFrames; outputs are lazy DataFrames with the
route's column names. Parameters are normalised as the routes do (trimmed; type
and gender lower-cased). Every ordered result has a total order: the route's
sort keys, explicit NULL placement, then the output columns as tie-break.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinark.functions import exprs as X
from clinark.operators.directory import page_slice
from clinark.operators.normalize import first_row_per_key
from clinark.operators.places import search_rows
from clinark.operators.ranking import ordered_slice

PAGE_LIMIT_MAX = 100
PAGE_LIMIT_DEFAULT = 25
SHALLOW_ROWS = 10_000
CONDITIONS_LIMIT_DEFAULT = 50
ENCOUNTERS_PER_PATIENT = 20
CONDITIONS_PER_PATIENT = 30
TOP_DIAGNOSES = 20
TIMELINE_SINCE = "2023-01-01"

PATIENT_COLUMNS = ["patient_id", "gender", "birth_year", "age_group", "state", "city"]


def _asc(*cols: str):
    return [F.asc_nulls_first(c) for c in cols]


def kpi(patients: DataFrame, encounters: DataFrame, conditions: DataFrame,
        diag_stats: DataFrame, medications: DataFrame | None = None) -> DataFrame:
    """One row — distinct patients, encounters, conditions, medications,
    active_cases (sum over the statistics table, every diagnosis); every value NULL→0.

    Five global aggregates are unioned as (metric, value) rows and folded by one
    more aggregate: each input is scanned once, with no join between them.
    """
    parts = [
        patients.agg(F.count_distinct("patient_id").alias("v")).select(F.lit("patients").alias("m"), "v"),
        encounters.agg(F.count(F.lit(1)).alias("v")).select(F.lit("encounters").alias("m"), "v"),
        conditions.agg(F.count(F.lit(1)).alias("v")).select(F.lit("conditions").alias("m"), "v"),
        diag_stats.agg(F.sum("active_cases").cast("long").alias("v"))
                  .select(F.lit("active_cases").alias("m"), "v"),
    ]
    if medications is not None:
        parts.append(medications.agg(F.count(F.lit(1)).alias("v"))
                                .select(F.lit("medications").alias("m"), "v"))
    u = reduce(DataFrame.unionByName, parts)
    names = ["patients", "encounters", "conditions", "medications", "active_cases"]
    return u.agg(*[F.coalesce(F.sum(F.when(F.col("m") == n, F.col("v"))), F.lit(0)).cast("long")
                   .alias(n) for n in names])


def timeline(encounters: DataFrame, since: str = TIMELINE_SINCE) -> DataFrame:
    """R2: encounters per month (``yyyy-MM``) with start_date >= since, compared as text;
    rows whose date does not parse are dropped; ordered by month."""
    return (encounters.where(F.col("start_date") >= F.lit(since))
                      .select(X.month_of("start_date").alias("month"))
                      .where(F.col("month").isNotNull())
                      .groupBy("month").agg(F.count(F.lit(1)).alias("count"))
                      .orderBy("month"))


def _type_param(condition_type: str) -> str:
    return (condition_type or "").strip().lower()


def _check_limit(limit: int) -> int:
    """A LIMIT as the store takes it: 0 gives no rows, a negative limit is an error."""
    limit = int(limit)
    if limit < 0:
        raise ValueError("limit must be >= 0")
    return limit


def top_conditions_clean(conditions: DataFrame, condition_type: str = "",
                         limit: int = CONDITIONS_LIMIT_DEFAULT) -> DataFrame:
    """R3 (catalog path): per (diagnosis_name, icd_code) over all conditions, distinct
    patients and total; top ``limit`` by patients; plus the type label."""
    t = _type_param(condition_type)
    df = conditions
    if t and t != "all":
        df = df.where(X.type_suffix_filter("diagnosis_name", t))
    g = df.groupBy("diagnosis_name", "icd_code").agg(
        F.count_distinct("patient_id").alias("patients"),
        F.count(F.lit(1)).alias("total"))
    top = ordered_slice(g, [F.desc("patients"), *_asc("diagnosis_name", "icd_code")],
                        _check_limit(limit))
    return top.withColumn("condition_type", X.condition_type("diagnosis_name"))


def top_conditions_gold(diag_stats: DataFrame, condition_type: str = "",
                        limit: int = CONDITIONS_LIMIT_DEFAULT) -> DataFrame:
    """R9 (statistics path): the statistics table renamed, filtered by type,
    top ``limit`` by unique patients; plus the type label."""
    t = _type_param(condition_type)
    df = diag_stats
    if t and t != "all":
        df = df.where(F.col("diagnosis_name").ilike(X.like_pattern(f"%({t})")))
    out = df.select("diagnosis_name", "icd_code",
                    F.col("unique_patients").alias("patients"),
                    F.col("total_cases").alias("total"), "active_cases")
    top = ordered_slice(out, [F.desc("patients"), *_asc("diagnosis_name", "icd_code")],
                        _check_limit(limit))
    return top.withColumn("condition_type", X.condition_type("diagnosis_name"))


def _condition_types(names: DataFrame) -> DataFrame:
    # Distinct names first (combined map-side), so the regex runs once per name.
    distinct_names = names.where(F.col("diagnosis_name").isNotNull()
                                 & (F.col("diagnosis_name") != "")) \
                          .select("diagnosis_name").distinct()
    return (distinct_names.select(X.condition_type("diagnosis_name").alias("condition_type"))
                          .distinct())


def condition_types_clean(conditions: DataFrame) -> DataFrame:
    """Sorted distinct type labels of all non-empty diagnosis names."""
    return _condition_types(conditions).orderBy("condition_type")


def condition_types_gold(diag_stats: DataFrame) -> DataFrame:
    """The same over the statistics table."""
    return _condition_types(diag_stats).orderBy("condition_type")


def condition_labels(conditions: DataFrame) -> DataFrame:
    """E1 over data: every distinct diagnosis name (NULL included) with its label."""
    return (conditions.select("diagnosis_name").distinct()
                      .select("diagnosis_name",
                              X.condition_type("diagnosis_name").alias("condition_type")))


def _patient_filter(patients: DataFrame, q: str = "", gender: str = "",
                    age_group: str = "") -> DataFrame:
    q = (q or "").strip()
    gender = (gender or "").strip().lower()
    age_group = (age_group or "").strip()
    preds = []
    if q:
        pattern = X.like_pattern(f"%{q}%")
        preds.append(F.col("patient_id").ilike(pattern) | F.col("city").ilike(pattern)
                     | F.col("state").ilike(pattern))
    if gender:
        preds.append(F.lower("gender") == F.lit(gender))
    if age_group:
        preds.append(F.col("age_group") == F.lit(age_group))
    return patients.where(reduce(lambda a, b: a & b, preds)) if preds else patients


def page_bounds(page: int = 1, limit: int = PAGE_LIMIT_DEFAULT,
                max_limit: int = PAGE_LIMIT_MAX) -> tuple[int, int]:
    """(page, limit) as the route clamps them: page >= 1, limit <= ``max_limit``; a limit
    of 0 gives an empty page, a negative limit is an error (as the store rejects it)."""
    page = max(1, int(page))
    limit = min(max_limit, int(limit))
    if limit < 0:
        raise ValueError("limit must be >= 0")
    return page, limit


def patients_page(patients: DataFrame, page: int = 1, limit: int = PAGE_LIMIT_DEFAULT,
                  q: str = "", gender: str = "", age_group: str = "",
                  after: str | None = None, max_limit: int = PAGE_LIMIT_MAX,
                  directory: DataFrame | None = None,
                  places: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """One page of patients, one row per patient_id, ordered by patient_id.

    Filters run first, then DISTINCT ON patient_id keeps the smallest row by the
    other columns. ``after`` (keyset paging) replaces the offset: the page starts
    after that patient_id; on a patient-clustered table it also leaves out the folders
    before it.

    With the tier's ``directory`` (``operators.directory``) an unfiltered page looks up the few
    slices of ids that hold it and reads only their folders and row groups; with its ``places``
    (``operators.places``) a search reads only the places it matches. Otherwise a page
    is one lazy plan: a page within the first ``SHALLOW_ROWS`` rows is a top-k, which keeps that many
    rows a task at most; for one beyond, the distinct ids are counted per folder (at most 256
    and NULL), a running sum of the counts finds the folders that hold the page, and only their
    ids are ranked, folder by folder.
    """
    page, limit = page_bounds(page, limit, max_limit)
    offset = 0 if after is not None else (page - 1) * limit
    filtered = any((x or "").strip() for x in (q, gender, age_group))
    if directory is not None and not filtered and after is None:
        rows, skip = page_slice(patients, directory, offset, limit)
        return _ordered_rows(rows.select(*PATIENT_COLUMNS), skip, limit)
    found = search_rows(places, q or "") if places is not None else None
    df = _patient_filter(patients, q, gender, age_group) if found is None else _patient_filter(found, "", gender, age_group)
    folder = (F.col(X.PATIENT_BUCKET) if X.PATIENT_BUCKET in df.columns
              else X.patient_bucket("patient_id"))
    df = df.select(*PATIENT_COLUMNS, folder.alias("_folder"))
    if after is not None:
        df = df.where((F.col("patient_id") > F.lit(after))
                      & (F.col("_folder") >= X.patient_bucket(F.lit(after))))
    if offset + limit <= SHALLOW_ROWS:
        return _ordered_rows(df.select(*PATIENT_COLUMNS), offset, limit)
    ids = df.select("_folder", F.col("patient_id").alias("_pid")).distinct()
    end = F.sum("_n").over(Window.orderBy(F.asc_nulls_last("_folder")))
    held = (ids.groupBy("_folder").agg(F.count(F.lit(1)).alias("_n"))
            .select(F.col("_folder").alias("_f"), (end - F.col("_n")).alias("_start"), end.alias("_end"))
            .where((F.col("_start") < offset + limit) & (F.col("_end") > offset)))
    rank = F.col("_start") + F.row_number().over(
        Window.partitionBy("_folder").orderBy(F.asc_nulls_last("_pid"))) - 1
    # The folder list has at most 257 rows and the id list at most ``limit``: both are broadcast.
    ids = (ids.join(F.broadcast(held), F.col("_folder").eqNullSafe(F.col("_f")))
           .withColumn("_rank", rank).where((F.col("_rank") >= offset) & (F.col("_rank") < offset + limit))
           .select(F.col("_f"), "_pid"))
    rows = df.join(F.broadcast(ids), F.col("patient_id").eqNullSafe(F.col("_pid"))
                   & F.col("_folder").eqNullSafe(F.col("_f")), "left_semi").select(*PATIENT_COLUMNS)
    return _ordered_rows(rows, 0, limit)


def _ordered_rows(rows: DataFrame, skip: int, limit: int) -> DataFrame:
    out = first_row_per_key(rows, "patient_id").select(*PATIENT_COLUMNS).orderBy(F.asc_nulls_last("patient_id"))
    return out.offset(skip).limit(limit) if skip else out.limit(limit)


def patients_total(patients: DataFrame, q: str = "", gender: str = "",
                   age_group: str = "", directory: DataFrame | None = None,
                   places: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Number of distinct patient_id under the same filters (one row, ``total``); without filters the
    sum of the tier's ``directory``, if given. A search goes through its ``places``, if given."""
    if directory is not None and not any((x or "").strip() for x in (q, gender, age_group)):
        return directory.agg(F.coalesce(F.sum("ids"), F.lit(0)).alias("total"))
    found = search_rows(places, q or "") if places is not None else None
    df = _patient_filter(patients, q, gender, age_group) if found is None else _patient_filter(found, "", gender, age_group)
    return df.select("patient_id").distinct().agg(F.count(F.lit(1)).alias("total"))


def _patient_rows(df: DataFrame, patient_id: str) -> DataFrame:
    """Rows of one patient. On a patient-clustered table (it has the folder column)
    the folder of the key is added as a predicate, so the scan prunes to one folder
    and, by the Parquet statistics, to the row groups holding the key."""
    pred = F.col("patient_id") == F.lit(patient_id)
    if X.PATIENT_BUCKET in df.columns:
        pred = pred & (F.col(X.PATIENT_BUCKET) == X.patient_bucket(F.lit(patient_id)))
    return df.where(pred)


def patient_encounters(encounters: DataFrame, patient_id: str,
                       limit: int = ENCOUNTERS_PER_PATIENT) -> DataFrame:
    """A patient's latest encounters, start_date descending with NULLs first.

    A plain top-k: k is small and the input is one patient's rows; on the clustered
    tier the scan is one folder, so its merge reads few partitions × k rows."""
    cols = ["encounter_id", "encounter_class", "encounter_type", "start_date", "end_date"]
    return (_patient_rows(encounters, patient_id).select(*cols)
                      .orderBy(F.desc_nulls_first("start_date"),
                               *_asc("encounter_id", "encounter_class", "encounter_type",
                                     "end_date"))
                      .limit(limit))


def patient_conditions(conditions: DataFrame, patient_id: str,
                       limit: int = CONDITIONS_PER_PATIENT) -> DataFrame:
    """A patient's latest conditions, onset_date descending with NULLs last."""
    cols = ["diagnosis_name", "icd_code", "clinical_status", "onset_date"]
    return (_patient_rows(conditions, patient_id).select(*cols)
                      .orderBy(F.desc_nulls_last("onset_date"),
                               *_asc("diagnosis_name", "icd_code", "clinical_status"))
                      .limit(limit))


def gender_ranked(demographics_gender: DataFrame) -> DataFrame:
    """The gender table by count descending."""
    return demographics_gender.select("gender", "count", "percentage") \
                              .orderBy(F.desc("count"), F.asc_nulls_first("gender"))


def patient_genders(patients: DataFrame) -> DataFrame:
    """Sorted distinct lower-cased genders (NULL excluded)."""
    return (patients.where(F.col("gender").isNotNull())
                    .select(F.lower("gender").alias("gender")).distinct().orderBy("gender"))


def age_ranked(demographics_age_group: DataFrame) -> DataFrame:
    """The age table in display-rank order (unknown labels last)."""
    return demographics_age_group.select("age_group", "count") \
                                 .orderBy(X.age_rank("age_group"), F.asc_nulls_first("age_group"))


def geography_ranked(demographics_geography: DataFrame) -> DataFrame:
    """The state table by patient count descending."""
    return demographics_geography.select("state", "patient_count") \
                                 .orderBy(F.desc("patient_count"), F.asc_nulls_first("state"))


def diagnoses_by_gender_top(diagnosis_by_gender: DataFrame, limit: int = TOP_DIAGNOSES) -> DataFrame:
    """The 20 largest (diagnosis, gender) cells."""
    cells = diagnosis_by_gender.select("gender", "diagnosis_name", "icd_code",
                                       F.col("cases").alias("case_count"))
    return ordered_slice(cells, [F.desc("case_count"),
                                 *_asc("icd_code", "diagnosis_name", "gender")],
                         _check_limit(limit))


def diagnoses_by_age_top(diagnosis_by_age_group: DataFrame, limit: int = TOP_DIAGNOSES) -> DataFrame:
    """The 20 largest (diagnosis, age group) cells."""
    cells = diagnosis_by_age_group.select("age_group", "diagnosis_name", "icd_code",
                                          F.col("cases").alias("case_count"))
    return ordered_slice(cells, [F.desc("case_count"),
                                 *_asc("icd_code", "diagnosis_name", "age_group")],
                         _check_limit(limit))
