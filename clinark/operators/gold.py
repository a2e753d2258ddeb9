"""Gold aggregates over the clean tables: J1 and A1-A6.

All are lazy DataFrames. Orderings that the store would forget are not applied
here (sort at read time, see ``serving``); top-k tables get a total order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinark.functions import exprs as X
from clinark.operators.ranking import ordered_slice

DEMOGRAPHIC_COLUMNS = ["patient_id", "gender", "age_group", "state"]
#: Conditions that one task takes of a patient; those of a patient who has more are dealt to several tasks.
HOT_ROWS = 1 << 20


def conditions_with_demographics(conditions: DataFrame, patients: DataFrame) -> DataFrame:
    """Every condition with its patient's gender, age group and state (LEFT join;
    orphan and NULL-key conditions keep NULL demographics; duplicate patients fan out).

    No hint: at scale both sides are large and the adaptive planner picks broadcast or
    sort-merge from runtime sizes, and splits a skewed partition of the preserved side.
    A NULL key never matches, yet would hash all such rows into one shuffle partition;
    those rows join on a deterministic per-row salt instead (a value no patient key
    can take), so they spread over all partitions and still find no partner.
    """
    salt = F.concat(F.lit("\u0000"), F.xxhash64(*conditions.columns).cast("string"))
    left = conditions.withColumn("_join_key", F.coalesce(F.col("patient_id"), salt))
    right = patients.select(F.col("patient_id").alias("_join_key"),
                            *DEMOGRAPHIC_COLUMNS[1:])
    return left.join(right, "_join_key", "left").drop("_join_key")


def conditions_with_demographics_bucketed(conditions: DataFrame, patients: DataFrame) -> DataFrame:
    """J1 on tables bucketed by patient (``sources.catalog.write_bucketed``): the join meets bucket by bucket,
    without a shuffle. Conditions without a patient find no partner, so they stay out of the join and its
    buckets; nothing splits the bucket of a hot patient here, for which J1 over shuffled rows is the better plan."""
    key = F.col("patient_id")
    demographics = patients.select(*DEMOGRAPHIC_COLUMNS)
    known = conditions.where(key.isNotNull()).join(demographics, "patient_id", "left").select(
        *conditions.columns, *DEMOGRAPHIC_COLUMNS[1:])
    unknown = conditions.where(key.isNull()).select(
        "*", *(F.lit(None).cast("string").alias(c) for c in DEMOGRAPHIC_COLUMNS[1:]))
    return known.unionByName(unknown)


def diagnosis_statistics(conditions: DataFrame, n: int | None = None) -> DataFrame:
    """A1: per (icd_code, diagnosis_name): total_cases, unique_patients (exact distinct,
    NULL not counted), active_cases. Every diagnosis, or for a report the top ``n`` by
    total_cases with the group keys as tie-break (NULLs first)."""
    agg = conditions.groupBy("icd_code", "diagnosis_name").agg(
        F.count(F.lit(1)).alias("total_cases"),
        F.count_distinct("patient_id").alias("unique_patients"),
        F.count_if(F.col("clinical_status") == "active").alias("active_cases"),
    )
    return _top(agg, n)


def _top(statistics: DataFrame, n: int | None) -> DataFrame:
    order = [F.desc("total_cases"), F.asc_nulls_first("icd_code"),
             F.asc_nulls_first("diagnosis_name")]
    return statistics if n is None else ordered_slice(statistics, order, n)


def demographics_gender(patients: DataFrame) -> DataFrame:
    """A2: patients per gender (NULL is a group) and the share in percent, rounded
    half-up to 2 places. The total is a window sum over the few grouped rows, so the
    patients table is scanned once and no separate count job runs."""
    return gender_shares(patients.groupBy("gender").agg(F.count(F.lit(1)).alias("count")))


def gender_shares(counts: DataFrame) -> DataFrame:
    """A2's shares from patients per gender."""
    total = F.sum("count").over(Window.partitionBy())
    return counts.select("gender", "count",
                    F.round(F.try_divide(F.col("count"), total) * 100, 2).alias("percentage"))


def demographics_age_group(patients: DataFrame) -> DataFrame:
    """A3: patients per age group."""
    return patients.groupBy("age_group").agg(F.count(F.lit(1)).alias("count"))


def demographics_geography(patients: DataFrame) -> DataFrame:
    """A4: patients per state."""
    return patients.groupBy("state").agg(F.count(F.lit(1)).alias("patient_count"))


def patient_diagnoses(conditions: DataFrame) -> DataFrame:
    """Conditions per (patient_id, icd_code, diagnosis_name): ``_n`` rows, ``_active``
    of them active. The shared first step of the statistics and the demographic
    splits; the batch job writes it once and derives both from it."""
    return conditions.groupBy("patient_id", "icd_code", "diagnosis_name").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("clinical_status") == "active").alias("_active"))


def diagnosis_statistics_from(pre: DataFrame, n: int | None = None) -> DataFrame:
    """A1 from ``patient_diagnoses``: each of its rows is one patient of a diagnosis, so
    counting non-NULL patient ids is the exact distinct count."""
    agg = pre.groupBy("icd_code", "diagnosis_name").agg(
        F.sum("_n").cast("long").alias("total_cases"),
        F.count("patient_id").alias("unique_patients"),
        F.sum("_active").cast("long").alias("active_cases"),
    )
    return _top(agg, n)


def _cases_by(conditions: DataFrame, patients: DataFrame, demographics: list[str]) -> DataFrame:
    """Cases of J1 per (icd_code, diagnosis_name, *demographics), without materialising
    the fan-out.

    Both sides are pre-aggregated before the join — conditions per (patient, code,
    name), patients per (patient, *demographics) — and the join multiplies the counts.
    ``conditions`` may already be that pre-aggregate (``patient_diagnoses``).
    A hot patient key (or the NULL key) thus reaches the join as a handful of rows,
    not a third of the table. Unmatched conditions count once with NULL demographics,
    as in the left join.
    """
    c = patient_diagnoses(conditions) if "_n" not in conditions.columns else conditions
    p = patients.groupBy("patient_id", *demographics).agg(F.count(F.lit(1)).alias("_m"))
    j = c.join(p, "patient_id", "left")
    return j.groupBy("icd_code", "diagnosis_name", *demographics).agg(
        F.sum(F.col("_n") * F.coalesce(F.col("_m"), F.lit(1))).alias("cases"))


def people(before: DataFrame | None, new: DataFrame) -> DataFrame:
    """Per packed patient key ``_people``: an entry per (gender, age_group) with the number of patient rows
    before a batch and after it. Both inputs: (patient_id, gender, age_group, _m)."""
    none = F.lit(0).cast("long")
    rows = new.select(X.packed_key("patient_id").alias("_k"), "gender", "age_group", none.alias("_before"), "_m")
    if before is not None:
        rows = rows.unionByName(before.select(X.packed_key("patient_id").alias("_k"), "gender", "age_group",
                                              F.col("_m").alias("_before"), "_m"))
    rows = rows.where(F.col("_k").isNotNull()).groupBy("_k", "gender", "age_group").agg(
        F.sum("_before").alias("before"), F.sum("_m").alias("after"))
    return rows.groupBy("_k").agg(F.collect_list(F.struct("gender", "age_group", "before", "after")).alias("_people"))


def with_people(rows: DataFrame, people: DataFrame) -> DataFrame:
    """``rows`` (a row per packed key and diagnosis: ``_old`` cases before a batch, ``_n`` and ``_active`` of the batch)
    with their patients' ``_people``; rows that the batch changes nothing of go."""
    changed = F.exists("_people", lambda p: p["before"] != p["after"])
    return rows.join(people, "_k", "left").where((F.col("_n") > 0) | F.coalesce(changed, F.lit(False)))


def diagnosis_cells(rows: DataFrame) -> DataFrame:
    """What a batch adds, per (icd_code, diagnosis_name, gender, age_group): J1 ``cases``, and in whichever cells of
    the diagnosis its total_cases, unique_patients and active_cases. From ``with_people``: the A1, A5 and A6
    differences are roll-ups of it. Cases of a patient who has no row count once with NULL demographics."""
    old, n = F.col("_old"), F.col("_n")
    nobody = F.lit(None).cast("string")

    def cell(gender: Column, age_group: Column, cases: Column) -> Column:
        return F.struct(gender.alias("gender"), age_group.alias("age_group"), cases.cast("long").alias("cases"))
    known = F.transform("_people", lambda p: cell(p["gender"], p["age_group"], (old + n) * p["after"] - old * p["before"]))
    # A patient who comes after their conditions moves these out of the NULL group.
    came = (old > 0) & ~F.exists("_people", lambda p: p["before"] > 0)
    cells = F.when(F.col("_people").isNull(), F.array(cell(nobody, nobody, n))).when(
        came, F.concat(known, F.array(cell(nobody, nobody, -old)))).otherwise(known)
    once = F.col("_at") == 0
    found = (n > 0) & (old == 0) & F.col("_k").isNotNull()
    return rows.select("icd_code", "diagnosis_name", "_k", "_old", "_n", "_active", F.posexplode(cells).alias("_at", "_cell")).groupBy(
        "icd_code", "diagnosis_name", F.col("_cell.gender").alias("gender"), F.col("_cell.age_group").alias("age_group")).agg(
        F.sum("_cell.cases").alias("cases"),
        F.sum(F.when(once, n).otherwise(0)).cast("long").alias("total_cases"),
        F.count_if(once & found).alias("unique_patients"),
        F.sum(F.when(once, F.col("_active")).otherwise(0)).cast("long").alias("active_cases"))


def packed_diagnoses(conditions: DataFrame) -> DataFrame:
    """``patient_diagnoses`` by packed key ``_k``."""
    packed = conditions.select(X.packed_key("patient_id").alias("_k"), "icd_code", "diagnosis_name", "clinical_status")
    return packed.groupBy("_k", "icd_code", "diagnosis_name").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("clinical_status") == "active").alias("_active"))


def cells_of_all(conditions: DataFrame, people: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``diagnosis_cells`` of whole tables (a batch before which there was nothing), in one shuffle of the conditions:
    by patient, for the counts and the join. Rows that lie by patient in their files stay beside each other in it, so
    that a key is nearly free.

    A patient with more than ``hot_rows`` conditions is dealt to as many parts as needed by diagnosis and meets a copy
    of their ``_people`` in each; there are at most 1 / ``hot_rows`` as many of them as conditions, so they are
    broadcast. Conditions without a patient meet nobody and are dealt by diagnosis."""
    key, no = F.col("_k"), F.lit(0).cast("long")
    counts = conditions.where(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(F.count(F.lit(1)).alias("_rows"))
    hot = F.broadcast(counts.where(F.col("_rows") > hot_rows).select(
        X.packed_key("patient_id").alias("_k"), F.ceil(F.col("_rows") / hot_rows).alias("_parts")))
    packed = conditions.select(X.packed_key("patient_id").alias("_k"), "icd_code", "diagnosis_name", "clinical_status")
    diagnosis = F.xxhash64("icd_code", "diagnosis_name")
    part = F.when(key.isNull(), diagnosis).when(F.col("_parts").isNull(), no).otherwise(F.pmod(diagnosis, F.col("_parts")))
    rows = packed.join(hot, "_k", "left").withColumn("_part", part).drop("_parts").repartition("_k", "_part")
    rows = rows.groupBy("_k", "_part", "icd_code", "diagnosis_name").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("clinical_status") == "active").alias("_active"))
    parts = F.explode(F.sequence(no, F.coalesce(F.col("_parts") - 1, no)))
    copies = people.join(hot, "_k", "left").withColumn("_part", parts)
    copies = copies.select("_k", "_part", F.posexplode("_people").alias("_at", "_p")).select(
        "_k", "_part", "_at", "_p.gender", "_p.age_group", F.col("_p.after").alias("_m"))
    once = F.coalesce(F.col("_at"), F.lit(0)) == 0
    return rows.join(copies, ["_k", "_part"], "left").groupBy("icd_code", "diagnosis_name", "gender", "age_group").agg(
        F.sum(F.col("_n") * F.coalesce("_m", F.lit(1))).alias("cases"),
        F.sum(F.when(once, F.col("_n")).otherwise(0)).cast("long").alias("total_cases"),
        F.count_if(once & key.isNotNull()).alias("unique_patients"),
        F.sum(F.when(once, F.col("_active")).otherwise(0)).cast("long").alias("active_cases"))


def diagnosis_statistics_of_cells(cells: DataFrame, n: int | None = None) -> DataFrame:
    """A1 from ``diagnosis_cells``."""
    counts = ("total_cases", "unique_patients", "active_cases")
    return _top(cells.groupBy("icd_code", "diagnosis_name").agg(*(F.sum(c).cast("long").alias(c) for c in counts)), n)


def diagnosis_demographics(conditions: DataFrame, patients: DataFrame) -> DataFrame:
    """J1 cases per (icd_code, diagnosis_name, gender, age_group): the shared input of
    A5 and A6 when both are built (the batch job writes it once, rolls it up twice)."""
    return _cases_by(conditions, patients, ["gender", "age_group"])


def diagnosis_by_gender(conditions: DataFrame | None, patients: DataFrame | None,
                        pre: DataFrame | None = None) -> DataFrame:
    """A5: J1 cases per (icd_code, diagnosis_name, gender); from ``pre`` if given."""
    if pre is None:
        return _cases_by(conditions, patients, ["gender"])
    return pre.groupBy("icd_code", "diagnosis_name", "gender").agg(
        F.sum("cases").alias("cases"))


def diagnosis_by_age_group(conditions: DataFrame | None, patients: DataFrame | None,
                           pre: DataFrame | None = None) -> DataFrame:
    """J1 cases per (icd_code, diagnosis_name, age_group); from ``pre`` if given."""
    if pre is None:
        return _cases_by(conditions, patients, ["age_group"])
    return pre.groupBy("icd_code", "diagnosis_name", "age_group").agg(
        F.sum("cases").alias("cases"))
