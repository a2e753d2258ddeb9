"""Independent DuckDB SQL for each registered query (the correctness oracle).

Written from the mapping in FIXTURES.md §3 and the route semantics, directly on
the star tables: the clean tiers are derived as flat SQL (no nested JSON), so
this checks the nested extraction, hashing, filters and aggregates of the Spark
side rather than repeating them. Counts and sums are cast to BIGINT (DuckDB's
integer sum is HUGEINT); NULL order is always explicit.
"""

from __future__ import annotations


def _iso(ts: str) -> str:
    return (f"(CAST(year({ts}) + 24 AS VARCHAR) || substr(CAST(CAST({ts} AS DATE) AS VARCHAR), 5)"
            f" || 'T09:00:00-05:00')")


def _date(ts: str) -> str:
    return f"(CAST(year({ts}) + 24 AS VARCHAR) || substr(CAST(CAST({ts} AS DATE) AS VARCHAR), 5))"


CLEAN_PATIENTS = """
clean_patients AS (
  SELECT sha256('pat-' || k) AS patient_id, gender, birth_year, state, city,
         CASE WHEN TRY_CAST(birth_year AS INTEGER) >= 2000 THEN '0-25'
              WHEN TRY_CAST(birth_year AS INTEGER) >= 1975 THEN '26-50'
              WHEN TRY_CAST(birth_year AS INTEGER) >= 1950 THEN '51-75'
              ELSE '75+' END AS age_group
  FROM (
    SELECT c.c_custkey AS k,
           CASE WHEN c.c_custkey % 97 = 0 THEN NULL
                WHEN c.c_custkey % 10 = 0 THEN 'Male'
                WHEN c.c_custkey % 2 = 0 THEN 'male'
                ELSE 'female' END AS gender,
           CASE WHEN c.c_custkey % 89 = 0 THEN NULL
                WHEN c.c_custkey % 83 = 0 THEN 'unkn'
                ELSE CAST(1930 + (c.c_custkey * 7) % 90 AS VARCHAR) END AS birth_year,
           CASE WHEN c.c_custkey % 101 = 0 THEN NULL ELSE r.r_name END AS state,
           CASE WHEN d.dup THEN 'ZZ_DUP'
                WHEN c.c_custkey % 101 = 0 THEN NULL
                ELSE n.n_name END AS city
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    JOIN (VALUES (false), (true)) AS d(dup) ON (NOT d.dup OR c.c_custkey % 53 = 0)
  ) t
  WHERE k % 211 <> 0
)"""

CLEAN_CONDITIONS = f"""
clean_conditions AS (
  SELECT 'cond-' || l.l_orderkey || '-' || l.l_linenumber AS condition_id,
         CASE WHEN l.l_orderkey % 97 = 0 THEN NULL ELSE sha256('pat-' || o.o_custkey) END
           AS patient_id,
         'SCT' || (p.p_partkey % 300) AS icd_code,
         CASE p.p_type WHEN 'ECONOMY' THEN p.p_name || ' (disorder)'
                       WHEN 'MEDIUM' THEN p.p_name || ' (finding)'
                       WHEN 'PROMO' THEN p.p_name || ' (situation)'
                       WHEN 'STANDARD' THEN p.p_name || ' (Procedure) '
                       WHEN 'LARGE' THEN p.p_name
                       ELSE NULL END AS diagnosis_name,
         CASE l.l_returnflag WHEN 'N' THEN 'active' WHEN 'A' THEN 'resolved' END
           AS clinical_status,
         {_iso('l.l_shipdate')} AS onset_date
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  WHERE (l.l_orderkey + l.l_linenumber) % 61 <> 0
)"""

CLEAN_ENCOUNTERS = f"""
clean_encounters AS (
  SELECT 'enc-' || o_orderkey AS encounter_id,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE sha256('pat-' || o_custkey) END
           AS patient_id,
         CASE o_orderstatus WHEN 'F' THEN 'AMB' WHEN 'O' THEN 'EMER' WHEN 'P' THEN 'IMP' END
           AS encounter_class,
         CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderpriority END AS encounter_type,
         CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE {_iso('o_orderdate')} END AS start_date,
         CASE WHEN o_orderkey % 107 = 0 THEN NULL ELSE {_iso('o_orderdate')} END AS end_date
  FROM orders
)"""


def _clean_medications(hashed: bool) -> str:
    kept = "sha256(patient_id) AS patient_id" if hashed else "patient_id"
    return f"""
med_rows AS (
  SELECT 'med-' || l.l_orderkey || '-' || l.l_linenumber AS med_id,
         'pat-' || o.o_custkey AS patient_id,
         'enc-' || l.l_orderkey AS encounter_id,
         CASE WHEN l.l_orderkey % 103 = 0 THEN NULL ELSE {_date('l.l_shipdate')} END AS start_date,
         'RX' || p.p_partkey AS drug_code,
         p.p_name AS drug_name,
         CASE WHEN l.l_linenumber = 7 THEN NULL
              ELSE CAST(CAST(trunc(l.l_quantity) AS BIGINT) AS VARCHAR) || ' tablets' END AS dose,
         '' AS route,
         CASE l.l_linestatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'completed' END AS status
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_orderkey % 101 <> 0
),
clean_medications AS (
  SELECT med_id, {kept}, encounter_id, start_date, drug_code, drug_name, dose, route, status
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY med_id
      ORDER BY patient_id ASC NULLS FIRST, encounter_id ASC NULLS FIRST,
               start_date ASC NULLS FIRST, drug_code ASC NULLS FIRST,
               drug_name ASC NULLS FIRST, dose ASC NULLS FIRST, route ASC NULLS FIRST,
               status ASC NULLS FIRST) AS rn
    FROM med_rows) x
  WHERE rn = 1
)"""


DIAG_STATS = """
diag_stats AS (
  SELECT icd_code, diagnosis_name,
         CAST(count(*) AS BIGINT) AS total_cases,
         CAST(count(DISTINCT patient_id) AS BIGINT) AS unique_patients,
         CAST(sum(CASE WHEN clinical_status = 'active' THEN 1 ELSE 0 END) AS BIGINT) AS active_cases
  FROM clean_conditions
  GROUP BY icd_code, diagnosis_name
)"""

JOINED = """
joined AS (
  SELECT c.*, p.gender, p.age_group, p.state
  FROM clean_conditions c
  LEFT JOIN clean_patients p ON c.patient_id = p.patient_id
)"""

BY_GENDER = """
by_gender AS (
  SELECT icd_code, diagnosis_name, gender, CAST(count(*) AS BIGINT) AS cases
  FROM joined GROUP BY icd_code, diagnosis_name, gender
)"""

BY_AGE = """
by_age AS (
  SELECT icd_code, diagnosis_name, age_group, CAST(count(*) AS BIGINT) AS cases
  FROM joined GROUP BY icd_code, diagnosis_name, age_group
)"""

GENDER_STATS = """
gender_stats AS (
  SELECT gender, CAST(count(*) AS BIGINT) AS count,
         round(CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100, 2)
           AS percentage
  FROM clean_patients GROUP BY gender
)"""

AGE_STATS = """
age_stats AS (
  SELECT age_group, CAST(count(*) AS BIGINT) AS count FROM clean_patients GROUP BY age_group
)"""

GEO_STATS = """
geo_stats AS (
  SELECT state, CAST(count(*) AS BIGINT) AS patient_count FROM clean_patients GROUP BY state
)"""

LABEL = ("CASE WHEN {c} IS NULL OR {c} = '' THEN 'unknown' "
         "WHEN regexp_extract({c}, '\\(([^)]+)\\)\\s*$', 1) = '' THEN 'other' "
         "ELSE lower(regexp_extract({c}, '\\(([^)]+)\\)\\s*$', 1)) END")


def _label(c: str) -> str:
    return LABEL.format(c=c)


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


PATIENT_ONE = "e7b2753c56bf198b605e7fd9431a52d3af4dcfcf2b118c21304ec66cc366f829"


def _page_sql(where: str, offset: int, limit: int) -> str:
    return _with(CLEAN_PATIENTS) + f"""
SELECT patient_id, gender, birth_year, age_group, state, city FROM (
  SELECT *, row_number() OVER (
    PARTITION BY patient_id
    ORDER BY gender ASC NULLS FIRST, birth_year ASC NULLS FIRST, age_group ASC NULLS FIRST,
             state ASC NULLS FIRST, city ASC NULLS FIRST) AS rn
  FROM clean_patients {where}) d
WHERE rn = 1
ORDER BY patient_id
LIMIT {limit} OFFSET {offset}"""


SEARCH_WHERE = ("WHERE (patient_id ILIKE '%nation_1%' OR city ILIKE '%nation_1%' "
                "OR state ILIKE '%nation_1%')")


def oracle_sql() -> dict[str, str]:
    cp, cc, ce = CLEAN_PATIENTS, CLEAN_CONDITIONS, CLEAN_ENCOUNTERS
    q: dict[str, str] = {}
    q["normalize_patients"] = _with(cp) + "SELECT * FROM clean_patients"
    q["normalize_conditions"] = _with(cc) + "SELECT * FROM clean_conditions"
    q["normalize_encounters"] = _with(ce) + "SELECT * FROM clean_encounters"
    q["normalize_medications"] = _with(_clean_medications(False)) + "SELECT * FROM clean_medications"
    q["normalize_medications_hashed"] = (_with(_clean_medications(True))
                                         + "SELECT * FROM clean_medications")
    q["conditions_with_demographics"] = _with(cp, cc, JOINED) + "SELECT * FROM joined"
    q["diagnosis_statistics"] = _with(cc, DIAG_STATS) + """SELECT * FROM diag_stats
ORDER BY total_cases DESC, icd_code ASC NULLS FIRST, diagnosis_name ASC NULLS FIRST LIMIT 50"""
    q["demographics_gender"] = _with(cp, GENDER_STATS) + "SELECT * FROM gender_stats"
    q["demographics_age_group"] = _with(cp, AGE_STATS) + "SELECT * FROM age_stats"
    q["demographics_geography"] = _with(cp, GEO_STATS) + "SELECT * FROM geo_stats"
    q["diagnosis_by_gender"] = _with(cp, cc, JOINED, BY_GENDER) + "SELECT * FROM by_gender"
    q["diagnosis_by_age_group"] = _with(cp, cc, JOINED, BY_AGE) + "SELECT * FROM by_age"
    q["kpi"] = _with(cp, cc, ce, _clean_medications(False).strip(), DIAG_STATS) + """
SELECT (SELECT CAST(count(DISTINCT patient_id) AS BIGINT) FROM clean_patients) AS patients,
       (SELECT CAST(count(*) AS BIGINT) FROM clean_encounters) AS encounters,
       (SELECT CAST(count(*) AS BIGINT) FROM clean_conditions) AS conditions,
       (SELECT CAST(count(*) AS BIGINT) FROM clean_medications) AS medications,
       (SELECT CAST(coalesce(sum(active_cases), 0) AS BIGINT) FROM diag_stats) AS active_cases"""
    q["timeline"] = _with(ce) + """
SELECT strftime(TRY_CAST(substr(start_date, 1, 10) AS DATE), '%Y-%m') AS month,
       CAST(count(*) AS BIGINT) AS count
FROM clean_encounters
WHERE start_date >= '2023-01-01'
  AND TRY_CAST(substr(start_date, 1, 10) AS DATE) IS NOT NULL
GROUP BY 1"""
    top_clean = """
SELECT diagnosis_name, icd_code, patients, total, {label} AS condition_type FROM (
  SELECT diagnosis_name, icd_code, CAST(count(DISTINCT patient_id) AS BIGINT) AS patients,
         CAST(count(*) AS BIGINT) AS total
  FROM clean_conditions {where}
  GROUP BY diagnosis_name, icd_code
  ORDER BY patients DESC, diagnosis_name ASC NULLS FIRST, icd_code ASC NULLS FIRST
  LIMIT 50) t"""
    q["top_conditions_clean"] = _with(cc) + top_clean.format(label=_label("diagnosis_name"), where="")
    q["top_conditions_clean_type"] = _with(cc) + top_clean.format(
        label=_label("diagnosis_name"), where="WHERE lower(diagnosis_name) LIKE '%(disorder)'")
    top_gold = """
SELECT diagnosis_name, icd_code, unique_patients AS patients, total_cases AS total,
       active_cases, {label} AS condition_type
FROM diag_stats {where}
ORDER BY unique_patients DESC, diagnosis_name ASC NULLS FIRST, icd_code ASC NULLS FIRST
LIMIT 50"""
    q["top_conditions_gold"] = _with(cc, DIAG_STATS) + top_gold.format(
        label=_label("diagnosis_name"), where="")
    q["top_conditions_gold_type"] = _with(cc, DIAG_STATS) + top_gold.format(
        label=_label("diagnosis_name"), where="WHERE diagnosis_name ILIKE '%(disorder)'")
    types = """
SELECT DISTINCT {label} AS condition_type FROM {table}
WHERE diagnosis_name IS NOT NULL AND diagnosis_name <> ''"""
    q["condition_types_clean"] = _with(cc) + types.format(
        label=_label("diagnosis_name"), table="clean_conditions")
    q["condition_types_gold"] = _with(cc, DIAG_STATS) + types.format(
        label=_label("diagnosis_name"), table="diag_stats")
    q["condition_type"] = _with(cc) + f"""
SELECT diagnosis_name, {_label('diagnosis_name')} AS condition_type
FROM (SELECT DISTINCT diagnosis_name FROM clean_conditions) t"""
    q["patients_page"] = _page_sql("", offset=25, limit=25)
    q["patients_page_deep"] = _page_sql("", offset=975, limit=25)
    q["patients_page_search_escape"] = _page_sql(
        "WHERE (" + " OR ".join(f"{c} ILIKE '%n\\ation\\_1%' ESCAPE '\\'" for c in ("patient_id", "city", "state")) + ")",
        offset=0, limit=25)
    q["patients_page_search"] = _page_sql(SEARCH_WHERE, offset=0, limit=25)
    q["patients_page_filtered"] = _page_sql(
        "WHERE lower(gender) = 'male' AND age_group = '26-50'", offset=0, limit=25)
    q["patients_total"] = _with(cp) + """
SELECT CAST(count(*) AS BIGINT) AS total FROM (SELECT DISTINCT patient_id FROM clean_patients) t"""
    q["patients_total_filtered"] = _with(cp) + f"""
SELECT CAST(count(*) AS BIGINT) AS total FROM (
  SELECT DISTINCT patient_id FROM clean_patients {SEARCH_WHERE} AND lower(gender) = 'male') t"""
    q["patient_encounters"] = _with(ce) + f"""
SELECT encounter_id, encounter_class, encounter_type, start_date, end_date
FROM clean_encounters WHERE patient_id = '{PATIENT_ONE}'
ORDER BY start_date DESC NULLS FIRST, encounter_id ASC NULLS FIRST,
         encounter_class ASC NULLS FIRST, encounter_type ASC NULLS FIRST, end_date ASC NULLS FIRST
LIMIT 20"""
    q["patient_conditions"] = _with(cc) + f"""
SELECT diagnosis_name, icd_code, clinical_status, onset_date
FROM clean_conditions WHERE patient_id = '{PATIENT_ONE}'
ORDER BY onset_date DESC NULLS LAST, diagnosis_name ASC NULLS FIRST, icd_code ASC NULLS FIRST,
         clinical_status ASC NULLS FIRST
LIMIT 30"""
    q["gender_ranked"] = _with(cp, GENDER_STATS) + """
SELECT gender, count, percentage FROM gender_stats ORDER BY count DESC, gender ASC NULLS FIRST"""
    q["patient_genders"] = _with(cp) + """
SELECT DISTINCT lower(gender) AS gender FROM clean_patients WHERE gender IS NOT NULL ORDER BY 1"""
    # Display rank of the age-group labels.
    q["age_ranked"] = _with(cp, AGE_STATS) + """
SELECT age_group, count FROM age_stats
ORDER BY CASE age_group WHEN '0-18' THEN 1 WHEN '19-25' THEN 2 WHEN '26-50' THEN 3
                        WHEN '51-75' THEN 4 WHEN '75+' THEN 5 ELSE 6 END, age_group"""
    q["geography_ranked"] = _with(cp, GEO_STATS) + """
SELECT state, patient_count FROM geo_stats ORDER BY patient_count DESC, state ASC NULLS FIRST"""
    q["diagnoses_by_gender_top"] = _with(cp, cc, JOINED, BY_GENDER) + """
SELECT gender, diagnosis_name, icd_code, cases AS case_count FROM by_gender
ORDER BY cases DESC, icd_code ASC NULLS FIRST, diagnosis_name ASC NULLS FIRST,
         gender ASC NULLS FIRST
LIMIT 20"""
    q["diagnoses_by_age_top"] = _with(cp, cc, JOINED, BY_AGE) + """
SELECT age_group, diagnosis_name, icd_code, cases AS case_count FROM by_age
ORDER BY cases DESC, icd_code ASC NULLS FIRST, diagnosis_name ASC NULLS FIRST,
         age_group ASC NULLS FIRST
LIMIT 20"""
    q["parquet_roundtrip"] = q["normalize_conditions"]
    q["patient_conditions_clustered"] = q["patient_conditions"]
    for name in ("conditions_with_demographics", "diagnosis_by_gender"):
        q[f"{name}_bucketed"] = q[name]
    q["patients_page_places"] = q["patients_page_search"]
    q["patients_page_directory"] = q["patients_page_deep"]
    q["patients_total_directory"] = q["patients_total"]
    q["patient_encounters_clustered"] = q["patient_encounters"]
    q["catalog_tables"] = _with(cp, cc, ce) + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, "
        f"CAST(count(DISTINCT patient_id) AS BIGINT) AS n_patients, "
        f"CAST(count(CASE WHEN patient_id = '{PATIENT_ONE}' THEN 1 END) AS BIGINT) AS n_of_patient FROM clean_{t}"
        for t in ("patients", "conditions", "encounters"))
    q["ingest_routed"] = """
SELECT resource_type, CAST(sum(n) AS BIGINT) AS lines FROM (
  SELECT 'Patient' AS resource_type, count(*) AS n FROM customer
  UNION ALL SELECT 'Patient', count(*) FROM customer WHERE c_custkey % 53 = 0
  UNION ALL SELECT 'Encounter', count(*) FROM orders
  UNION ALL SELECT 'Condition', count(*) FROM lineitem
  UNION ALL SELECT 'MedicationRequest', count(*) FROM lineitem
  UNION ALL SELECT 'Observation', count(*) FROM orders WHERE o_orderkey % 61 = 0
  UNION ALL SELECT '_unmatched', count(*) FROM orders WHERE o_orderkey % 67 = 0
  UNION ALL SELECT '_unmatched', count(*) FROM orders WHERE o_orderkey % 71 = 0) t
WHERE n > 0
GROUP BY resource_type"""
    audit = _with(cp, cc, ce, _clean_medications(False).strip(), DIAG_STATS, GENDER_STATS,
                  AGE_STATS, GEO_STATS, JOINED, BY_GENDER, BY_AGE) + """
SELECT 'patients' AS "table", CAST(count(*) AS BIGINT) AS "rows" FROM clean_patients
UNION ALL SELECT 'conditions', count(*) FROM clean_conditions
UNION ALL SELECT 'encounters', count(*) FROM clean_encounters
UNION ALL SELECT 'medications', count(*) FROM clean_medications
UNION ALL SELECT 'diagnosis_statistics', count(*) FROM diag_stats
UNION ALL SELECT 'demographics_gender', count(*) FROM gender_stats
UNION ALL SELECT 'demographics_age_group', count(*) FROM age_stats
UNION ALL SELECT 'demographics_geography', count(*) FROM geo_stats
UNION ALL SELECT 'diagnosis_by_gender', count(*) FROM by_gender
UNION ALL SELECT 'diagnosis_by_age_group', count(*) FROM by_age"""
    q["load_audit"] = q["pipeline_published"] = audit
    q["run_ledger"] = _with(cp, cc) + """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM clean_patients) AS patients_processed,
       (SELECT CAST(count(*) AS BIGINT) FROM clean_conditions) AS conditions_processed,
       'success' AS status, true AS stamped"""
    q["pipeline_tables"] = audit + """
UNION ALL SELECT 'corrupt:patients', 0 UNION ALL SELECT 'corrupt:conditions', 0
UNION ALL SELECT 'corrupt:encounters', 0 UNION ALL SELECT 'corrupt:medications', 0
UNION ALL SELECT 'unmatched', (SELECT count(*) FROM orders WHERE o_orderkey % 67 = 0)
                          + (SELECT count(*) FROM orders WHERE o_orderkey % 71 = 0)"""
    q["raw_quarantine"] = " UNION ALL ".join(
        f"SELECT '{t}' AS resource, '{{\"resourceType\": \"{t}\", \"id\": ' || CAST(o_orderkey AS VARCHAR) AS line "
        f"FROM orders WHERE o_orderkey % 71 = 0" for t in ("Patient", "Condition", "Encounter", "MedicationRequest"))
    for name in ("diagnosis_by_gender", "diagnosis_by_age_group", "demographics_gender"):
        q[f"incremental_{name}"] = q[name]
    q["incremental_diagnosis_statistics"] = _with(cc, DIAG_STATS) + "SELECT * FROM diag_stats"
    q["pipeline_diagnosis_statistics"] = _with(cc, DIAG_STATS) + "SELECT * FROM diag_stats"
    q["pipeline_diagnosis_by_gender"] = q["diagnosis_by_gender"]
    q["pipeline_diagnosis_by_age_group"] = q["diagnosis_by_age_group"]
    return q
