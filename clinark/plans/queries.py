"""The registered queries: one per operator of the inventory, each (spark, sf_dir) →
DataFrame over the whole star-schema tables, with the parameters of FIXTURES.md."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clinark.operators import gold, serving
from clinark.plans.catalog import Dataset

# Parameters of the parameterised routes.
PATIENT_ONE = "e7b2753c56bf198b605e7fd9431a52d3af4dcfcf2b118c21304ec66cc366f829"  # sha2('pat-1')
TYPE_DISORDER = "disorder"
SEARCH_TEXT = "nation_1"
GENDER = "male"
AGE_GROUP = "26-50"
PAGE, PAGE_LIMIT = 2, 25
CATALOG_DB = "medical_check"
BUCKETED_DB = "medical_bucketed_check"
CHECK_BUCKETS = 16
DEEP_PAGE = 40
REPORT_ROWS = 50
SEARCH_ESCAPED = "n\\ation\\_1"  # a backslash makes the next character literal

Query = Callable[[SparkSession, str], DataFrame]


def _q(fn: Callable[[Dataset], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Dataset(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


READ_QUERIES: dict[str, Query] = {
    # normalisers
    "normalize_patients": _q(lambda d: d.patients),
    "normalize_conditions": _q(lambda d: d.conditions),
    "normalize_encounters": _q(lambda d: d.encounters),
    "normalize_medications": _q(lambda d: d.medications("plain")),
    "normalize_medications_hashed": _q(lambda d: d.medications("hashed")),
    # join and gold aggregates
    "conditions_with_demographics": _q(
        lambda d: gold.conditions_with_demographics(d.conditions, d.patients)),
    "diagnosis_statistics": _q(lambda d: gold.diagnosis_statistics(d.conditions, REPORT_ROWS)),
    "demographics_gender": _q(lambda d: d.demographics_gender),
    "demographics_age_group": _q(lambda d: d.demographics_age_group),
    "demographics_geography": _q(lambda d: d.demographics_geography),
    "diagnosis_by_gender": _q(lambda d: d.diagnosis_by_gender),
    "diagnosis_by_age_group": _q(lambda d: d.diagnosis_by_age_group),
    # serving routes
    "kpi": _q(lambda d: serving.kpi(d.patients, d.encounters, d.conditions,
                                    d.diagnosis_statistics, d.medications("plain"))),
    "timeline": _q(lambda d: serving.timeline(d.encounters)),
    "top_conditions_clean": _q(lambda d: serving.top_conditions_clean(d.conditions)),
    "top_conditions_clean_type": _q(
        lambda d: serving.top_conditions_clean(d.conditions, TYPE_DISORDER)),
    "top_conditions_gold": _q(lambda d: serving.top_conditions_gold(d.diagnosis_statistics)),
    "top_conditions_gold_type": _q(
        lambda d: serving.top_conditions_gold(d.diagnosis_statistics, TYPE_DISORDER)),
    "condition_types_clean": _q(lambda d: serving.condition_types_clean(d.conditions)),
    "condition_types_gold": _q(lambda d: serving.condition_types_gold(d.diagnosis_statistics)),
    "condition_type": _q(lambda d: serving.condition_labels(d.conditions)),
    "patients_page": _q(lambda d: serving.patients_page(d.patients, page=PAGE, limit=PAGE_LIMIT)),
    "patients_page_deep": _q(lambda d: serving.patients_page(
        d.patients, page=DEEP_PAGE, limit=PAGE_LIMIT)),
    "patients_page_search_escape": _q(lambda d: serving.patients_page(d.patients, q=SEARCH_ESCAPED)),
    "patients_page_search": _q(lambda d: serving.patients_page(d.patients, q=SEARCH_TEXT)),
    "patients_page_filtered": _q(
        lambda d: serving.patients_page(d.patients, gender=GENDER, age_group=AGE_GROUP)),
    "patients_total": _q(lambda d: serving.patients_total(d.patients)),
    "patients_total_filtered": _q(
        lambda d: serving.patients_total(d.patients, q=SEARCH_TEXT, gender=GENDER)),
    "patient_encounters": _q(lambda d: serving.patient_encounters(d.encounters, PATIENT_ONE)),
    "patient_conditions": _q(lambda d: serving.patient_conditions(d.conditions, PATIENT_ONE)),
    "gender_ranked": _q(lambda d: serving.gender_ranked(d.demographics_gender)),
    "patient_genders": _q(lambda d: serving.patient_genders(d.patients)),
    "age_ranked": _q(lambda d: serving.age_ranked(d.demographics_age_group)),
    "geography_ranked": _q(lambda d: serving.geography_ranked(d.demographics_geography)),
    "diagnoses_by_gender_top": _q(lambda d: serving.diagnoses_by_gender_top(d.diagnosis_by_gender)),
    "diagnoses_by_age_top": _q(lambda d: serving.diagnoses_by_age_top(d.diagnosis_by_age_group)),
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum slice: raw conditions → normalise → top-50 diagnosis statistics."""
    return READ_QUERIES["diagnosis_statistics"](spark, sf_dir)


# --- queries that go through sinks and sources (each run writes a fresh folder
# --- under the cluster's shared folder, see ``session.run_dir``) ---------------

def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the clean conditions as Parquet, read them back by declared schema."""
    from clinark.session import run_dir
    from clinark.sources.parquet import read_clean, write_parquet
    root = run_dir(spark, "parquet")
    write_parquet(Dataset(spark, sf_dir).conditions, f"{root}/conditions")
    return read_clean(spark, root, "conditions")


def _clustered_lookup(spark: SparkSession, sf_dir: str, name: str, lookup) -> DataFrame:
    from clinark.session import run_dir
    from clinark.sources.parquet import read_clean, write_clustered
    root = run_dir(spark, "clustered")
    d = Dataset(spark, sf_dir)
    write_clustered(getattr(d, name), f"{root}/{name}", name)
    return lookup(read_clean(spark, root, name, clustered=True), PATIENT_ONE)


def patient_conditions_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 clustered write + R10: the clean conditions written clustered by patient, then
    one patient's conditions read with folder and row-group pruning."""
    return _clustered_lookup(spark, sf_dir, "conditions", serving.patient_conditions)


def patient_encounters_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 clustered write + R8 on the clustered clean encounters."""
    return _clustered_lookup(spark, sf_dir, "encounters", serving.patient_encounters)


def _paged_tier(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from clinark.operators.directory import read_directory, write_directory
    from clinark.session import run_dir
    from clinark.sources.parquet import read_clean, write_clustered
    root = run_dir(spark, "paged")
    write_clustered(Dataset(spark, sf_dir).patients, f"{root}/patients", "patients")
    patients = read_clean(spark, root, "patients", clustered=True)
    write_directory(patients, root)
    return patients, read_directory(spark, root)


def patients_page_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean patients written clustered with their page directory, then a deep page that reads
    the directory and the folders that hold the page."""
    patients, directory = _paged_tier(spark, sf_dir)
    return serving.patients_page(patients, page=DEEP_PAGE, limit=PAGE_LIMIT, directory=directory)


def patients_total_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 from the page directory of the clustered tier."""
    patients, directory = _paged_tier(spark, sf_dir)
    return serving.patients_total(patients, directory=directory)


def patients_page_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean patients written by place with their dictionary, then a search that tries its text
    on the dictionary and reads the places it matches."""
    from clinark.operators.places import read_places, write_places
    from clinark.session import run_dir
    root = run_dir(spark, "places")
    write_places(Dataset(spark, sf_dir).patients, root)
    places = read_places(spark, root)
    return serving.patients_page(places[1], q=SEARCH_TEXT, places=places)


def pipeline_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed NDJSON → ingest → the batch job, published as a version; every gold and clean table's
    rows as a reader of the current version sees them."""
    from functools import reduce

    from pyspark.sql import functions as F

    from clinark.plans.jobs import GOLD_TABLES, publish_pipeline
    from clinark.session import run_dir
    from clinark.sources import tiers
    from clinark.sources.landing import land_mixed
    from clinark.sources.parquet import CLUSTERED_TABLES, read_clean
    from clinark.streaming.ingest import run_ingest
    root = run_dir(spark, "published")
    land_mixed(spark, sf_dir, f"{root}/landing")
    run_ingest(spark, f"{root}/landing", f"{root}/raw", f"{root}/_checkpoint")
    publish_pipeline(spark, f"{root}/raw", f"{root}/out")
    now = tiers.current(spark, f"{root}/out")
    tables = {n: read_clean(spark, f"{now}/gold", n) for n in GOLD_TABLES}
    tables |= {n: read_clean(spark, f"{now}/clean", n, clustered=n in CLUSTERED_TABLES)
               for n in ("patients", "conditions", "encounters", "medications")}
    return reduce(DataFrame.unionByName, [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
                                          for n, t in tables.items()])


def _bucketed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from clinark.session import run_dir
    from clinark.sources import fixtures
    from clinark.sources.catalog import analyze, write_bucketed
    d, root = Dataset(spark, sf_dir), run_dir(spark, "bucketed")
    # One task reads a bucket, so a larger table gets more of them.
    buckets = fixtures.shares(fixtures.star(spark, sf_dir, "lineitem"), CHECK_BUCKETS)
    names = write_bucketed(spark, {"conditions": d.conditions, "patients": d.patients}, root, BUCKETED_DB,
                           buckets=buckets, db_location=f"{root}/{BUCKETED_DB}.db")
    analyze(spark, names)
    return tuple(spark.table(n) for n in names)


def conditions_with_demographics_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 + J1: the clean tables bucketed by patient in the catalog, analysed, and joined without a shuffle."""
    return gold.conditions_with_demographics_bucketed(*_bucketed(spark, sf_dir))


def diagnosis_by_gender_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 + A5 on the bucketed tables: both pre-aggregates and their join need no shuffle."""
    return gold.diagnosis_by_gender(*_bucketed(spark, sf_dir))


BATCHES = 3


def _incremental(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from pyspark.sql import functions as F

        from clinark.plans.incremental import apply_batch, read_gold
        from clinark.session import run_dir
        d, root = Dataset(spark, sf_dir), run_dir(spark, "incremental")
        for i in range(BATCHES):                      # every row is in one batch, often not its patient's
            apply_batch(spark, root, f"batch{i}",
                        d.conditions.where(F.pmod(F.xxhash64("condition_id"), F.lit(BATCHES)) == i),
                        d.patients.where(F.pmod(F.xxhash64("patient_id", "city"), F.lit(BATCHES)) == i))
        return read_gold(spark, root, name)
    run.__doc__ = f"""A1-A6 by batch: the whole tables applied in {BATCHES} batches, then the {name} table."""
    return run


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three clean tables registered as external Parquet tables in a catalog
    database, then one SQL text with a bound parameter over all of them."""
    from clinark.session import run_dir
    from clinark.sources.catalog import CATALOG_TABLES, catalog_sql, register_clean
    from clinark.sources.parquet import write_parquet
    d = Dataset(spark, sf_dir)
    root = run_dir(spark, "catalog")
    for name in CATALOG_TABLES:
        write_parquet(getattr(d, name), f"{root}/{name}")
    tables = register_clean(spark, root, CATALOG_DB, replace=True, db_location=f"{root}/{CATALOG_DB}.db")
    counts = " UNION ALL ".join(
        f"SELECT '{t.split('.')[1]}' AS table_name, count(*) AS n_rows, "
        f"count(DISTINCT patient_id) AS n_patients, "
        f"count(CASE WHEN patient_id = :patient THEN 1 END) AS n_of_patient FROM {t}" for t in tables)
    return catalog_sql(spark, counts, {"patient": PATIENT_ONE})


def ingest_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all resources as mixed NDJSON, route them with the streaming ingest,
    and count the routed lines per resource type (read through the sink log)."""
    from clinark.session import run_dir
    from clinark.sources.landing import land_mixed
    from clinark.streaming.ingest import routed_counts, run_ingest
    root = run_dir(spark, "ingest")
    land_mixed(spark, sf_dir, f"{root}/landing")
    run_ingest(spark, f"{root}/landing", f"{root}/routed", f"{root}/_checkpoint")
    return routed_counts(spark, f"{root}/routed")


def pipeline_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed NDJSON → routing ingest → raw scans → clean → gold; the load audit
    (rows per written table, corrupt lines per resource)."""
    from clinark.plans.jobs import run_pipeline
    from clinark.session import run_dir
    from clinark.sources.landing import land_mixed
    from clinark.streaming.ingest import run_ingest
    root = run_dir(spark, "pipeline")
    land_mixed(spark, sf_dir, f"{root}/landing")
    run_ingest(spark, f"{root}/landing", f"{root}/raw", f"{root}/_checkpoint")
    return run_pipeline(spark, f"{root}/raw", f"{root}/out", layout="routed")


def _pipeline_gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from clinark.plans.jobs import run_pipeline
    from clinark.session import run_dir
    from clinark.sources.landing import land_mixed
    from clinark.sources.parquet import read_clean
    from clinark.streaming.ingest import run_ingest
    root = run_dir(spark, "pipeline")
    land_mixed(spark, sf_dir, f"{root}/landing")
    run_ingest(spark, f"{root}/landing", f"{root}/raw", f"{root}/_checkpoint")
    run_pipeline(spark, f"{root}/raw", f"{root}/out", layout="routed")
    return read_clean(spark, f"{root}/out/gold", name)


def pipeline_diagnosis_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The diagnosis statistics that the batch job wrote."""
    return _pipeline_gold(spark, sf_dir, "diagnosis_statistics")


def pipeline_diagnosis_by_gender(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The diagnoses by gender that the batch job wrote."""
    return _pipeline_gold(spark, sf_dir, "diagnosis_by_gender")


def pipeline_diagnosis_by_age_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The diagnoses by age group that the batch job wrote."""
    return _pipeline_gold(spark, sf_dir, "diagnosis_by_age_group")


def raw_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each resource's raw directory parsed once and split in one write; the lines that
    are no JSON object, as the quarantine tables hold them."""
    from functools import reduce

    from pyspark.sql import functions as F

    from clinark.operators import normalize
    from clinark.plans.jobs import CLEAN_JOBS
    from clinark.session import run_dir
    from clinark.sources.landing import land_by_type
    from clinark.sources.parquet import write_split
    from clinark.sources.raw import line_session, read_lines
    root = run_dir(spark, "quarantine")
    land_by_type(spark, sf_dir, f"{root}/raw")
    tables = []
    for resource, name, fn in (*CLEAN_JOBS, ("MedicationRequest", "medications", normalize.normalize_medications)):
        path = f"{root}/quarantine/{name}"
        lines = line_session(spark, f"{root}/raw", resource, layout="directory")
        write_split(fn(read_lines(lines, f"{root}/raw", resource, layout="directory")), f"{root}/clean/{name}", path, name)
        tables.append(spark.read.schema("line string").parquet(path).select(F.lit(resource).alias("resource"), "line"))
    return reduce(DataFrame.unionByName, tables)


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the clean tables, then the six gold tables built from the loaded clean
    tier; rows per load, observed during each write (every plan runs once)."""
    from clinark.plans.audit import AUDIT_SCHEMA, load_tables
    from clinark.plans.jobs import build_gold
    from clinark.session import run_dir
    d = Dataset(spark, sf_dir)
    root = run_dir(spark, "load")
    clean = load_tables(spark, {"patients": d.patients, "conditions": d.conditions,
                                "encounters": d.encounters,
                                "medications": d.medications("plain")},
                        root=f"{root}/clean")
    gold_rows = build_gold(spark, f"{root}/clean", f"{root}/gold")
    return spark.createDataFrame(list((clean | gold_rows).items()), AUDIT_SCHEMA)


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the clean patients and conditions, then append a run row with their
    counts to a fresh ledger and read it back. The run id and time differ on every
    run, so the result shows whether both are set (``stamped``) instead of their
    values."""
    from pyspark.sql import functions as F

    from clinark.plans.audit import append_run, load_tables, read_runs
    from clinark.session import run_dir
    d = Dataset(spark, sf_dir)
    root = run_dir(spark, "ledger")
    audit = load_tables(spark, {"patients": d.patients, "conditions": d.conditions}, root=root)
    append_run(spark, f"{root}/pipeline_runs", audit["patients"], audit["conditions"])
    runs = read_runs(spark, f"{root}/pipeline_runs")
    return runs.select("patients_processed", "conditions_processed", "status",
                       (F.col("run_id").isNotNull() & F.col("run_time").isNotNull())
                       .alias("stamped"))


WRITE_QUERIES: dict[str, Query] = {
    "parquet_roundtrip": parquet_roundtrip,
    "patient_conditions_clustered": patient_conditions_clustered,
    "patient_encounters_clustered": patient_encounters_clustered,
    "patients_page_directory": patients_page_directory,
    "patients_total_directory": patients_total_directory,
    "patients_page_places": patients_page_places,
    "catalog_tables": catalog_tables,
    "conditions_with_demographics_bucketed": conditions_with_demographics_bucketed,
    "diagnosis_by_gender_bucketed": diagnosis_by_gender_bucketed,
    "ingest_routed": ingest_routed,
    "pipeline_tables": pipeline_tables,
    "pipeline_published": pipeline_published,
    "pipeline_diagnosis_statistics": pipeline_diagnosis_statistics,
    "pipeline_diagnosis_by_gender": pipeline_diagnosis_by_gender,
    "pipeline_diagnosis_by_age_group": pipeline_diagnosis_by_age_group,
    "incremental_diagnosis_statistics": _incremental("diagnosis_statistics"),
    "incremental_diagnosis_by_gender": _incremental("diagnosis_by_gender"),
    "incremental_diagnosis_by_age_group": _incremental("diagnosis_by_age_group"),
    "incremental_demographics_gender": _incremental("demographics_gender"),
    "raw_quarantine": raw_quarantine,
    "load_audit": load_audit,
    "run_ledger": run_ledger,
}

ALL_QUERIES: dict[str, Query] = {**READ_QUERIES, **WRITE_QUERIES}
