"""The end-to-end batch job — raw NDJSON → clean Parquet → gold Parquet → loads.

One application. Each tier is written to its own directory and re-read from there
(never overwriting an input), which also cuts lineage: a lost executor recomputes
from the last written tier, not from the raw JSON. Row counts come from the writes
themselves (``observe``); a ledger row is appended at the end.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinark.operators import gold, normalize
from clinark.operators.directory import write_directory
from clinark.operators.places import write_places
from clinark.plans.audit import AUDIT_SCHEMA, append_run, load_tables, run_concurrently
from clinark.schemas import conform
from clinark.sources import tiers
from clinark.sources.jdbc import CONNECTIONS, write_jdbc
from clinark.sources.parquet import CLUSTERED_TABLES, read_clean, remove, write_parquet, write_split
from clinark.sources.raw import SHORT_SHUFFLES, line_session, read_lines, unmatched_lines, with_options

CLEAN_JOBS = (
    ("Patient", "patients", normalize.normalize_patients),
    ("Condition", "conditions", normalize.normalize_conditions),
    ("Encounter", "encounters", normalize.normalize_encounters),
)
GOLD_TABLES = ("diagnosis_statistics", "demographics_gender", "demographics_age_group",
               "demographics_geography", "diagnosis_by_gender", "diagnosis_by_age_group")
SERVING_TABLES = GOLD_TABLES + ("conditions", "patients", "encounters")
PRE_AGGREGATE = "_diagnosis_demographics"


@dataclass
class JdbcTarget:
    url: str
    properties: dict[str, str] = field(default_factory=dict)
    batchsize: int = 10000
    num_partitions: int = CONNECTIONS


def build_gold(spark: SparkSession, clean_root: str, gold_root: str,
               top_n: int | None = None, max_workers: int = 4, clustered: bool = False) -> dict[str, int]:
    """Six gold tables from the written clean tier; returns rows written per table.

    Conditions are shuffled once: dealt by patient, their aggregate per (patient, code, name) meets the
    patients, and what comes of it per (code, name, gender, age group) — J1 cases and the statistics'
    counts — is written and rolled up to the statistics and both demographic splits. (Their patient
    column is read once more before, for the patients with very many.) Independent writes run
    concurrently; the intermediate table is removed at the end.
    """
    cond = read_clean(spark, clean_root, "conditions", clustered=clustered)
    pts = read_clean(spark, clean_root, "patients", clustered=clustered)
    pre_path = f"{gold_root}/{PRE_AGGREGATE}"
    counted = pts.groupBy("patient_id", "gender", "age_group").agg(F.count(F.lit(1)).alias("_m"))
    pre = gold.cells_of_all(cond, gold.people(None, counted))

    def out(name: str, df: DataFrame):
        return lambda: write_parquet(conform(df, name), f"{gold_root}/{name}")

    first = run_concurrently({
        "demographics_gender": out("demographics_gender", gold.demographics_gender(pts)),
        "demographics_age_group": out("demographics_age_group", gold.demographics_age_group(pts)),
        "demographics_geography": out("demographics_geography", gold.demographics_geography(pts)),
        PRE_AGGREGATE: lambda: write_parquet(pre, pre_path),
    }, max_workers)
    first.pop(PRE_AGGREGATE)
    pre = spark.read.schema(pre.schema).parquet(pre_path)
    second = run_concurrently({
        "diagnosis_statistics": out("diagnosis_statistics", gold.diagnosis_statistics_of_cells(pre, top_n)),
        "diagnosis_by_gender": out("diagnosis_by_gender", gold.diagnosis_by_gender(None, None, pre)),
        "diagnosis_by_age_group": out("diagnosis_by_age_group",
                                      gold.diagnosis_by_age_group(None, None, pre)),
    }, max_workers)
    remove(spark, pre_path)
    return {name: (first | second)[name] for name in GOLD_TABLES}


def run_pipeline(spark: SparkSession, raw_root: str, out_root: str, layout: str = "routed",
                 patient_key: str = "hashed", jdbc: JdbcTarget | None = None,
                 top_n: int | None = None, max_workers: int = 4, cluster: bool = True,
                 ledger: str | None = None, run_id: str | None = None) -> DataFrame:
    """Run the whole job; returns the load audit as (table, rows). The tiers under ``out_root`` are
    overwritten table by table; ``publish_pipeline`` replaces them all at once.

    Tables: the three clean tables and medications (Parquet), the six gold tables,
    the number of corrupt raw lines dropped per resource (``corrupt:<table>``), the
    lines the ingest left unrouted (``unmatched``, routed layout only), and,
    with ``jdbc``, the nine serving tables plus medications loaded over JDBC
    (``jdbc:<table>``), read from the written Parquet rather than recomputed.
    With ``cluster`` (the default) patients, conditions and encounters are written
    clustered by patient, so the per-patient lookups prune to one folder and a few
    row groups (``sources.parquet.write_clustered``). Every run appends a ledger row
    (``pipeline_runs``, or ``ledger``): ``success`` at the end, or ``failed`` before the error is
    raised again. Clustered patients get their page directory
    and their places (``operators.directory``, ``operators.places``).
    """
    out_root = out_root.rstrip("/")
    clean_root, gold_root = f"{out_root}/clean", f"{out_root}/gold"
    audit: list[tuple[str, int]] = []

    own, spark = spark, with_options(spark, SHORT_SHUFFLES)

    def clean_stage(resource, name, fn):
        def run() -> int:
            lines = line_session(spark, raw_root, resource, layout)
            raw = read_lines(lines, raw_root, resource, layout)
            clustered = cluster and name in CLUSTERED_TABLES
            rows, corrupt_lines[name] = write_split(
                fn(raw, hashed=False) if clustered else fn(raw), f"{clean_root}/{name}",
                f"{out_root}/quarantine/{name}", name, clustered=clustered, plain=clustered)
            return rows
        return run

    corrupt_lines: dict[str, int] = {}
    stages = {name: clean_stage(resource, name, fn) for resource, name, fn in CLEAN_JOBS}
    stages["medications"] = clean_stage(
        "MedicationRequest", "medications",
        lambda raw: normalize.normalize_medications(raw, patient_key))
    ledger = ledger or f"{out_root}/pipeline_runs"
    clean_rows: dict[str, int] = {}
    try:
        clean_rows = run_concurrently(stages, max_workers)
        if cluster:
            patients = read_clean(spark, clean_root, "patients", clustered=True)
            run_concurrently({"directory": lambda: write_directory(patients, clean_root),
                              "places": lambda: write_places(patients, clean_root)}, max_workers)
        audit.extend((name, clean_rows[name]) for _, name, _ in CLEAN_JOBS)
        audit.extend(build_gold(spark, clean_root, gold_root, top_n, max_workers,
                                clustered=cluster).items())
        audit.append(("medications", clean_rows["medications"]))
        corrupt = [(f"corrupt:{n}", corrupt_lines[n]) for n in stages]
        if layout == "routed":
            # Lines the ingest could not route (no JSON, or an unknown type): its exactly-once
            # dead-letter partition, counted through the sink log (one partition is read).
            corrupt.append(("unmatched", unmatched_lines(spark, raw_root)))

        if jdbc is not None:
            def sink(df: DataFrame, name: str) -> int:
                return write_jdbc(df, jdbc.url, name, jdbc.properties, batchsize=jdbc.batchsize,
                                  num_partitions=jdbc.num_partitions)
            tables = {n: conform(read_clean(spark, gold_root if n in GOLD_TABLES else clean_root,
                                            n, clustered=cluster and n in CLUSTERED_TABLES), n)
                      for n in SERVING_TABLES + ("medications",)}
            audit.extend((f"jdbc:{n}", rows) for n, rows in load_tables(spark, tables, sink=sink).items())
    except Exception:
        # The ledger records the failed run too, with the counts reached (0 if none).
        append_run(spark, ledger, clean_rows.get("patients", 0),
                   clean_rows.get("conditions", 0), status="failed", run_id=run_id)
        raise

    counts = dict(audit)
    append_run(spark, ledger, counts["patients"], counts["conditions"], run_id=run_id)
    return own.createDataFrame(audit + corrupt, AUDIT_SCHEMA)


def publish_pipeline(spark: SparkSession, raw_root: str, out_root: str, keep: int = tiers.KEEP, **kw) -> DataFrame:
    """``run_pipeline`` into a version of its own under ``out_root``, published when all of it is written.

    Readers of ``tiers.current`` see the version before until then, whole. A run that raises, or one that was
    killed (noticed by the next run), is ``failed`` in the ledger ``<out_root>/pipeline_runs`` under its
    version's name, and what it wrote is removed. The latest ``keep`` versions stay.
    """
    out_root = out_root.rstrip("/")
    ledger = f"{out_root}/pipeline_runs"
    for killed in tiers.unfinished(spark, out_root):
        append_run(spark, ledger, 0, 0, status="failed", run_id=killed)
        tiers.fail(spark, out_root, killed)
    version = tiers.begin(spark, out_root)
    try:
        audit = run_pipeline(spark, raw_root, tiers.version_root(out_root, version), ledger=ledger, run_id=version, **kw)
    except Exception:
        tiers.fail(spark, out_root, version)
        raise
    tiers.publish(spark, out_root, version)
    tiers.prune(spark, out_root, keep)
    return audit
