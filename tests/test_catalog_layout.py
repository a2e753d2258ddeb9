"""Bucketed catalog tables, planner statistics, Bloom filters of look-up columns."""

import hashlib

import pytest

from clinark.operators import gold
from clinark.schemas import CLEAN, conform
from clinark.sources.catalog import analyze, write_bucketed
from clinark.sources.parquet import lookup_options, read_clean, write_clustered, write_parquet

KEYS = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(200)]


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


@pytest.fixture(scope="module")
def clean(spark):
    """A third of the conditions are one patient's, some have none, patients repeat and some have no condition."""
    conditions = [(f"c{i}", KEYS[0] if i % 3 == 0 else None if i % 10 == 1 else KEYS[i % 150], f"code{i % 7}", f"name{i % 7}",
                   "active" if i % 2 else "resolved", None) for i in range(3000)]
    patients = [(KEYS[i % 180], "male" if i % 2 else "female", "1990", "s", f"city{i % 9}", "26-50") for i in range(20, 220)]
    patients.append((None, "male", None, None, None, "75+"))
    return spark.createDataFrame(conditions, CLEAN["conditions"]), spark.createDataFrame(patients, CLEAN["patients"])


@pytest.fixture()
def bucketed(spark, clean, tmp_path):
    names = write_bucketed(spark, {"conditions": clean[0], "patients": clean[1]}, str(tmp_path), "medical_b", buckets=8,
                           db_location=str(tmp_path / "db"))
    yield names
    spark.sql("DROP DATABASE medical_b CASCADE")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_on_buckets_has_no_exchange(spark, clean, bucketed, no_broadcast):
    conditions, patients = map(spark.table, bucketed)
    joined = gold.conditions_with_demographics_bucketed(conditions, patients)
    assert "SortMergeJoin" in _plan(joined) and "Exchange" not in _plan(joined)
    want = gold.conditions_with_demographics(*clean)
    assert sorted(joined.select(*want.columns).collect(), key=str) == sorted(want.collect(), key=str)
    assert "Exchange" in _plan(want)


def test_splits_on_buckets_shuffle_the_roll_up_only(spark, clean, bucketed, no_broadcast):
    conditions, patients = map(spark.table, bucketed)
    cases = gold.diagnosis_by_gender(conditions, patients)
    assert _plan(cases).count("Exchange hashpartitioning") == 1
    assert sorted(cases.collect(), key=str) == sorted(gold.diagnosis_by_gender(*clean).collect(), key=str)


def test_tables_are_replaced_and_keep_every_row(spark, clean, bucketed):
    assert spark.table(bucketed[0]).count() == 3000
    assert spark.table(bucketed[0]).where("patient_id is null").count() == clean[0].where("patient_id is null").count()


def test_join_strategy_follows_the_statistics(spark, clean, bucketed):
    """A filter that leaves few patients: only column statistics tell the planner so."""
    keys = {"spark.sql.cbo.enabled": "true", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "2000",
            "spark.sql.sources.bucketing.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)

        def joined():
            conditions, patients = map(spark.table, bucketed)
            few = patients.where(f"patient_id = '{KEYS[30]}'").select("patient_id", "gender")
            return conditions.join(few, "patient_id")
        assert "SortMergeJoin" in _plan(joined())
        analyze(spark, bucketed)
        assert "BroadcastHashJoin" in _plan(joined())
        stats = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {bucketed[1]} gender").collect()}
        assert stats["distinct_count"] == "2" and stats["num_nulls"] == "0"
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _rows_read(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_bloom_filters_keep_row_groups_of_other_ids_unread(spark, tmp_path):
    """Ids too many for a dictionary page: without the filters every id between the smallest and largest is read."""
    n = 40_000
    df = spark.range(n).selectExpr("sha2(concat('c', id), 256) AS condition_id", "sha2(cast(id AS string), 256) AS patient_id",
                                   "'A' AS icd_code", "'a' AS diagnosis_name", "'active' AS clinical_status",
                                   "cast(NULL AS string) AS onset_date").coalesce(1)
    write_parquet(df, f"{tmp_path}/plain/conditions")
    write_parquet(df, f"{tmp_path}/bloom/conditions", options=lookup_options("conditions"))
    plain, bloom = (read_clean(spark, f"{tmp_path}/{kind}", "conditions") for kind in ("plain", "bloom"))
    for column, text in (("patient_id", "x"), ("condition_id", "y")):
        absent = hashlib.sha256(text.encode()).hexdigest()
        assert _rows_read(plain.where(f"{column} = '{absent}'")) == n
        assert _rows_read(bloom.where(f"{column} = '{absent}'")) == 0
    assert bloom.where(f"patient_id = '{KEYS[7]}'").count() == 1


def test_clustered_tier_has_the_filters(spark, clean, tmp_path):
    import pyarrow.parquet as pq
    write_clustered(clean[0], f"{tmp_path}/conditions", "conditions")
    file = next((tmp_path / "conditions").rglob("*.parquet"))
    plain = tmp_path / "plain"
    write_parquet(spark.read.parquet(str(file)), str(plain))
    assert file.stat().st_size > next(plain.glob("*.parquet")).stat().st_size       # the filters' bytes
    assert pq.ParquetFile(file).metadata.num_rows > 0
    assert read_clean(spark, str(tmp_path), "conditions", clustered=True).count() == 3000


def test_parts_and_buckets_grow_with_the_table(spark, tmp_path, monkeypatch):
    """The partitions a star table is dealt to, and the buckets of the bucketed query, follow the table's size."""
    from clinark.plans import queries
    from clinark.sources import catalog, fixtures
    from conftest import SF_SMALL
    made = []
    monkeypatch.setattr(catalog, "write_bucketed", lambda *a, buckets, **kw: made.append(buckets) or ["x.patients"])
    monkeypatch.setattr(catalog, "analyze", lambda *a: None)
    monkeypatch.setattr(type(spark), "table", lambda self, name: None)
    n = spark.sparkContext.defaultParallelism
    items = fixtures.star(spark, SF_SMALL, "lineitem")
    assert fixtures.spread(items, "l_orderkey").rdd.getNumPartitions() == n
    queries._bucketed(spark, SF_SMALL)
    monkeypatch.setattr(fixtures, "SPREAD_BYTES", 1000)
    queries._bucketed(spark, SF_SMALL)
    assert made[0] == queries.CHECK_BUCKETS < 50 < made[1]
    dealt = fixtures.spread(items, "l_orderkey")
    assert dealt.rdd.getNumPartitions() == made[1] and dealt.count() == items.count()


def test_clean_and_gold_files_are_zstd(spark, clean, tmp_path):
    import pyarrow.parquet as pq

    from clinark.plans.jobs import build_gold
    for name, df in zip(("conditions", "patients"), clean, strict=True):
        write_parquet(df, f"{tmp_path}/clean/{name}")
    build_gold(spark, f"{tmp_path}/clean", f"{tmp_path}/gold")
    files = list(tmp_path.rglob("*.parquet"))
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression
                      for f in files if pq.ParquetFile(f).metadata.num_row_groups} == {"ZSTD"}


def test_gold_of_the_job_is_the_gold_of_each_operator(spark, clean, tmp_path):
    """Hot, missing and repeated patients: the tables that the job rolls up from one table of cells, with nothing left."""
    from clinark.plans.jobs import GOLD_TABLES, build_gold
    for name, df in zip(("conditions", "patients"), clean, strict=True):
        write_parquet(df, f"{tmp_path}/clean/{name}")
    rows = build_gold(spark, f"{tmp_path}/clean", f"{tmp_path}/gold")
    conditions, patients = clean
    want = {"diagnosis_statistics": gold.diagnosis_statistics(conditions),
            "diagnosis_by_gender": gold.diagnosis_by_gender(conditions, patients),
            "diagnosis_by_age_group": gold.diagnosis_by_age_group(conditions, patients)}
    for name, df in want.items():
        got = read_clean(spark, f"{tmp_path}/gold", name)
        assert sorted(got.collect(), key=str) == sorted(conform(df, name).collect(), key=str)
        assert rows[name] == got.count()
    assert list(rows) == list(GOLD_TABLES) and sorted(p.name for p in (tmp_path / "gold").iterdir()) == sorted(GOLD_TABLES)
