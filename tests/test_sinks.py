"""Parquet and catalog round trips; JDBC option building (no database is started)."""

import pytest

from clinark.plans.catalog import Dataset
from clinark.schemas import GOLD, conform
from clinark.sources.catalog import catalog_sql, register_clean
from clinark.sources.jdbc import jdbc_writer_options
from clinark.sources.parquet import read_clean, write_clustered, write_parquet
from clinark.operators import gold, serving
from clinark.schemas import CLEAN
from pyspark.sql import functions as F
from conftest import SF_SMALL


def test_parquet_roundtrip_counts(spark, tmp_path):
    d = Dataset(spark, SF_SMALL)
    n = write_parquet(d.patients, str(tmp_path / "patients"))
    back = read_clean(spark, str(tmp_path), "patients")
    assert n == back.count() == d.patients.count()


def test_conform_gold_contract(spark):
    d = Dataset(spark, SF_SMALL)
    g = conform(gold.demographics_gender(d.patients), "demographics_gender")
    assert g.schema.simpleString() == GOLD["demographics_gender"].simpleString()
    with pytest.raises(ValueError):
        conform(d.patients, "demographics_gender")


def test_catalog_tables_and_bound_parameters(spark, tmp_path):
    d = Dataset(spark, SF_SMALL)
    for name, df in (("patients", d.patients), ("conditions", d.conditions),
                     ("encounters", d.encounters)):
        write_parquet(df, str(tmp_path / name))
    names = register_clean(spark, str(tmp_path), "medical_t", replace=True,
                           db_location=str(tmp_path / "medical_t.db"))
    assert names == ["medical_t.patients", "medical_t.conditions", "medical_t.encounters"]
    n = catalog_sql(spark, "SELECT count(*) AS n FROM medical_t.patients WHERE gender = :g",
                    {"g": "male"}).first()["n"]
    assert n == d.patients.where("gender = 'male'").count()
    with pytest.raises(ValueError):
        register_clean(spark, str(tmp_path), "bad; drop")


def test_jdbc_options():
    o = jdbc_writer_options("t", {"user": "u"}, batchsize=500, num_partitions=4)
    assert o == {"user": "u", "dbtable": "t", "batchsize": "500", "truncate": "false",
                 "numPartitions": "4"}
    assert jdbc_writer_options("t")["numPartitions"] == "16"


def test_jdbc_key_ranges_hold_every_row_once(spark):
    from clinark.sources.jdbc import key_predicates
    keys = spark.createDataFrame([(k,) for k in ("", "0a", "1", "9z", "a", "f00", "zz", "d'e", None)], "k string")
    for bounds in ((), ("5",), tuple("123456789abcdef"), ("d'e", "e")):
        held = [r["k"] for p in key_predicates("k", bounds) for r in keys.where(p).collect()]
        assert sorted(held, key=str) == sorted((r["k"] for r in keys.collect()), key=str)


def test_clustered_lookup_prunes_folder_and_row_groups(spark, tmp_path):
    d = Dataset(spark, SF_SMALL)
    n = write_clustered(d.conditions, str(tmp_path / "conditions"), "conditions")
    cond = read_clean(spark, str(tmp_path), "conditions", clustered=True)
    assert n == cond.count() == d.conditions.count()
    pid = d.conditions.where("patient_id IS NOT NULL").first()["patient_id"]
    q = serving.patient_conditions(cond, pid)
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    try:
        spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # ids are 64 characters
        p = q._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert f"PartitionFilters: [isnotnull(patient_bucket#" in p and f"= {pid[:2]})]" in p
    assert f"EqualTo(patient_id,{pid})" in p
    plain = serving.patient_conditions(d.conditions, pid)
    assert [tuple(r) for r in q.collect()] == [tuple(r) for r in plain.collect()]


def test_clustered_write_spreads_a_hot_patient_and_keeps_text_folders(spark, tmp_path):
    """A third of the rows on one patient land in several files (the adaptive planner
    splits the hot folder; size thresholds scaled down to the test); a folder named 01
    stays the text '01'."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    rows = [(f"c{i:05d}", "01hot" if i % 3 == 0 else f"{i % 97:02d}x{i}", "X", "x", None, None)
            for i in range(6000)]
    try:
        spark.conf.set(key, "4k")
        write_clustered(spark.createDataFrame(rows, CLEAN["conditions"]).repartition(8),
                        str(tmp_path / "conditions"), "conditions")
    finally:
        spark.conf.set(key, old)
    cond = read_clean(spark, str(tmp_path), "conditions", clustered=True)
    hot = cond.where("patient_id = '01hot'")
    assert hot.count() == 2000
    assert hot.select(F.input_file_name()).distinct().count() > 1
    assert {r[0] for r in hot.select("patient_bucket").distinct().collect()} == {"01"}
    got = serving.patient_conditions(cond, "01hot", limit=5000).count()
    assert got == 2000


def test_catalog_over_clustered_tables_prunes_folders(spark, tmp_path):
    d = Dataset(spark, SF_SMALL)
    for name in ("patients", "conditions", "encounters"):
        write_clustered(getattr(d, name), str(tmp_path / name), name)
    register_clean(spark, str(tmp_path), "medical_c", replace=True, clustered=True,
                   db_location=str(tmp_path / "medical_c.db"))
    pid = d.conditions.where("patient_id IS NOT NULL").first()["patient_id"]
    q = catalog_sql(spark, """
        SELECT diagnosis_name, icd_code, clinical_status, onset_date FROM medical_c.conditions
        WHERE patient_id = :p AND patient_bucket = substring(:p, 1, 2)""", {"p": pid})
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(patient_bucket" in plan
    assert q.count() == d.conditions.where(F.col("patient_id") == pid).count() > 0
    total = catalog_sql(spark, "SELECT count(*) AS n FROM medical_c.encounters").first()["n"]
    assert total == d.encounters.count()


def test_jdbc_partitioned_read_needs_bounds(spark):
    from clinark.sources.jdbc import read_jdbc
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none://nowhere", "t", partition_column="id", lower_bound=0)
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none://nowhere", "t", partition_column="id", predicates=["1 = 1"])


def test_clustered_rows_cross_the_shuffle_with_packed_keys(spark, tmp_path):
    from clinark.sources.parquet import _laid_out, write_split
    ids = ["ab" * 32, "AB" * 32, "0" * 63, "x" * 31, "ü" * 16, "", None, "ab" * 32]
    rows = [(p, "male", "1980", "S", f"C{i}", "26-50") for i, p in enumerate(ids)]
    df = spark.createDataFrame(rows, CLEAN["patients"])
    # The hash in hex is made bytes below the rebalance, where the shuffle is written.
    plan = _laid_out(df, "patients")._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" in plan.split("RebalancePartitions")[1]
    write_clustered(df, str(tmp_path / "patients"), "patients")
    lines = df.withColumn("_line", F.lit(None).cast("string")).unionByName(
        spark.createDataFrame([("{cut",)], "_line string"), allowMissingColumns=True)
    assert write_split(lines, str(tmp_path / "s" / "patients"), str(tmp_path / "q"), "patients", clustered=True) == (8, 1)
    for root in (tmp_path, tmp_path / "s"):
        got = read_clean(spark, str(root), "patients", clustered=True).collect()
        assert sorted(tuple(r)[:6] for r in got if r[0] is not None) == sorted(r for r in rows if r[0] is not None)
        assert [tuple(r)[:6] for r in got if r[0] is None] == [rows[6]]
        assert all(r["patient_bucket"] == r["patient_id"][:2] for r in got if r["patient_id"])
    assert [r["line"] for r in spark.read.parquet(str(tmp_path / "q")).collect()] == ["{cut"]
