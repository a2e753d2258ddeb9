"""Invariants of the gold tables on the star-derived data."""

from pyspark.sql import functions as F

from clinark.operators import gold, serving
from clinark.plans.catalog import Dataset
from conftest import SF_SMALL


def test_demographic_splits_sum_to_join(spark):
    d = Dataset(spark, SF_SMALL)
    joined = gold.conditions_with_demographics(d.conditions, d.patients).count()
    by_g = d.diagnosis_by_gender.agg(F.sum("cases")).first()[0]
    by_a = d.diagnosis_by_age_group.agg(F.sum("cases")).first()[0]
    assert joined == by_g == by_a
    assert joined > d.conditions.count()  # duplicate patients fan out


def test_percentages_sum_to_100(spark):
    d = Dataset(spark, SF_SMALL)
    total = d.demographics_gender.agg(F.sum("percentage")).first()[0]
    assert abs(total - 100) < 0.05


def test_pages_cover_deduplicated_table(spark):
    d = Dataset(spark, SF_SMALL)
    total = serving.patients_total(d.patients).first()["total"]
    seen = []
    page = 1
    while True:
        rows = serving.patients_page(d.patients, page=page, limit=100).collect()
        if not rows:
            break
        seen += [r["patient_id"] for r in rows]
        page += 1
    assert len(seen) == len(set(seen)) == total
    assert seen == sorted(seen)


def test_shuffle_partitions_do_not_change_results(spark):
    d = Dataset(spark, SF_SMALL)
    before = sorted(map(repr, d.diagnosis_by_gender.collect()))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        after = sorted(map(repr, Dataset(spark, SF_SMALL).diagnosis_by_gender.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert before == after


def test_hot_keys_split_and_exact(spark):
    """A third of the conditions on NULL patient, a third on one patient who is
    duplicated: the pre-aggregated splits equal the row-level join."""
    from clinark.schemas import CLEAN
    n = 3000
    cond = spark.createDataFrame(
        [(f"c{i}", None if i % 3 == 0 else ("hot" if i % 3 == 1 else f"p{i % 50}"),
          f"X{i % 7}", f"name {i % 7}", "active", None) for i in range(n)],
        CLEAN["conditions"])
    pts = spark.createDataFrame(
        [("hot", "male", None, None, None, "26-50"), ("hot", "female", None, None, None, "75+")]
        + [(f"p{i}", "female", None, None, None, "0-25") for i in range(50)],
        CLEAN["patients"])
    joined = gold.conditions_with_demographics(cond, pts)
    expected = {tuple(r) for r in joined.groupBy("icd_code", "diagnosis_name", "gender")
                .agg(F.count(F.lit(1)).alias("cases")).collect()}
    got = {tuple(r) for r in gold.diagnosis_by_gender(cond, pts).collect()}
    assert got == expected
    assert joined.count() == n + n // 3  # the hot patient's rows double
    # the NULL-key rows spread over the shuffle instead of one partition
    salted = joined.where(F.col("patient_id").isNull()).count()
    assert salted == n // 3


def test_hot_patient_key_is_split_by_adaptive_skew_join(spark):
    """J1 with one patient holding a third of the conditions: the adaptive planner
    splits that key's shuffle partition over several tasks (thresholds scaled down
    to the test size), and the result stays exact."""
    from clinark.schemas import CLEAN
    n, keys = 30000, 1000
    cond = spark.range(n).select(
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("condition_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT"))
         .otherwise(F.concat(F.lit("p"), (F.col("id") % keys).cast("string"))).alias("patient_id"),
        F.lit("X").alias("icd_code"), F.lit("x").alias("diagnosis_name"),
        F.lit(None).cast("string").alias("clinical_status"),
        F.lit(None).cast("string").alias("onset_date"))
    pts = spark.range(keys).select(
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("patient_id"),
        F.lit("m").alias("gender"), F.lit(None).cast("string").alias("birth_year"),
        F.lit("S").alias("state"), F.lit(None).cast("string").alias("city"),
        F.lit("75+").alias("age_group"))
    pts = pts.unionByName(spark.createDataFrame([("HOT", "f", None, "S", None, "75+")],
                                                CLEAN["patients"]))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "40"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = gold.conditions_with_demographics(cond, pts)
        rows = joined.collect()
        final = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in final
    assert len(rows) == n
    assert sum(1 for r in rows if r["gender"] == "f") == n // 3  # ids 0, 3, 6, ...


def test_job_gold_equals_direct_computation(spark, tmp_path):
    """The job derives statistics and splits from one written per-patient aggregate;
    its tables equal the operators applied to the clean tables directly."""
    from clinark.plans.jobs import build_gold
    from clinark.sources.parquet import read_clean, write_clustered
    d = Dataset(spark, SF_SMALL)
    for name in ("patients", "conditions"):
        write_clustered(getattr(d, name), str(tmp_path / "clean" / name), name)
    build_gold(spark, str(tmp_path / "clean"), str(tmp_path / "gold"), clustered=True)

    def same(name, direct):
        written = read_clean(spark, str(tmp_path / "gold"), name)
        a = sorted(map(repr, written.collect()))
        b = sorted(map(repr, direct.select(*written.columns).collect()))
        assert a == b and len(a) > 0, name
    same("diagnosis_statistics", gold.diagnosis_statistics(d.conditions))
    same("diagnosis_by_gender", gold.diagnosis_by_gender(d.conditions, d.patients))
    same("diagnosis_by_age_group", gold.diagnosis_by_age_group(d.conditions, d.patients))
    same("demographics_gender", gold.demographics_gender(d.patients))
