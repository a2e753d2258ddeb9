"""The page directory: same pages as without it, few folders read."""

import hashlib

import pytest
from pyspark.sql import functions as F

from clinark.operators import serving
from clinark.operators.directory import DIRECTORY_CHARS, _after, page_slice, patient_directory, read_directory, write_directory
from clinark.schemas import CLEAN
from clinark.sources.parquet import read_clean, write_clustered


def _patients(spark, n, extra=()):
    rows = [(hashlib.sha256(str(i % (n - 50)).encode()).hexdigest(), "male" if i % 2 else "female", str(1950 + i % 60),
             "s", f"c{i}", "26-50") for i in range(n)]
    return spark.createDataFrame([*rows, *extra], CLEAN["patients"])


@pytest.fixture(scope="module")
def tier(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("paged"))
    write_clustered(_patients(spark, 6000, [(None, "x", None, None, None, None)] * 2), f"{root}/patients", "patients")
    patients = read_clean(spark, root, "patients", clustered=True)
    write_directory(patients, root)
    return patients, read_directory(spark, root)


@pytest.mark.parametrize("page, limit", [(1, 25), (2, 100), (40, 25), (238, 25), (239, 25), (240, 25), (60, 100), (5951, 1), (5952, 1), (3, 0)])
def test_pages_equal_those_without_it(tier, page, limit):
    patients, directory = tier
    plain = serving.patients_page(patients, page, limit).collect()
    assert serving.patients_page(patients, page, limit, directory=directory).collect() == plain
    if limit and page * limit <= 5950:
        assert len(plain) == limit


def test_total(tier):
    patients, directory = tier
    assert serving.patients_total(patients, directory=directory).first()["total"] == 5951
    assert serving.patients_total(patients).first()["total"] == 5951


def test_a_page_reads_the_folders_that_hold_it(tier, spark):
    patients, directory = tier
    ids = sorted({r[0] for r in patients.select("patient_id").collect() if r[0]})
    for page in (1, 90, 200):
        df = serving.patients_page(patients, page, 25, directory=directory)
        plan = df._jdf.queryExecution().executedPlan().toString()
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        folders = {i[:2] for i in ids[(page - 1) * 25:page * 25]}
        assert all(f in filters for f in folders) and filters.count(",") <= len(folders) + 1
        assert "PushedFilters: [IsNotNull(patient_id), GreaterThanOrEqual(patient_id" in plan
        rows, _ = page_slice(patients, directory, (page - 1) * 25, 25)
        files = {r[0] for r in rows.select(F.input_file_name()).collect()}
        assert {f.split("patient_bucket=")[1][:2] for f in files} == folders


def test_filters_and_keyset_do_not_use_it(tier):
    patients, directory = tier
    for kw in ({"gender": "male"}, {"q": "c12"}, {"after": "8"}):
        assert (serving.patients_page(patients, 2, 10, directory=directory, **kw).collect()
                == serving.patients_page(patients, 2, 10, **kw).collect())


def test_short_and_odd_keys_stay_in_order(spark):
    ids = ["", "a", "ab", "abc", "abcd", "abcde", "abce", "b", "abc\U0010ffff", "abc\U0010ffffz", "퟿", "é", "zzzz", "zzzz1"]
    rows = [(i, "g", None, None, None, None) for i in ids] * 2 + [(None, "g", None, None, None, None)]
    patients = spark.createDataFrame(rows, CLEAN["patients"])
    directory = patient_directory(patients).persist()
    for limit in (1, 2, 3, 7):
        for page in range(1, len(ids) // limit + 3):
            assert (serving.patients_page(patients, page, limit, directory=directory).collect()
                    == serving.patients_page(patients, page, limit).collect())
    directory.unpersist()


def test_next_text_above_a_prefix():
    assert _after("abcd") == "abce" and _after("a\U0010ffff") == "b" and _after("\U0010ffff") is None
    assert _after("x퟿") == "x" and DIRECTORY_CHARS == 4


def test_empty_table(spark):
    patients = spark.createDataFrame([], CLEAN["patients"])
    directory = patient_directory(patients)
    assert directory.collect() == []
    assert serving.patients_page(patients, directory=directory).collect() == []
    assert serving.patients_total(patients, directory=directory).first()["total"] == 0


def test_deep_page_without_a_directory(tier, monkeypatch):
    patients, _ = tier
    plain = serving.patients_page(patients, 100, 25).collect()
    monkeypatch.setattr(serving, "SHALLOW_ROWS", 10)
    assert serving.patients_page(patients, 100, 25).collect() == plain
