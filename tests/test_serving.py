"""Serving queries on hand-written clean tables."""

import pytest

from clinark.operators import gold, serving
from clinark.schemas import CLEAN, GOLD

PAT = CLEAN["patients"]


def df(spark, name, data):
    schema = CLEAN.get(name) or GOLD[name]
    return spark.createDataFrame(data, schema)


def test_encounters_null_first(spark):
    enc = df(spark, "encounters", [
        ("e1", "p", "AMB", "t", "2023-01-01", None),
        ("e2", "p", "AMB", "t", None, None),
        ("e3", "q", "AMB", "t", "2024-01-01", None),
    ])
    got = [r[0] for r in serving.patient_encounters(enc, "p").collect()]
    assert got == ["e2", "e1"]


def test_conditions_null_last(spark):
    cond = df(spark, "conditions", [
        ("c1", "p", "A", "a", "active", None),
        ("c2", "p", "B", "b", "active", "2023-01-01"),
    ])
    got = [r["icd_code"] for r in serving.patient_conditions(cond, "p").collect()]
    assert got == ["B", "A"]


def test_age_ranking(spark):
    ages = df(spark, "demographics_age_group", [("26-50", 1), ("75+", 2), ("0-25", 3), ("51-75", 4)])
    assert [r[0] for r in serving.age_ranked(ages).collect()] == ["26-50", "51-75", "75+", "0-25"]


def test_percentage(spark):
    pts = df(spark, "patients", [(str(i), "m" if i else "f", None, None, None, "75+")
                                 for i in range(8)])
    got = {r["gender"]: r["percentage"] for r in gold.demographics_gender(pts).collect()}
    assert got == {"f": 12.5, "m": 87.5}


def test_empty_tables(spark):
    e = {n: df(spark, n, []) for n in ("patients", "encounters", "conditions")}
    stats = gold.diagnosis_statistics(e["conditions"])
    row = serving.kpi(e["patients"], e["encounters"], e["conditions"], stats).first().asDict()
    assert row == {"patients": 0, "encounters": 0, "conditions": 0, "medications": 0,
                   "active_cases": 0}
    assert gold.demographics_gender(e["patients"]).collect() == []


def test_kpi_counts(spark):
    pts = df(spark, "patients", [("a", "m", None, None, None, "75+"), ("a", "m", None, None, None, "75+"),
                                 ("b", "f", None, None, None, "75+")])
    cond = df(spark, "conditions", [("c1", "a", "X", "x", "active", None),
                                    ("c2", None, "X", "x", "active", None),
                                    ("c3", "b", "Y", "y", "resolved", None)])
    enc = df(spark, "encounters", [("e", "a", None, None, None, None)])
    meds = df(spark, "medications", [("m", "a", None, None, None, None, None, "", None)])
    stats = gold.diagnosis_statistics(cond)
    row = serving.kpi(pts, enc, cond, stats, meds).first().asDict()
    assert row == {"patients": 2, "encounters": 1, "conditions": 3, "medications": 1,
                   "active_cases": 2}


def test_page_bounds():
    assert serving.page_bounds(0, 500) == (1, 100)
    assert serving.page_bounds(3, 0) == (3, 0)
    with pytest.raises(ValueError):
        serving.page_bounds(1, -1)


def test_zero_limit_is_empty_not_an_error(spark):
    pts = df(spark, "patients", [("a", "m", None, None, None, "75+")])
    assert serving.patients_page(pts, limit=0).collect() == []
    cond = df(spark, "conditions", [("c1", "a", "X", "x (disorder)", None, None)])
    assert serving.top_conditions_clean(cond, limit=0).collect() == []
    with pytest.raises(ValueError):
        serving.top_conditions_gold(gold.diagnosis_statistics(cond), limit=-1)


def test_patients_page_dedup_filters_and_wildcards(spark):
    pts = df(spark, "patients", [
        ("a", "Male", "1980", "S", "NATION_1", "26-50"),
        ("a", "male", "1980", "S", "ZZ_DUP", "26-50"),
        ("b", "female", "1990", "S", "NATIONX1", "26-50"),
        ("c", "male", "1940", None, "other", "75+"),
    ])
    page = serving.patients_page(pts, q="nation_1")
    assert [(r["patient_id"], r["city"]) for r in page.collect()] == [("a", "NATION_1"),
                                                                      ("b", "NATIONX1")]
    assert serving.patients_total(pts, q="nation_1").first()["total"] == 2
    filt = serving.patients_page(pts, gender=" MALE ", age_group="26-50")
    assert [(r["patient_id"], r["gender"]) for r in filt.collect()] == [("a", "Male")]
    p2 = serving.patients_page(pts, page=2, limit=2)
    assert [r["patient_id"] for r in p2.collect()] == ["c"]
    keyset = serving.patients_page(pts, limit=2, after="b")
    assert [r["patient_id"] for r in keyset.collect()] == ["c"]


def test_type_filter_gold_and_clean(spark):
    cond = df(spark, "conditions", [
        ("c1", "a", "X", "x (Procedure) ", None, None),
        ("c2", "b", "Y", "y (procedure)", None, None),
        ("c3", "b", "Z", "z (disorder)", None, None),
    ])
    clean = serving.top_conditions_clean(cond, "Procedure")
    assert [r["icd_code"] for r in clean.collect()] == ["Y"]
    stats = gold.diagnosis_statistics(cond)
    g = serving.top_conditions_gold(stats, " procedure ")
    assert [(r["icd_code"], r["condition_type"]) for r in g.collect()] == [("Y", "procedure")]
    everything = serving.top_conditions_gold(stats, "all")
    assert {r["condition_type"] for r in everything.collect()} == {"procedure", "disorder"}
    types = [r[0] for r in serving.condition_types_clean(cond).collect()]
    assert types == ["disorder", "procedure"]


def test_timeline_text_compare(spark):
    enc = df(spark, "encounters", [
        ("e1", "p", None, None, "2023-01-01T00:00:00-05:00", None),
        ("e2", "p", None, None, "2022-12-31T23:00:00-05:00", None),
        ("e3", "p", None, None, None, None),
        ("e4", "p", None, None, "2023-zz", None),
        ("e5", "p", None, None, "2023-02-05", None),
    ]).repartition(3)
    got = [tuple(r) for r in serving.timeline(enc).collect()]
    assert got == [("2023-01", 1), ("2023-02", 1)]


def test_genders_lowercased(spark):
    pts = df(spark, "patients", [("a", "Male", None, None, None, "75+"),
                                 ("b", "male", None, None, None, "75+"),
                                 ("c", None, None, None, None, "75+")])
    assert [r[0] for r in serving.patient_genders(pts).collect()] == ["male"]


def test_join_null_keys_kept_with_null_demographics(spark):
    pts = df(spark, "patients", [("a", "m", None, "S", None, "75+"), ("a", "f", None, "S", None, "75+")])
    cond = df(spark, "conditions", [("c1", "a", "X", "x", None, None),
                                    ("c2", None, "X", "x", None, None),
                                    ("c3", None, "X", "x", None, None),
                                    ("c4", "zz", "Y", "y", None, None)])
    got = sorted((r["condition_id"], r["gender"]) for r in
                 gold.conditions_with_demographics(cond, pts).collect())
    assert got == [("c1", "f"), ("c1", "m"), ("c2", None), ("c3", None), ("c4", None)]


def _ids(page_df):
    return [r["patient_id"] for r in page_df.collect()]


def test_pages_cover_all_ids_once(spark):
    """Every page in turn: duplicates kept once, the NULL id last, pages past the end empty,
    and no job runs while a page is built."""
    rows = [(f"{i % 5}p{i:03d}", "male" if i % 2 else "female", None, None, None, "75+")
            for i in range(57)]
    rows += [("0p010", "other", None, None, None, "75+"), (None, "x", None, None, None, "75+")]
    pts = df(spark, "patients", rows).repartition(5)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    pages = [serving.patients_page(pts, page, 8) for page in range(1, 10)]
    assert len(tracker.getJobIdsForGroup(None)) == before
    seen = [i for page in pages for i in _ids(page)]
    assert seen == sorted(r[0] for r in rows[:57]) + [None]
    dup = pages[0].where("patient_id = '0p010'")
    assert [r["gender"] for r in dup.collect()] == ["female"]
    assert _ids(serving.patients_page(pts, limit=3, after="1p001")) == ["1p006", "1p011", "1p016"]


@pytest.mark.parametrize("q,hits", [("x\\y", ["a"]), ("\\%", ["b"]), ("\\_", ["c"]), ("y\\", []),
                                    ("\\\\", ["d"])])
def test_backslash_makes_the_next_character_literal(spark, q, hits):
    pts = df(spark, "patients", [(i, None, None, None, city, "75+") for i, city in
                                 (("a", "xy"), ("b", "1%"), ("c", "_"), ("d", "\\"))])
    assert _ids(serving.patients_page(pts, q=q)) == hits
    cond = df(spark, "conditions", [("c1", "a", "X", "x (ab)", None, None)])
    assert serving.top_conditions_clean(cond, "a\\b").count() == 1
    assert serving.top_conditions_gold(gold.diagnosis_statistics(cond), "a\\b").count() == 1


def test_statistics_are_not_cut(spark):
    cond = df(spark, "conditions", [(f"c{i}", f"p{i}", f"X{i}", f"n {i} (t{i})", "active", None)
                                    for i in range(70)])
    stats = gold.diagnosis_statistics(cond)
    assert stats.count() == gold.diagnosis_statistics_from(gold.patient_diagnoses(cond)).count() == 70
    assert serving.condition_types_gold(stats).count() == 70
    assert gold.diagnosis_statistics(cond, 50).count() == 50
