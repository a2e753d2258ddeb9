"""Scalar expressions: type label, age group, month, keys."""

from pyspark.sql import functions as F

from clinark.functions import exprs as X


def labels(spark, names):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    return [r[0] for r in df.orderBy("i").select(X.condition_type("name")).collect()]


def test_condition_type_cases(spark):
    names = ["Foo (Disorder) ", "A (a (b)", "Foo ()", "Foo", "   ", "", None,
             "Foo (x) ", "Foo (situation)", "x (a) (b)", "Foo (y)\x1c",
             "Foo (z)\u3000\n", "Foo (v)\x1b"]
    assert labels(spark, names) == ["disorder", "a (b", "other", "other", "other", "unknown",
                                    "unknown", "x", "situation", "b", "y", "z",
                                    "other"]


def test_type_filter_differs_from_label(spark):
    df = spark.createDataFrame([("x (Procedure) ",), ("y (procedure)",)], "n string")
    kept = [r[0] for r in df.where(X.type_suffix_filter("n", "procedure")).collect()]
    assert kept == ["y (procedure)"]
    assert labels(spark, ["x (Procedure) "]) == ["procedure"]


def test_month_and_date(spark):
    df = spark.createDataFrame([("2023-05-01T23:30:00-04:00",), ("nope",), (None,)], "t string")
    got = df.select(X.month_of("t"), X.iso_date_text("t")).collect()
    assert [tuple(r) for r in got] == [("2023-05", "2023-05-01"), (None, None), (None, None)]


def test_first_is_safe_on_empty(spark):
    df = spark.createDataFrame([([],), (None,), (["a"],)], "a array<string>")
    assert [r[0] for r in df.select(X.first("a")).collect()] == [None, None, "a"]


def test_patient_key_from_ref(spark):
    df = spark.createDataFrame([("Patient/x",), ("urn:uuid:x",), (None,), ("a/b/c",)], "r string")
    got = [r[0] for r in df.select(X.patient_key_from_ref("r")).collect()]
    sha = spark.range(1).select(F.sha2(F.lit("x"), 256), F.sha2(F.lit("b"), 256)).first()
    assert got == [sha[0], None, None, sha[1]]


def test_strip_prefix_anchored(spark):
    df = spark.createDataFrame([("Patient/x",), ("x/Patient/y",), ("Patient.x",)], "r string")
    got = [r[0] for r in df.select(X.strip_prefix("r", "Patient/")).collect()]
    assert got == ["x", "x/Patient/y", "Patient.x"]


def test_strip_prefix_matches_regex_form(spark):
    vals = ["Patient/x", "Patient/", "Patient", "xPatient/y", "", None, "Patient/Patient/z",
            "patient/x", "Patient/ü"]
    df = spark.createDataFrame([(v,) for v in vals], "r string")
    a = [r[0] for r in df.select(X.strip_prefix("r", "Patient/")).collect()]
    b = [r[0] for r in df.select(F.regexp_replace("r", "^Patient/", "")).collect()]
    assert a == b
