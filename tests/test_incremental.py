"""Gold by batch equals gold over everything at once."""

import random

import pytest

from clinark.operators import gold
from clinark.plans import incremental as I
from clinark.schemas import CLEAN, conform
from clinark.sources import tiers


def _rows(seed, n):
    rng = random.Random(seed)
    ids = [None, *(f"p{i}" for i in range(12))]
    conditions = [(f"c{seed}-{i}", rng.choice(ids), rng.choice(["A", "B", "C"]), rng.choice([None, "x", "y"]),
                   rng.choice(["active", "resolved", None]), None) for i in range(n)]
    patients = [(rng.choice(ids[1:]), rng.choice(["male", "female", None]), "1990", rng.choice(["s", "t", None]), None,
                 rng.choice(["0-25", "75+"])) for _ in range(n // 4)]
    return conditions, patients


def _frames(spark, conditions, patients):
    return spark.createDataFrame(conditions, CLEAN["conditions"]), spark.createDataFrame(patients, CLEAN["patients"])


def _whole(conditions, patients):
    tables = {"diagnosis_statistics": gold.diagnosis_statistics(conditions),
              "demographics_gender": gold.demographics_gender(patients),
              "demographics_age_group": gold.demographics_age_group(patients),
              "demographics_geography": gold.demographics_geography(patients),
              "diagnosis_by_gender": gold.diagnosis_by_gender(conditions, patients),
              "diagnosis_by_age_group": gold.diagnosis_by_age_group(conditions, patients)}
    return {name: sorted(conform(df, name).collect(), key=str) for name, df in tables.items()}


def _gold(spark, root):
    return {name: sorted(I.read_gold(spark, root, name).collect(), key=str) for name in I.TABLES}


def test_batches_equal_the_whole(spark, tmp_path):
    root = str(tmp_path / "gold")
    # Conditions first, their patients later and repeated; then both; an empty batch; more.
    (c1, p1), (c2, p2), (c3, p3) = _rows(1, 60), _rows(2, 40), _rows(3, 50)
    batches = [(c1, []), ([], p1), (c2, p2), ([], []), (c3, p3)]
    seen_c, seen_p = [], []
    for i, (c, p) in enumerate(batches):
        seen_c, seen_p = seen_c + c, seen_p + p
        version = I.apply_batch(spark, root, f"b{i}", *_frames(spark, c, p))
        assert version.endswith(f"-b{i}")
        assert _gold(spark, root) == _whole(*_frames(spark, seen_c, seen_p))
        if i == 2:
            I.compact(spark, root)
            assert _gold(spark, root) == _whole(*_frames(spark, seen_c, seen_p))
            assert len(I.state_versions(spark, root)) == 1
    assert len(I.state_versions(spark, root)) == 3
    # A batch that was applied is not applied again.
    assert I.apply_batch(spark, root, "b4", *_frames(spark, c3, p3)) == version
    assert _gold(spark, root) == _whole(*_frames(spark, seen_c, seen_p))


def test_a_killed_batch_leaves_no_trace_and_can_be_applied_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "gold")
    (c1, p1), (c2, p2) = _rows(4, 30), _rows(5, 30)
    I.apply_batch(spark, root, "one", *_frames(spark, c1, p1))
    want = _gold(spark, root)

    def stop(*args, **kw):
        raise KeyboardInterrupt
    monkeypatch.setattr(tiers, "publish", stop)
    with pytest.raises(KeyboardInterrupt):
        I.apply_batch(spark, root, "two", *_frames(spark, c2, p2))
    monkeypatch.undo()
    assert _gold(spark, root) == want
    I.apply_batch(spark, root, "two", *_frames(spark, c2, p2))
    assert _gold(spark, root) == _whole(*_frames(spark, c1 + c2, p1 + p2))
    assert tiers.unfinished(spark, root) == []


def test_old_conditions_are_not_read(spark, tmp_path):
    """The second batch is applied after the first one's rows are gone."""
    from clinark.sources.parquet import read_clean, remove, write_parquet
    root = str(tmp_path / "gold")
    (c1, p1), (c2, p2) = _rows(6, 30), _rows(7, 30)
    for i, (c, p) in enumerate([(c1, p1), (c2, p2)]):
        for name, df in zip(("conditions", "patients"), _frames(spark, c, p), strict=True):
            write_parquet(df, f"{tmp_path}/in{i}/{name}")
        I.apply_batch(spark, root, f"b{i}", *(read_clean(spark, f"{tmp_path}/in{i}", n) for n in ("conditions", "patients")))
        remove(spark, f"{tmp_path}/in{i}")
    assert _gold(spark, root) == _whole(*_frames(spark, c1 + c2, p1 + p2))


def test_batch_names(spark, tmp_path):
    for name in ("", "a/b", I.COMPACTED):
        with pytest.raises(ValueError):
            I.apply_batch(spark, str(tmp_path), name, *_frames(spark, [], []))


def test_state_lies_by_patient_and_keeps_odd_ids(spark, tmp_path):
    """Every file of the conditions' state, compacted or not, has a patient's rows beside each other, and gives back
    ids of any form."""
    import hashlib
    from itertools import groupby
    ids = [None, "", "p" * 31, "\x00" + "p" * 31, "p" * 32, "a" * 64, "A" * 64, "a" * 64 + "\n", "\u00e9",
           *(hashlib.sha256(str(i).encode()).hexdigest() for i in range(40))]
    conditions = [(f"c{i}", ids[i % len(ids)], f"code{i % 11}", f"name{i % 11}", "active", None) for i in range(2000)]
    frames = _frames(spark, conditions, [(p, "male", None, "s", None, "75+") for p in ids])
    for i in range(2):
        I.apply_batch(spark, str(tmp_path), f"b{i}", *frames)
        if i:
            I.compact(spark, str(tmp_path))
        for version in I.state_versions(spark, str(tmp_path)):
            files = list((tmp_path / "versions" / version / "state" / "conditions").glob("*.parquet"))
            for file in files:
                rows = spark.read.schema(I.STATE["conditions"]).parquet(str(file)).select("patient_id").collect()
                runs = [k for k, _ in groupby(r[0] for r in rows)]
                assert len(runs) == len(set(runs))
            whole = spark.read.schema(I.STATE["conditions"]).parquet(*map(str, files))
            assert {r[0] for r in whole.select("patient_id").collect()} == set(ids)
    assert _gold(spark, str(tmp_path)) == _whole(*_frames(spark, conditions * 2, [(p, "male", None, "s", None, "75+") for p in ids] * 2))


def test_packed_keys_are_one_to_one(spark):
    from pyspark.sql import functions as F

    from clinark.functions import exprs as X
    ids = [None, "", "p", "p" * 30, "p" * 31, "p" * 32, "p" * 33, "\x00" + "p" * 31, "\x01\x00" + "p" * 30, "a" * 64, "A" * 64,
           "a" * 64 + "\n", "ab" * 32, "\u00e9" * 16, "\u00e9" * 32]
    got = spark.createDataFrame([(i,) for i in ids], "id string").select(
        "id", X.packed_key("id").alias("k"), X.unpacked_key(X.packed_key("id")).alias("back")).collect()
    assert all(r["id"] == r["back"] for r in got) and len({r["k"] for r in got}) == len(ids)
    assert {len(r["k"]) for r in got if r["id"] in ("a" * 64, "ab" * 32)} == {32}
    assert spark.range(1).select(F.length(X.packed_key(F.lit("A" * 64)))).first()[0] == 65
