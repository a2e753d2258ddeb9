"""Routing ingest (replay adds nothing, unroutable lines), raw scans of the routed
root, the end-to-end job and the ledger."""

import json

from pyspark.sql import functions as F

from clinark.plans.jobs import GOLD_TABLES, run_pipeline
from clinark.plans.audit import read_runs
from clinark.sources.landing import BROKEN, UNKNOWN, land_mixed
from clinark.sources.raw import read_raw
from clinark.streaming.ingest import routed_counts, run_ingest
from conftest import SF_SMALL


def _land(path, lines):
    path.mkdir(parents=True, exist_ok=True)
    with open(path / "batch-0.ndjson", "w") as f:
        for line in lines:
            f.write((line if isinstance(line, str) else json.dumps(line)) + "\n")


def test_routing_unmatched_and_replay(spark, tmp_path):
    landing, routed, ck = tmp_path / "landing", str(tmp_path / "routed"), str(tmp_path / "ck")
    _land(landing, [{"resourceType": "Patient", "id": "1"},
                    {"resourceType": "Observation", "id": "o"},
                    {"resourceType": "Alien", "id": "a"},
                    "not json"])
    assert run_ingest(spark, str(landing), routed, ck) == 4
    counts = {r[0]: r[1] for r in routed_counts(spark, routed).collect()}
    assert counts == {"Patient": 1, "Observation": 1, "_unmatched": 2}
    assert run_ingest(spark, str(landing), routed, ck) == 0  # replay: nothing new
    assert routed_counts(spark, routed).agg(F.sum("lines")).first()[0] == 4
    # a new file is picked up once
    with open(landing / "batch-1.ndjson", "w") as f:
        f.write(json.dumps({"resourceType": "Patient", "id": "2"}) + "\n")
    assert run_ingest(spark, str(landing), routed, ck) == 1
    pts = read_raw(spark, routed, "Patient", layout="routed")
    assert sorted(r["id"] for r in pts.collect()) == ["1", "2"]


def test_routed_scan_prunes_partitions(spark, tmp_path):
    landing, routed = tmp_path / "landing", str(tmp_path / "routed")
    _land(landing, [{"resourceType": "Patient", "id": "1"},
                    {"resourceType": "Condition", "id": "c"}])
    run_ingest(spark, str(landing), routed, str(tmp_path / "ck"))
    plan = read_raw(spark, routed, "Patient")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "resource_type" in plan


def test_pipeline_end_to_end_twice(spark, tmp_path):
    land_mixed(spark, SF_SMALL, str(tmp_path / "landing"))
    with open(tmp_path / "landing" / "junk.txt", "w") as f:
        f.write('{"resourceType": "Encounter", "id": \n')  # unparsable: routed to _unmatched
    run_ingest(spark, str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "ck"))
    a = {r[0]: r[1] for r in run_pipeline(spark, str(tmp_path / "raw"),
                                          str(tmp_path / "out1")).collect()}
    b = {r[0]: r[1] for r in run_pipeline(spark, str(tmp_path / "raw"), str(tmp_path / "out2"),
                                          cluster=False).collect()}
    assert a == b  # a second run, and the unclustered layout, give the same tables
    assert a["diagnosis_statistics"] > 50 and a["patients"] > 0
    orders = [r[0] for r in spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey").collect()]
    dirty = sum(k % m == 0 for k in orders for m in (UNKNOWN, BROKEN))
    assert a["unmatched"] == dirty + 1 > 1  # the landing's dirty lines and the junk line, in the dead-letter partition
    assert sorted(p.name for p in (tmp_path / "out1" / "gold").iterdir()) == sorted(GOLD_TABLES)
    runs = read_runs(spark, str(tmp_path / "out1" / "pipeline_runs")).collect()
    assert len(runs) == 1 and runs[0]["patients_processed"] == a["patients"]
    assert runs[0]["status"] == "success"


def test_corrupt_lines_counted_in_directory_layout(spark, tmp_path):
    d = tmp_path / "raw" / "Encounter"
    _land(d, [{"resourceType": "Encounter", "id": "e1"}, "{broken"])
    for t in ("Patient", "Condition", "MedicationRequest"):
        _land(tmp_path / "raw" / t, [{"resourceType": t, "id": "x1",
                                      "code": {"coding": [{"code": "A"}]}}])
    audit = {r[0]: r[1] for r in run_pipeline(spark, str(tmp_path / "raw"), str(tmp_path / "out"),
                                              layout="directory").collect()}
    assert audit["encounters"] == 1 and audit["corrupt:encounters"] == 1
    assert audit["corrupt:patients"] == 0


def test_ingest_archives_picked_up_files(spark, tmp_path):
    landing, archive = tmp_path / "landing", tmp_path / "archive"
    landing.mkdir()
    for i in range(3):
        (landing / f"b{i}.ndjson").write_text(json.dumps({"resourceType": "Patient",
                                                          "id": str(i)}) + "\n")
    routed, ck = str(tmp_path / "routed"), str(tmp_path / "ck")
    assert run_ingest(spark, str(landing), routed, ck, archive_dir=str(archive),
                      max_files_per_trigger=1) == 3
    moved = [p.name for p in archive.rglob("*.ndjson")]
    left = [p.name for p in landing.rglob("*.ndjson")]
    assert len(moved) >= 2 and len(moved) + len(left) == 3  # all but the last batch moved
    assert run_ingest(spark, str(landing), routed, ck, archive_dir=str(archive)) == 0
    assert routed_counts(spark, routed).first()["lines"] == 3


def test_continuous_ingest_routes_new_files_as_they_land(spark, tmp_path):
    from clinark.streaming.ingest import start_ingest
    landing = tmp_path / "landing"
    landing.mkdir()
    routed, ck = str(tmp_path / "routed"), str(tmp_path / "ck")
    (landing / "a.ndjson").write_text(json.dumps({"resourceType": "Patient", "id": "1"}) + "\n")
    q = start_ingest(spark, str(landing), routed, ck, available_now=False,
                     processing_time="200 milliseconds")
    try:
        q.processAllAvailable()
        assert {r[0]: r[1] for r in routed_counts(spark, routed).collect()} == {"Patient": 1}
        (landing / "b.ndjson").write_text(
            json.dumps({"resourceType": "Encounter", "id": "e"}) + "\n"
            + json.dumps({"resourceType": "Patient", "id": "2"}) + "\n")
        q.processAllAvailable()
        assert {r[0]: r[1] for r in routed_counts(spark, routed).collect()} == {
            "Patient": 2, "Encounter": 1}
    finally:
        q.stop()
    assert q.exception() is None



def test_failed_run_is_recorded_in_the_ledger(spark, tmp_path):
    import pytest
    for t in ("Patient", "Condition", "MedicationRequest"):  # no Encounter folder
        _land(tmp_path / "raw" / t, [{"resourceType": t, "id": "x1",
                                      "code": {"coding": [{"code": "A"}]}}])
    with pytest.raises(Exception):
        run_pipeline(spark, str(tmp_path / "raw"), str(tmp_path / "out"), layout="directory")
    runs = read_runs(spark, str(tmp_path / "out" / "pipeline_runs")).collect()
    assert [r["status"] for r in runs] == ["failed"]


def test_job_on_inputs_without_valid_rows(spark, tmp_path):
    """Every resource type present but nothing valid in it: the job writes empty clean
    and gold tables, counts the corrupt lines, and records a successful run."""
    for t in ("Patient", "Condition", "Encounter", "MedicationRequest"):
        _land(tmp_path / "raw" / t, ["{broken", "also broken"])
    audit = {r[0]: r[1] for r in run_pipeline(spark, str(tmp_path / "raw"), str(tmp_path / "out"),
                                              layout="directory").collect()}
    assert audit["patients"] == audit["conditions"] == audit["diagnosis_statistics"] == 0
    assert audit["encounters"] == 0 and audit["corrupt:encounters"] == 2
    assert audit["demographics_gender"] == 0 and audit["diagnosis_by_gender"] == 0
    runs = read_runs(spark, str(tmp_path / "out" / "pipeline_runs")).collect()
    assert [r["status"] for r in runs] == ["success"]


def test_ingest_counts_every_batch_of_a_long_backlog(spark, tmp_path):
    """More micro-batches than Spark keeps progress reports for: all lines counted."""
    landing = tmp_path / "landing"
    landing.mkdir()
    for i in range(12):
        (landing / f"b{i:02d}.ndjson").write_text(
            json.dumps({"resourceType": "Patient", "id": str(i)}) + "\n")
    key = "spark.sql.streaming.numRecentProgressUpdates"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "3")  # keep 3 reports, drain in 12 batches
        n = run_ingest(spark, str(landing), str(tmp_path / "routed"), str(tmp_path / "ck"),
                       max_files_per_trigger=1)
    finally:
        spark.conf.set(key, old)
    assert n == 12


def test_raw_rows_do_not_depend_on_the_columns_read(spark, tmp_path):
    """A mistyped field is NULL and its row stays; lines that are no JSON object go to the
    quarantine; count() and every single-column read agree."""
    from clinark.sources.raw import malformed_lines
    for t in ("Patient", "Condition", "Encounter", "MedicationRequest"):
        _land(tmp_path / "raw" / t, [
            {"resourceType": t, "id": "a1", "status": "x"}, "{broken", "[1, 2]", "",
            {"resourceType": t, "id": "a2", "address": {"odd": 1}, "code": 7, "period": "p",
             "medicationCodeableConcept": 3, "subject": [1]}])
        raw = read_raw(spark, str(tmp_path / "raw"), t, layout="directory")
        assert raw.count() == 2 == len(raw.collect())
        for c in raw.columns:
            assert len(raw.select(c).collect()) == 2
        assert {r["id"] for r in raw.collect()} == {"a1", "a2"}
        assert {r[0] for r in malformed_lines(spark, str(tmp_path / "raw"), t, "directory").collect()} == {
            "{broken", "[1, 2]"}


def test_ingest_in_several_batches_counts_every_line(spark, tmp_path):
    for i in range(5):
        (tmp_path / "landing").mkdir(exist_ok=True)
        (tmp_path / "landing" / f"f{i}.json").write_text('{"resourceType": "Patient", "id": "%d"}\n' % i)
    n = run_ingest(spark, str(tmp_path / "landing"), str(tmp_path / "routed"), str(tmp_path / "ck"),
                   max_bytes_per_trigger=40)
    batches = len(list((tmp_path / "ck" / "commits").glob("[0-9]*")))
    assert n == 5 and batches > 1


def _batches(landing, n, start=0):
    """n landed files; returns the lines per route."""
    landing.mkdir(exist_ok=True)
    for i in range(start, start + n):
        lines = [{"resourceType": t, "id": str(i)} for t in ("Patient", "Condition", "Observation")] * (i + 1)
        with open(landing / f"f{i:03d}.json", "w") as f:
            f.writelines(json.dumps(line) + "\n" for line in lines)
            f.write("{broken\n")
    return sum(i + 1 for i in range(start, start + n))


def test_ingest_counts_per_type_over_batches_and_a_replay(spark, tmp_path):
    from clinark.streaming.ingest import ingest_counts
    landing, routed, ck = tmp_path / "landing", str(tmp_path / "routed"), str(tmp_path / "ck")
    each = _batches(landing, 3)
    want = {"Patient": each, "Condition": each, "Encounter": 0, "MedicationRequest": 0, "Observation": each, "_unmatched": 3}
    assert ingest_counts(spark, str(landing), routed, ck, max_files_per_trigger=1) == want
    assert len(list((tmp_path / "ck" / "commits").glob("[0-9]*"))) == 3
    assert ingest_counts(spark, str(landing), routed, ck) == dict.fromkeys(want, 0)      # a replay
    assert {r[0]: r[1] for r in routed_counts(spark, routed).collect()} == {k: v for k, v in want.items() if v}


def test_ingest_does_not_read_the_routed_root(spark, tmp_path, monkeypatch):
    """Neither before nor after the run: every read of the session is watched."""
    from pyspark.sql import DataFrameReader

    from clinark.streaming.ingest import ingest_counts
    each = _batches(tmp_path / "landing", 2)

    def refuse(*args, **kw):
        raise AssertionError("the routed root was read")
    for name in ("load", "text", "json"):
        monkeypatch.setattr(DataFrameReader, name, refuse)
    got = ingest_counts(spark, str(tmp_path / "landing"), str(tmp_path / "routed"), str(tmp_path / "ck"))
    assert got["Patient"] == each


def test_batches_whose_reports_were_missed_are_counted_from_their_files(spark, tmp_path):
    """12 batches with 2 reports kept and a poll only at the end: the others come from the sink log, which
    compacts its list after the 10th."""
    from clinark.streaming.ingest import ingest_counts
    landing, routed, ck = tmp_path / "landing", str(tmp_path / "routed"), str(tmp_path / "ck")
    each = _batches(landing, 12)
    key = "spark.sql.streaming.numRecentProgressUpdates"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "2")
        got = ingest_counts(spark, str(landing), routed, ck, poll_seconds=300, max_files_per_trigger=1)
    finally:
        spark.conf.set(key, old)
    assert got["Patient"] == got["Condition"] == got["Observation"] == each and got["_unmatched"] == 12


def test_rows_and_lines_are_split_by_one_scan_and_one_parse(spark, tmp_path):
    from clinark.operators import normalize
    from clinark.plans.jobs import CLEAN_JOBS
    from clinark.sources.parquet import read_clean, write_split
    from clinark.sources.raw import read_lines
    bad = ["{broken", "{broken", "[1, 2]", '[{"id": "x"}]', '"text"', "nonsense"]
    for resource, name, fn in (*CLEAN_JOBS, ("MedicationRequest", "medications", normalize.normalize_medications)):
        _land(tmp_path / "raw" / resource, [
            {"resourceType": resource, "id": "a1", "code": {"coding": [{"code": "A"}]}}, *bad, "", "  ",
            {"resourceType": resource, "id": "a2", "address": {"odd": 1}, "code": {"coding": [{"code": "B"}]}, "period": 7}])
        rows = fn(read_lines(spark, str(tmp_path / "raw"), resource, "directory"))
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1 and plan.count("Relation") == 1
        for clustered in ([False, True] if name != "medications" else [False]):
            root = tmp_path / f"out-{clustered}"
            got = write_split(rows, str(root / name), str(root / "bad" / name), name, clustered)
            assert got == (2, len(bad))
            assert sorted(p.name for p in root.iterdir()).count(name) == 1     # no staging folder is left
            clean = read_clean(spark, str(root), name, clustered=clustered)
            assert clean.count() == 2
            assert sorted(r[0] for r in spark.read.parquet(str(root / "bad" / name)).collect()) == sorted(bad)
            assert set(spark.read.parquet(str(root / name)).columns) == set(clean.columns)


def test_landed_and_routed_lines_are_compressed_files_of_bounded_lines(spark, tmp_path, monkeypatch):
    """Landing and routed root are stored compressed, hold every line, and no file more than the bound."""
    import gzip

    from clinark.sources import raw
    monkeypatch.setitem(raw.TEXT_OPTIONS, "maxRecordsPerFile", "400")
    land_mixed(spark, SF_SMALL, str(tmp_path / "landing"))
    landed = spark.read.text(str(tmp_path / "landing")).count()
    assert run_ingest(spark, str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "ck")) == landed
    assert routed_counts(spark, str(tmp_path / "raw")).agg(F.sum("lines")).first()[0] == landed
    for folder in ("landing", "raw"):
        files = list((tmp_path / folder).rglob("part-*"))
        lines = [gzip.decompress(f.read_bytes()) for f in files]        # raises on a file that is not compressed
        assert sum(text.count(b"\n") for text in lines) == landed
        assert max(text.count(b"\n") for text in lines) <= 400
        assert sum(f.stat().st_size for f in files) * 4 < sum(map(len, lines))


def test_lines_landed_by_type_are_compressed(spark, tmp_path):
    from clinark.sources.landing import land_by_type
    from clinark.sources.raw import malformed_lines
    land_by_type(spark, SF_SMALL, str(tmp_path))
    assert all(f.name.endswith(".gz") for f in tmp_path.rglob("part-*"))
    assert read_raw(spark, str(tmp_path), "Encounter", "directory").count() == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert malformed_lines(spark, str(tmp_path), "Encounter", "directory").count() > 0


def test_routing_keeps_a_file_open_for_every_route(spark, tmp_path):
    from clinark.streaming import ingest
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.json").write_text("".join(
        f'{{"resourceType": "{t}", "id": "{i}"}}\n' for i in range(20) for t in (*ingest.ROUTES[:-1], "Claim")))
    before = spark.conf.get(ingest.OPEN_FILES)
    q = ingest.start_ingest(spark, str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "ck"))
    q.awaitTermination()
    # Without enough open files the write sorts every task's lines by route.
    assert int(q._jsq.sparkSession().conf().get(ingest.OPEN_FILES)) >= len(ingest.ROUTES)
    assert spark.conf.get(ingest.OPEN_FILES) == before
    assert {r[0]: r[1] for r in ingest.routed_counts(spark, str(tmp_path / "raw")).collect()} == dict.fromkeys(ingest.ROUTES, 20)


def test_tasks_over_compressed_lines_take_less(spark, tmp_path):
    from clinark.sources.raw import COMPRESSED_SHARE, line_session
    lines = spark.createDataFrame([(f'{{"resourceType": "Patient", "id": "{i}"}}',) for i in range(50)], "value string")
    lines.write.text(str(tmp_path / "plain" / "Patient"))
    lines.write.option("compression", "gzip").text(str(tmp_path / "packed" / "Patient"))
    size = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    assert line_session(spark, str(tmp_path / "plain"), "Patient", "directory") is spark
    session = line_session(spark, str(tmp_path / "packed"), "Patient", "directory")
    assert session._jsparkSession.sessionState().conf().filesMaxPartitionBytes() == size // COMPRESSED_SHARE
    assert session.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() == size
    assert read_raw(session, str(tmp_path / "packed"), "Patient", layout="directory").count() == 50
