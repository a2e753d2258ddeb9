"""The command line drives the whole flow: land → ingest → job → register."""

from clinark.__main__ import main
from conftest import SF_SMALL


def test_cli_end_to_end(spark, tmp_path, capsys):
    d = tmp_path
    assert main(["land", "--sf-dir", SF_SMALL, "--landing", str(d / "landing")]) == 0
    assert main(["ingest", "--landing", str(d / "landing"), "--routed", str(d / "raw"),
                 "--checkpoint", str(d / "ck"), "--archive", str(d / "picked")]) == 0
    assert main(["job", "--raw", str(d / "raw"), "--out", str(d / "out")]) == 0
    assert main(["register", "--clean", str(d / "out" / "clean"), "--db", "medical_cli_t"]) == 0
    out = capsys.readouterr().out
    assert "routed " in out and "'diagnosis_statistics': " in out
    assert "registered medical_cli_t.conditions" in out
    n = spark.sql("SELECT count(*) AS n FROM medical_cli_t.conditions").first()["n"]
    audit = {line.split("'")[1]: int(line.split(": ")[1].split()[0])
             for line in out.splitlines() if line.startswith("'")}
    assert n == audit["conditions"] > 0
