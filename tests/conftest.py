import json
import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clinark.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="clinark-tests")
    yield s


@pytest.fixture()
def raw_lines(spark, tmp_path):
    """Write hand-written FHIR lines (dicts or raw text) per type and read them back
    with the declared raw schema (directory layout)."""
    from clinark.sources.raw import read_raw

    def make(resource, lines, corrupt=None):
        root = tmp_path / f"raw-{uuid.uuid4().hex[:6]}"
        d = root / resource
        d.mkdir(parents=True)
        with open(d / "part-0.json", "w") as f:
            for line in lines:
                f.write((line if isinstance(line, str) else json.dumps(line)) + "\n")
        return read_raw(spark, str(root), resource, layout="directory", corrupt=corrupt)
    return make
