from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from footfall.session import build_session

    s = build_session("local[8]", app_name="footfall-tests", shuffle_partitions=8)
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="footfall-tests-"))
    yield s
    s.stop()


@pytest.fixture()
def run_dir(spark):
    import uuid

    from footfall.session import shared_dir

    return shared_dir(spark, "tests", uuid.uuid4().hex[:12])
