from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = os.environ.get("COURTLINE_TEST_SF", "/root/testdata/sf0.001")
FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


@pytest.fixture(scope="session")
def spark():
    from courtline.session import build_session

    extra = {}
    # tests set their own checkpoint root only when the environment names none
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="courtline-test-ckpt-")
    s = build_session("local[4]", app_name="courtline-tests", shuffle_partitions=8,
                      extra=extra)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


@pytest.fixture
def fixtures_dir():
    return FIXTURES
