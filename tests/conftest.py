from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from gleaner.session import build_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    extra = {"spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}"}
    session = build_session("local[4]", 4, **extra)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA
