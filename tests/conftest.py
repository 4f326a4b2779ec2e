from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridmart.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tests set their own checkpoint folder because no cluster names one.
    ckpt = tempfile.mkdtemp(prefix="gridmart-test-ckpt-")
    session = get_session("local[4]", app="gridmart-tests", shuffle_partitions=4,
                          extra={"spark.checkpoint.dir": ckpt,
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    yield session


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="gridmart-test-")
