from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tracewise.session import get_session
    s = get_session(f"local[{os.environ.get('TEST_CPUS', '*')}]", app="tracewise-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark, tmp_path):
    return str(tmp_path)
