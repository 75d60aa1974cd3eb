"""Every registered check against its SQL, at the smallest scale."""

from __future__ import annotations

from pathlib import Path

import pytest

from suite.compare import compare, connect
from suite.registry import load

SF_DIR = "/root/testdata/sf0.001"
CHECKS = load()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", CHECKS)
def test_same_rows_as_sql(spark, duck, name):
    assert compare(spark, duck, CHECKS[name], SF_DIR) is None
