from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rollcall.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a DataFrame from dicts, with NULL for what is missing."""

    def make(schema: str, *records: dict):
        names = [part.split()[0] for part in schema.split(", ")]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)

    return make
