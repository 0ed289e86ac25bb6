from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from basketry.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(row) for row in df.collect()), key=str)


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()
