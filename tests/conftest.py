from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillstream.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def folder() -> str:
    return SMALL


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
