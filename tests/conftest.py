"""One local session for all tests; everything written goes to a temporary folder."""

from __future__ import annotations

import os

import pytest

from parcelflow import new_session

TABLES = os.environ.get("TEST_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = new_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables() -> str:
    return TABLES


@pytest.fixture
def folder(tmp_path) -> str:
    return str(tmp_path)
