from __future__ import annotations

import pathlib
import sys

import pytest

HERE = pathlib.Path(__file__).resolve().parent
sys.path[:0] = [str(HERE.parent), str(HERE)]

from saldo.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "saldo-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
