from __future__ import annotations

import pytest

from tabloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = build_session("tabloom-tests", master="local[8]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
