from __future__ import annotations

import pytest

from agoralake import Lake
from agoralake.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A zone with DST gaps: nothing may depend on it.
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "2",
            "spark.sql.session.timeZone": "America/New_York",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path, request):
    name = "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    return Lake(str(tmp_path / "lake"), f"t_{name}")
