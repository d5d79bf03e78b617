from __future__ import annotations

import pytest

from obsframe.operators.neighbours import CELL_CONF
from obsframe.session import BROADCAST_CELLS_CONF, GROUP_ROWS_CONF, local_session
from tests.compare import duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    return duck(SMALL)


@pytest.fixture
def split(spark):
    """Force the forms meant for keys too large for one task and sides too large to broadcast."""
    forced = {GROUP_ROWS_CONF: "60", BROADCAST_CELLS_CONF: "8", CELL_CONF: "16"}
    for name, value in forced.items():
        spark.conf.set(name, value)
    yield
    for name in forced:
        spark.conf.unset(name)
