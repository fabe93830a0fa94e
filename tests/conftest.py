import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from flowquarry.session import local_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(4, "4g", 4, **{"spark.sql.warehouse.dir": str(folder / "warehouse"), "spark.checkpoint.dir": str(folder / "shared"), "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"})
    ship_package(session)
    yield session
    session.stop()
