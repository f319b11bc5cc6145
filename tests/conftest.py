import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from annolith.session import local_session

    session = local_session(cores="4", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
