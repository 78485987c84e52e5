import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from tallyworks.session import build

    session = build("local[4]", "tests", 4, **{"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
