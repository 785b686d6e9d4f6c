import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from keelstone.session import session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = ship(session(4, 4, **{"spark.driver.memory": "4g"}))
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
