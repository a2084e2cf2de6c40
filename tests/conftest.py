import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = sys.path[0] + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build

    session = build("local[8]", 8, **{"spark.driver.memory": "6g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tessera-test-")})
    yield session
    session.stop()
