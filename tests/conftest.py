import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from kindred.session import build_session
    extra = {"spark.driver.memory": "8g"}
    # Tests pick their own shared folder only where the environment names none.
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="kindred-test-ckpt-")
    s = build_session("local[8]", app="kindred-tests", shuffle_partitions=8, extra=extra)
    yield s
    s.stop()
