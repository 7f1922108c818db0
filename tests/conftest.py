import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderloom.session import ONE_MACHINE, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "orderloom-tests",
        master="local[4]",
        shuffle_partitions=4,
        **ONE_MACHINE,
        **{"spark.sql.warehouse.dir": str(root / "warehouse"), "spark.checkpoint.dir": str(root / "checkpoint")},
    )
    yield session
    session.stop()
