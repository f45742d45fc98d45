import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from brindle.session import local_session

    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        "tests",
        8,
        **{
            "spark.checkpoint.dir": str(root / "checkpoints"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.sql.shuffle.partitions": "3",
        },
    )
    yield session
    session.stop()
