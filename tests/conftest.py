import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from claimworks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(8, 2, **{
        "spark.sql.warehouse.dir": str(base / "warehouse"),
        "spark.checkpoint.dir": str(base / "shared"),
        "spark.driver.memory": "6g",
    })
    yield session
    session.stop()


@pytest.fixture
def new_table(tmp_path):
    """A free table name and a folder for it."""
    def make(label="t"):
        name = f"{label}_{uuid.uuid4().hex[:12]}"
        return name, str(tmp_path / name)
    return make
