import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from leafmill.plans.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("work")
    session = local_session(
        "tests",
        4,
        **{
            "spark.checkpoint.dir": f"file://{work}/checkpoint",
            "spark.sql.warehouse.dir": f"file://{work}/warehouse",
        },
    )
    yield session
    session.stop()
