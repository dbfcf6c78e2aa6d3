from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from viewmill.session import build_session  # noqa: E402
from viewmill.sources.store import StarStore  # noqa: E402

SF_ROOT = Path(os.environ.get("TEST_SF_ROOT", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = SF_ROOT / "sf0.001"
    if not path.exists():
        pytest.skip("test tables are not available")
    return str(path)


@pytest.fixture
def store(spark, tmp_path):
    return StarStore(spark, str(tmp_path / "star")).init()
