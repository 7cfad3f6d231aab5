import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from gustline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "gustline-tests",
        "UTC",
        master="local[4]",
        settings={
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="gustline-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    path = os.environ.get("GUSTLINE_TEST_TABLES", "/root/testdata/sf0.001")
    if not Path(path, "events.parquet").exists():
        pytest.skip(f"no tables in {path}")
    return path


@pytest.fixture
def zone(spark):
    """Set the session time zone for one test."""
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    yield lambda name: spark.conf.set(key, name)
    spark.conf.set(key, before)
