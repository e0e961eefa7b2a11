import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tillweave import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    built = session.build(
        "tillweave-tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.log.level": "ERROR",
            "spark.driver.memory": "8g", "spark.sql.session.timeZone": "UTC",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tillweave-checkpoints-"),
        },
    )
    yield built
    built.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="tillweave-data-")
