import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledger.session import build_session, clear_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledger-"), "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR",
    })
    yield session
    clear_scratch(session)
    session.stop()
