import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledger.llm.common import ship  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def code(spark):
    ship(spark)
