from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from gristmill.session import build


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="checkpoint-")  # one machine, so every task sees it
    session = build(
        "tests", "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.log.level": "ERROR", "spark.checkpoint.dir": shared},
    )
    yield session
    session.stop()
