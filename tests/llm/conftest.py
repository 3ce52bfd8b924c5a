from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

from snapledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("llm-tests", "local[8]", **{
        "spark__sql__shuffle__partitions": "4",
        "spark__ui__enabled": "false",
        "spark__driver__memory": "6g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
