from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from snapledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark__sql__shuffle__partitions": "4",
        "spark__default__parallelism": "4",
        "spark__ui__enabled": "false",
        "spark__driver__memory": "6g",
        # tiny inputs: interpreting is faster than compiling each plan
        "spark__sql__codegen__wholeStage": "false",
        "spark__sql__codegen__factoryMode": "NO_CODEGEN",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
