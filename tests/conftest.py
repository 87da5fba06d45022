from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerflow.session import apply_job_settings, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "ledgerflow-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    apply_job_settings(session)
    yield session
    session.stop()
