from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus  # noqa: E402


@pytest.fixture(scope="session")
def data():
    return corpus.rows()


@pytest.fixture(scope="session")
def documents(spark, data):
    return corpus.frame(spark, data).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return corpus.frame(spark, [])
