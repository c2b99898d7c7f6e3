from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.compare import connect, local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("4")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    return connect(SF)


@pytest.fixture
def new_dir(tmp_path):
    """Function giving a path that does not exist yet."""
    return lambda label="out": str(tmp_path / f"{label}-{uuid.uuid4().hex}")
