from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from adevents.session import get_session

    s = get_session("local[4]", spark__sql__shuffle__partitions="8")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def events(spark):
    from adevents.plans.adapter import load_ad_events

    return load_ad_events(spark, SF_SMALL).cache()


@pytest.fixture()
def scratch(spark):
    """A fresh folder below the session's checkpoint folder (local path)."""
    from adevents.session import scratch_path

    path = scratch_path(spark, "test")
    return path[len("file:"):] if path.startswith("file:") else path
