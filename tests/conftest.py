from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adtally.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def log(spark, folder):
    from adtally.sources.event_log import ad_log_table

    return ad_log_table(spark, folder)


@pytest.fixture(scope="session")
def scored(spark, folder):
    from adtally.plans.catalog import uplift_table

    return uplift_table(spark, folder)
