import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from recount.session import local_session

    s = local_session("*", app="recount-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def cat(spark):
    from recount.sources.fixtures import FixtureCatalog

    return FixtureCatalog(spark, SF_SMALL)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_text(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()
