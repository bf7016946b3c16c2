import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from dexflow.session import build_session
    s = build_session("local[4]", 8, app_name="dexflow-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fx_dims(spark):
    from dexflow.plans.events import Dimensions
    from dexflow.sources import fixtures
    return Dimensions(fixtures.pool_seed(spark), fixtures.token_known(spark))
