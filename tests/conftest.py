import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from smishlens.session import get_spark
    s = get_spark("local[4]", 4, app_name="smishlens-tests")
    yield s
    s.stop()
