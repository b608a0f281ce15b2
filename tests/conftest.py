import os
import sys
import warnings

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
warnings.filterwarnings("ignore", category=FutureWarning)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from slotwise.session import local_session
    s = local_session(cpus="*", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def catalog():
    from slotwise.plans import catalog as c
    c.load_all()
    return c
