import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from creditspark.session import local_session

    session = local_session("*", shuffle_partitions=8, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def sf():
    return "/root/testdata/sf0.001"
