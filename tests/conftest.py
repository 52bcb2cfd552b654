import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallychain.plans import registry  # noqa: E402
from tallychain.session import local_session, shared_dir  # noqa: E402
from tests.oracle_check import connect  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, app="tests")


@pytest.fixture(scope="session")
def duck():
    return connect(SF)


@pytest.fixture(scope="session")
def derived(spark):
    """Relations derived from the given tables on every use."""
    return registry.Chain(spark, SF)


@pytest.fixture(scope="session")
def stored(spark, derived):
    """The same relations normalised once into Parquet."""
    path = shared_dir(spark, "tests")
    registry.store_chain(derived, path, by_month=False)
    return registry.StoredChain(spark, SF, path)
