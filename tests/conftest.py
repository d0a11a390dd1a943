import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
from compare import session  # noqa: E402

from pairloom.runtime import ship_package  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = session("8", shuffles="4")
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def sf():
    return SF
