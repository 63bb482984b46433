import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from cardwarden.session import local_session

    session = local_session(cores=8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def seed(spark):
    import seed as rows

    return rows.tables(spark)
