import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import local_session  # noqa: E402
from ferrylane.session import configure  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = configure(local_session())
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def read(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def plan_text(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.fixture
def plan_of():
    return plan_text
