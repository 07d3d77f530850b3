import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodestone.plans.queries_tables import NAMES  # noqa: E402
from lodestone.session import local_session  # noqa: E402

DATA = os.environ.get("LODESTONE_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="lodestone-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip(f"no test tables in {DATA}")
    return DATA


@pytest.fixture(scope="session")
def duck(data):
    con = duckdb.connect()
    for name in NAMES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return con


@pytest.fixture
def scratch(spark):
    from lodestone.session import scratch_path
    return lambda label="t": scratch_path(spark, label)
