import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from reelhouse.session import get_session
    s = get_session("local[4]", shuffle_partitions=8, app_name="reelhouse-tests")
    yield s


@pytest.fixture(scope="session")
def wh(spark):
    from reelhouse.plans.warehouse import Warehouse
    return Warehouse(spark, SF_SMALL)


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from reelhouse.sources.tables import TEST_TABLES
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
