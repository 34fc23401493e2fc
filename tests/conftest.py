import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = "/root/testdata"
SF001 = f"{DATA}/sf0.001"
SF01 = f"{DATA}/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    from daybook.session import local_session

    s = local_session("*", shuffle_partitions=8, app="daybook-tests")
    yield s
    s.stop()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.fixture(scope="session")
def duck001():
    return duck(SF001)


@pytest.fixture(scope="session")
def duck01():
    return duck(SF01)
