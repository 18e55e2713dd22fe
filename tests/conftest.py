import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from histloom.sources.io import session
    s = session(master="local[4]", shuffle_partitions=8, app="histloom-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def src(spark):
    from histloom.sources.fixtures import load_sources
    return load_sources(spark, SF_SMALL)


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def rows_as_text(rows, cols):
    """Order-insensitive, type-neutral view of a result for comparisons."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple("<NULL>" if r[i] is None else str(r[i]) for i in order) for r in rows)
