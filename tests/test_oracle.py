"""Every registered query against its DuckDB oracle on the smallest tables."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from postwave.sources.tables import TABLES
from tools.check_oracle import rows_of

from .conftest import SF_SMALL

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    """All but the training-data operators that SQL cannot say, which have
    brute-force tests of their own."""
    from postwave.plans import catalog
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "language", "post_count", "total_engagement"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert rows_of(df.columns, srows) == rows_of(ocols, orows)
