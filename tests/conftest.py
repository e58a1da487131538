import os
import sys
from pathlib import Path

import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from stemmata.runtime import session

    found = session("tests", cores="8", memory="8g")
    yield found
    found.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(value):
    """A cell in a form in which both engines' values compare."""
    if value is None or value is pd.NA or value != value:
        return None
    if isinstance(value, float):
        # A column of whole numbers with nulls is one of floats in pandas.
        return int(value) if value.is_integer() and abs(value) < 2**53 else round(value, 9)
    return int(value) if hasattr(value, "dtype") and value.dtype.kind in "iu" else str(value) if not isinstance(value, (int, bool)) else value


@pytest.fixture(scope="session")
def same():
    def check(df, sql_result):
        ours, theirs = df.toPandas(), sql_result.df()
        assert sorted(ours.columns) == sorted(theirs.columns)
        rows = lambda x: sorted(str([plain(v) for v in r]) for r in x[sorted(x.columns)].itertuples(index=False))
        assert rows(ours) == rows(theirs)

    return check
