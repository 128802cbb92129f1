"""Every query against its SQL on the driver's tables."""

import os
from pathlib import Path

import pytest

from gridloom.plans.registry import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for f in Path(sf_dir).glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    for c in frame:
        if frame[c].dtype.kind == "M":
            frame = frame.assign(**{c: frame[c].astype("datetime64[us]").astype(str)})
        elif frame[c].dtype.kind == "f":
            frame = frame.assign(**{c: frame[c].astype(float)})
    return sorted(map(repr, frame.itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert len(got) or os.environ.get("TEST_SF_DIR")
    if name in ORACLE_SQL:
        want = duck.sql(ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_driver_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
