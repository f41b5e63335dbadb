"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    yield con
    con.close()


def cell(value):
    if value is None or value is pd.NaT or (not hasattr(value, "__len__") and pd.isna(value)):
        return ""
    if isinstance(value, float):
        return repr(value)
    return str(value)


def canonical(frame):
    return sorted(tuple(cell(v) for v in row) for row in frame[sorted(frame.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, small, name):
    ours = contract.queries()[name](spark, small).toPandas()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert len(ours) > 0
        return
    theirs = duck.execute(sql).df()
    for name in ours.columns:
        # pandas has whole numbers with nulls as floats
        if str(ours[name].dtype) == "float64" and str(theirs[name].dtype).startswith("Int"):
            ours[name] = ours[name].astype(theirs[name].dtype)
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["window_start", "window_end", "event_type", "count"]
    assert not result.isEmpty()


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
