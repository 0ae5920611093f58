"""Every corpus query that SQL can express against its twin, on the smallest tables."""

import duckdb
import pytest

from plymill.llm import catalog


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "pages"):
        connection.execute(f"create view {name} as select * from '{small}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_same_rows(spark, duck, small, name):
    frame = catalog.QUERIES[name](spark, small)
    columns = sorted(frame.columns)
    other = duck.sql(catalog.ORACLE[name])
    assert sorted(other.columns) == columns
    ours = sorted(map(tuple, frame.select(*columns).collect()), key=str)
    assert ours
    assert ours == sorted(map(tuple, other.select(*columns).fetchall()), key=str)
