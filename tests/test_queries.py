"""Every registered query against its SQL on the given tables."""

from pathlib import Path

import duckdb
import pytest

from workload.oracles import ORACLES
from workload.queries import REGISTRY as QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        [tuple(repr(row[i]) for i in order) for row in rows])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    df = QUERIES[name](spark, SF)
    got = comparable(df.columns, df.collect())
    result = database.execute(ORACLES[name])
    want = comparable([d[0] for d in result.description], result.fetchall())
    assert got == want


def test_entry(spark):
    import __spark_entry__ as driver
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())
    rows = {r["split"]: r["rows"] for r in driver.entry(spark).collect()}
    assert rows["total"] == sum(n for split, n in rows.items() if split != "total") > 0
