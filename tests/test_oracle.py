"""Every query against its SQL, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import SMALL
from tools.check_oracle import TABLES, TYPES, normalized
from workload.registry import QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    rel = duck.sql(contract.oracle_sql()[name])
    assert dict(df.dtypes) == {c: TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert normalized(df.columns, df.collect()) == normalized(rel.columns, rel.fetchall())
