"""The operators' queries against their SQL, at the smallest scale."""

import duckdb
import pytest

from layerwright.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL
from tools.check_oracle import TABLES, TYPES, normalized


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    rel = duck.sql(ORACLES[name])
    assert dict(df.dtypes) == {c: TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert normalized(df.columns, df.collect()) == normalized(rel.columns, rel.fetchall())
