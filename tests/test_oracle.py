"""Every registered query with a SQL oracle must equal DuckDB at sf0.01."""
import pytest

import __spark_entry__ as E
from conftest import SF001
from duelframe.plans.catalog import QUERIES
from oracle_compare import compare

SQL = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck_sf001, name):
    df = E.queries()[name](spark, SF001)
    assert compare(df, duck_sf001, SQL[name]) == []


def test_every_query_registered_has_callable():
    assert set(SQL) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert {r["split"] for r in rows} == {"train", "test"}
    assert sum(r["n_rows"] for r in rows) == 1500
