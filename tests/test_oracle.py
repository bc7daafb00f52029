"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as se
from samples import SF_SMALL
from tools.check_oracle import rows_of

from paylake.registry import QUERIES

ORACLES = {k: v for k, v in se.oracle_sql().items() if k in QUERIES}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(se.queries())


def test_oracle_restates_its_values():
    """The oracle takes the feeds' SQL from the package, but no operator."""
    import checks.oracle as oracle

    assert not [n for n in vars(oracle) if getattr(vars(oracle)[n], "__module__", "").startswith("paylake.operators")]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = df.collect()
    rel = duck.sql(ORACLES[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert rows_of(df.columns, srows) == rows_of(rel.columns, drows)


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "total_amount" in df.columns
