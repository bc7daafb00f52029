"""The registered training-data queries: SQL where there is one."""

import pytest

from samples import SF_SMALL
from paylake.llm.queries import ORACLES, QUERIES
from tools.check_oracle import rows_of


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(n for n in set(QUERIES) - set(ORACLES) if n.split("_")[0] not in ("op9", "op11", "op13")))
def test_covers_every_document(spark, name):
    got = QUERIES[name](spark, SF_SMALL).select("doc_id").distinct().count()
    assert got == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
