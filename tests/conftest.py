import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from samples import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from paylake.session import build_session

    s = build_session("local[*]", shuffle_partitions=8, app_name="paylake-tests",
                      extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from paylake.sources.tables import BASE_TABLES

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
