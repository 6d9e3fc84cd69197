"""Every registered query equals its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
import __spark_entry__ as entry  # noqa: E402
from touchline import catalog  # noqa: E402
from tools.check import TABLES, compare  # noqa: E402

catalog.load_all()
DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, name):
    outcome = compare(spark, con, str(DATA), name)
    assert outcome.startswith("ok") and "TYPES" not in outcome, outcome


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())
