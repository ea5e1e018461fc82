"""Every query with SQL equals DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from spanloom import catalog

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 5) + 0.0 if isinstance(v, float) else v


def table(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(plain(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_sql(spark, duck, name):
    assert table(catalog.QUERIES[name](spark, str(DATA)).toPandas()) == table(duck.execute(catalog.ORACLE[name]).fetchdf())
