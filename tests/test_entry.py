"""Every registered query against its SQL on the smallest driver tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from standin import catalog, oracle

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="driver tables not present")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_its_sql():
    assert set(oracle.oracle_sql()) == set(catalog.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_query(spark):
    df = entry.entry(spark)
    assert df.columns == ["ac_year", "india_state_ut", "management", "total", "foundational",
                          "preparatory", "middle", "secondary"]
    assert not df.isEmpty()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, str(DATA))
    cursor = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    columns = sorted(df.columns)
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(r[i] for i in order) for r in cursor.fetchall())
    ours = Counter(tuple(r) for r in df.select(*columns).collect())
    assert ours == theirs
