"""Every query of the engine against its SQL, on the smallest tables."""

import math
import os

import pytest

from tidewire import queries

DATA = os.environ.get("TIDEWIRE_TESTDATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(rows):
    return sorted(repr(tuple(round(v, 6) if isinstance(v, float) and not math.isnan(v) else v for v in r)) for r in rows)


def test_tables_of_many_pages(spark):
    """More pages than the default of max-pages; and limits that hold the whole table."""
    e = queries.engine(spark, DATA, page=1)
    held = queries.api(DATA).resources
    assert len(held["orders"].rows) > 1000
    assert e.sql(f"SELECT o_orderkey FROM {e.name}.orders").count() == len(held["orders"].rows)
    for name in ("customer", "supplier"):
        assert e.catalog.table(name).table.pagination.max_pages > len(held[name].rows)


def test_limit_follows_the_table(spark, monkeypatch):
    seen = []
    real = queries.Engine.table
    monkeypatch.setattr(queries.Engine, "table", lambda self, name, **kw: (seen.append((name, kw.get("limit"))), real(self, name, **kw))[1])
    queries.queries()["st1_limited_broadcast"](spark, DATA)
    assert ("customer", len(queries.api(DATA).resources["customer"].rows)) in seen


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query(spark, db, name):
    df = queries.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    want = db.execute(f"SELECT {', '.join(cols)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert len(got) == len(want) and plain(got) == plain(want)
