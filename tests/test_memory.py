"""What the driver's Python holds while a query runs doesn't follow the tables that the local API serves."""

import os
import tracemalloc

import pytest

from test_queries import DATA, TABLES, plain

from tidewire import queries

COPIES, LIMIT_MB = 20, 20
#: Column: the table whose rows number it, so that copies don't share its values.
KEYS = {"c_custkey": "customer", "o_custkey": "customer", "s_suppkey": "supplier", "l_suppkey": "supplier", "p_partkey": "part", "l_partkey": "part", "o_orderkey": "orders", "l_orderkey": "orders", "event_id": "events"}
QUERIES = [
    "a1_count",
    "a2_count_column",
    "a4_aggregates",
    "a7_distinct_declined",
    "a3_sum",
    "a5_minmax_declined",
    "a7_group_declined",
    "c1_checkpoint_incremental",
    "c5_checkpoint_timestamp",
    "e2_explode_outer",
    "e1_explode_inner",
    "c4_failing_block",
    "e3_explode_objects",
    "e4_exploded_listing",
    "e6_strict_in_variant",
    "f1_filter_eq",
    "f2_verified_filter",
    "f1_filter_gt_lte",
    "f1_filter_neq",
    "f3_filter_range",
    "f5_filter_time",
    "f4_reserved_parameter",
    "f6_filter_residual",
    "g1_rollup",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def larger(tmp_path_factory):
    duckdb = pytest.importorskip("duckdb")
    folder, c = tmp_path_factory.mktemp("larger"), duckdb.connect()
    rows = {t: c.execute(f"SELECT count(*) FROM '{DATA}/{t}.parquet'").fetchone()[0] for t in TABLES}
    for t in TABLES:
        columns = [x[0] for x in c.execute(f"DESCRIBE SELECT * FROM '{DATA}/{t}.parquet'").fetchall()]
        cells = [f"{x} + i * {rows[KEYS[x]]} AS {x}" if x in KEYS else x for x in columns]
        c.execute(f"COPY (SELECT {', '.join(cells)} FROM '{DATA}/{t}.parquet', range({1 if t in ('region', 'nation') else COPIES}) AS copies(i)) TO '{folder}/{t}.parquet'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return folder, c


@pytest.mark.parametrize("name", QUERIES)
def test_driver_holds_little(spark, larger, tmp_path, name):
    folder, db = larger
    os.symlink(folder, tmp_path / "tables")  # a path of its own, so an API of its own
    tracemalloc.start()
    try:
        df = queries.queries()[name](spark, str(tmp_path / "tables"))
        df.write.parquet(str(tmp_path / "out"))
        peak = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert peak < LIMIT_MB
    cols = sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in spark.read.parquet(str(tmp_path / "out")).select(cols).collect()]
    want = db.execute(f"SELECT {', '.join(cols)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert len(got) == len(want) and plain(got) == plain(want)
