"""Queries over an API that serves the test tables, and the same queries in SQL on the tables themselves."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .plans.engine import Engine
from .session import prepare
from .sources import config as configs
from .sources import hocon
from .sources.datasource import RestSource
from .testing.mockapi import MockApi, describe

CONFIG = """
openapi = "mock"            # the description is passed in
base-url = ${BASE}
pagination { style = offset, offset-param = offset, page-size-param = limit, max-page-size = ${PAGE}, results-path = "/results" }
schema { flatten-depth = 2, array-handling = both, arrow-batch-size = 8192 }
http { timeout = "60 seconds", max-retries = 2 }
tables {
  region    { endpoint = "/region.all", pagination { style = none } }
  nation    { endpoint = "/nation", data-path = "/results", filters = [{ param = region, column = n_regionkey, operators = [eq] }] }
  customer  {
    endpoint = "/customer.cursor", data-path = "/items"
    pagination { style = cursor, cursor-param = cursor, cursor-path = "/next", page-size-param = page_size, max-page-size = ${PAGE} }
    filters = [{ param = segment, column = c_mktsegment, operators = [eq] }, { param = not_segment, column = c_mktsegment, operators = [neq] }]
  }
  supplier  { endpoint = "/supplier.link", pagination { style = link_header, page-size-param = per_page, max-page-size = 40 } }
  orders    {
    endpoint = "/orders", data-path = "/results"
    filters = [
      { param = status, column = o_orderstatus, operators = [eq] }
      { param = min_price, column = o_totalprice, operators = [gte] }
      { param = max_price, column = o_totalprice, operators = [lt] }
      { param = since, column = o_orderdate, operators = [gte] }
      { param = until, column = o_orderdate, operators = [lt] }
    ]
    aggregations {
      n     { function = count, endpoint = "/orders/stats", response-path = "/count" }
      total { function = sum, column = o_totalprice, endpoint = "/orders/stats", response-path = "/sum", params { column = o_totalprice } }
      mean  { function = avg, column = o_totalprice, endpoint = "/orders/stats", response-path = "/avg", params { column = o_totalprice } }
      most  { function = max, column = o_totalprice, endpoint = "/orders/stats", response-path = "/max" }
    }
  }
  orders_reserved { endpoint = "/orders", data-path = "/results", filters = [{ param = limit, column = o_custkey, operators = [eq] }] }
  orders_by_status { endpoint = "/orders", data-path = "/results", partition { type = enum, param = status, values = [P, F, O] } }
  orders_by_date {
    endpoint = "/orders", data-path = "/results"
    filters = [{ param = since, column = o_orderdate, operators = [gte] }, { param = until, column = o_orderdate, operators = [lt] }]
    partition { type = date-range, column = o_orderdate, start-param = since, end-param = until, range = "365 days", format = "yyyy-MM-dd'T'HH:mm:ss'Z'" }
  }
  lineitem  { endpoint = "/lineitem", data-path = "/results", partition { type = offset, size = ${WINDOW}, count = 8 } }
  customer_orders { endpoint = "/customer_orders", data-path = "/results" }
  order_of  {
    endpoint = "/customer/{c_custkey}/orders", parent-table = some_customers, parent-key = c_custkey, join-strategy = nested_loop
    pagination { style = none }
  }
  orders_in { endpoint = "/orders_by", parent-table = customer, parent-key = c_custkey, join-strategy = batch, batch-param = ids, batch-size = 200, child-key-field = o_custkey, pagination { style = none } }
  some_customers { endpoint = "/customer.cursor", data-path = "/items", pagination { style = none } }
  events    {
    endpoint = "/events", data-path = "/results"
    checkpoint { enabled = true, path = ${STATE}, mode = offset }
  }
  events_since { endpoint = "/events", data-path = "/results", checkpoint { enabled = true, path = ${STATE}, mode = timestamp, timestamp-path = "/ts", timestamp-param = since } }
  event_changes { endpoint = "/events", data-path = "/results", checkpoint { mode = timestamp, timestamp-path = "/ts", timestamp-param = since } }
}
"""

_APIS: dict[str, MockApi] = {}
_ENGINES: dict[tuple, Engine] = {}


def api(sf_dir: str) -> MockApi:
    """The API over a folder of tables, started once for each process and folder."""
    if sf_dir not in _APIS:
        m = MockApi()
        m.page_size = 50_000
        for name, order, time, enums in (
            ("region", "r_regionkey", None, None),
            ("nation", "n_nationkey", None, {"region": "n_regionkey"}),
            ("customer", "c_custkey", None, {"segment": "c_mktsegment", "not_segment": "c_mktsegment"}),
            ("supplier", "s_suppkey", None, None),
            ("part", "p_partkey", None, None),
            ("orders", "o_orderkey", "o_orderdate", {"status": "o_orderstatus", "min_price": "o_totalprice", "max_price": "o_totalprice"}),
            ("lineitem", "l_orderkey", None, None),
            ("events", "event_id", "ts", None),
        ):
            m.add(name, f"{sf_dir}/{name}.parquet", order, time, enums)
        m.children["orders"] = ("customer", "o_custkey")
        m.arrays["customer_orders"] = ("customer", "orders", "o_custkey")
        _APIS[sf_dir] = m.start()
    return _APIS[sf_dir]


def engine(spark: SparkSession, sf_dir: str, fmt: str = "json", mode: str = "strict", page: int = 10_000) -> Engine:
    """The engine over that API."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    m = api(sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, fmt, mode, page)
    if key not in _ENGINES:
        state = tempfile.mkdtemp(prefix="tidewire-state-")
        window = -(-len(m.resources["lineitem"].rows) // 8)
        value = hocon.parse(CONFIG, "queries", {"BASE": m.url, "STATE": state, "PAGE": str(page), "WINDOW": str(window)})
        # a page holds a row at least, so no read of these tables ends at max-pages
        most = 1 + max(len(r.rows) for r in m.resources.values())
        for x in (value, *value["tables"].values()):
            if x is value or "pagination" in x:
                x["pagination"]["max-pages"] = most
        if fmt != "json":
            value["http"]["response-format"] = fmt
            value["tables"] = {"part": {"endpoint": "/part.ndjson"}} if fmt == "ndjson" else {"events": {"endpoint": "/events.sse"}}
            value["pagination"] = {"style": "none"}
        if mode == "variant":
            value["schema"]["mode"] = mode
            value["tables"] = {"events": {"endpoint": "/events", "data-path": "/results"}}
        name = f"api_{os.path.basename(sf_dir.rstrip('/')).replace('.', '_')}_{abs(hash(key)) % 10**8}"
        _ENGINES[key] = Engine(spark, name, configs.of(value), describe(m)).register()
    return _ENGINES[key]


def _times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the tables have them."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name) for f in df.schema])


def _sql(text: str, **kwargs) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        e = engine(spark, sf_dir, **kwargs)
        return _times(e.sql(text.replace("api.", f"{e.name}.")))

    return run


def _limited_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A join with a table whose limit, here the number of its rows, says that it is small."""
    e = engine(spark, sf_dir)
    customers = e.table("customer", limit=max(1, len(api(sf_dir).resources["customer"].rows)))
    orders = e.table("orders", columns=["o_orderkey", "o_custkey"])
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


def _checkpoint(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """Two incremental reads of a table, nothing being added in between."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        e = engine(spark, sf_dir)
        folder = tempfile.mkdtemp(prefix="tidewire-state-")
        table = e.source.tables[name]
        tables = e.source.tables | {name: replace(table, checkpoint=replace(table.checkpoint, path=folder))}
        fresh = Engine(spark, f"{e.name}_{os.path.basename(folder)[-8:].replace('-', '_')}", replace(e.source, tables=tables), describe(api(sf_dir)))
        parts = []
        for i in (1, 2):
            with fresh.incremental(name) as df:
                rows = df.agg(F.count("*").alias("n"), F.coalesce(F.sum("event_id"), F.lit(0)).alias("ids")).collect()[0]
            parts.append((i, rows["n"], rows["ids"]))
        return spark.createDataFrame(parts, "run int, n bigint, ids bigint")

    return run


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two micro-batches: the changes up to a time, and from there to another."""
    e = engine(spark, sf_dir)
    folder = tempfile.mkdtemp(prefix="tidewire-stream-")
    clock = os.path.join(folder, "now")
    name = f"stream_{abs(hash(folder)) % 10**9}"
    source = e.read_stream("event_changes", {"_now": clock, "_start": "2024-01-05T00:00:00Z"})
    for now in ("2024-01-05T00:00:00Z", "2024-01-10T12:00:00Z", "2024-01-20T00:00:00Z"):
        with open(clock, "w", encoding="utf-8") as f:
            f.write(now)
        query = source.writeStream.format("parquet").option("path", os.path.join(folder, "out")).option("checkpointLocation", os.path.join(folder, "cp")).trigger(availableNow=True).queryName(name).start()
        query.awaitTermination()
    return _times(spark.read.schema(source.schema).parquet(os.path.join(folder, "out")).select("event_id", "ts", "user_id", "event_type", "value"))


def _messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of other types than described: converted if there is one reading, else NULL."""
    m = api(sf_dir)
    m.routes["/messy"] = [{"id": "42", "small": 1, "flag": "TRUE", "at": "2024-01-02 03:04:05"}, {"id": 7, "small": 3000000000, "flag": True, "at": ""}, {"id": "4.2", "small": 2, "flag": "yes", "at": "2024-01-02T03:04:05Z"}, {"id": 3.0, "small": "-5", "flag": None}]
    props = {"id": {"type": "integer"}, "small": {"type": "integer", "format": "int32"}, "flag": {"type": "boolean"}, "at": {"type": "string", "format": "date-time"}}
    spec = {"openapi": "3.0.0", "paths": {"/messy": {"get": {"responses": {"200": {"content": {"application/json": {"schema": {"type": "array", "items": {"type": "object", "properties": props}}}}}}}}}}
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    source = configs.of({"openapi": "mock", "base-url": m.url, "tables": {"messy": {"endpoint": "/messy"}}})
    return _times(Engine(spark, f"messy_{abs(hash((spark.sparkContext.applicationId, sf_dir))) % 10**8}", source, spec).table("messy").withColumnRenamed("at", "seen_at"))


def _one_table(spark: SparkSession, name: str, text: str, schema: dict, base_url: str) -> Engine:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    source = configs.of(hocon.parse("openapi = mock\n" + text, "queries", {"BASE": base_url}))
    spec = {"openapi": "3.0.0", "paths": {t.endpoint: {"get": {"responses": {"200": {"content": {"application/json": {"schema": schema}}}}}} for t in source.tables.values()}}
    return Engine(spark, f"{name}_{abs(hash((spark.sparkContext.applicationId, base_url))) % 10**8}", source, spec).register()


_NATION = {"type": "array", "items": {"type": "object", "properties": {"n_nationkey": {"type": "integer", "format": "int32"}, "n_name": {"type": "string"}}}}


def _oauth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A resource that wants a token from the client-credentials flow; the first token is refused, so it is refreshed."""
    m, given = api(sf_dir), []
    m.routes["/oauth/token"] = lambda q, h, b: (given.append(1), {"access_token": f"token{len(given)}", "expires_in": 600})[1]
    m.routes["/secure/nation"] = lambda q, h, b: m.resources["nation"].text({}, 0, 10**6)[0].join("[]") if h.get("Authorization", "").removeprefix("Bearer token").isdigit() and not h["Authorization"].endswith("token1") else (401, {}, "{}")
    text = 'base-url = ${BASE}\nauth { type = oauth2, client-id = id, client-secret = hush, token-url = ${BASE}/oauth/token }\ntables { nation { endpoint = "/secure/nation" } }'
    return _one_table(spark, "oauth", text, _NATION, m.url).table("nation")


def _retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A resource that fails twice for every read before it answers."""
    m, seen = api(sf_dir), []
    m.routes["/shaky/nation"] = lambda q, h, b: (503 if len(seen) % 3 == 1 else 429, {"Retry-After": "0"}, "{}") if (seen.append(1), len(seen) % 3)[1] else m.resources["nation"].text({}, 0, 10**6)[0].join("[]")
    return _one_table(spark, "shaky", 'base-url = ${BASE}\ntables { nation { endpoint = "/shaky/nation" } }', _NATION, m.url).table("nation")


def _greedy_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages larger than asked for: each offset window keeps its own rows only."""
    m = api(sf_dir)
    rows = m.resources["nation"].rows
    m.routes["/greedy/nation"] = lambda q, h, b: '{"results": [' + ", ".join(rows[int(q["offset"]) : int(q["offset"]) + 10]) + "]}"
    text = 'base-url = ${BASE}\npagination { style = offset, page-size-param = limit, max-page-size = 4, results-path = "/results" }\ntables { nation { endpoint = "/greedy/nation", data-path = "/results", partition { type = offset, size = 7, count = 4 } } }'
    return _one_table(spark, "greedy", text, {"type": "object", "properties": {"results": _NATION}}, m.url).table("nation")


def _by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A temporary view over the data source, from a configuration file."""
    m = api(sf_dir)
    m.routes["/openapi.json"] = describe(m)
    folder = tempfile.mkdtemp(prefix="tidewire-config-")
    path = os.path.join(folder, "supplier.conf")
    with open(path, "w", encoding="utf-8") as f:
        f.write(f'openapi = "{m.url}/openapi.json"\nbase-url = "{m.url}"\ncache {{ enabled = false }}\npagination {{ style = none }}\ntables {{ supplier {{ endpoint = "/supplier.all" }} }}\n')
    prepare(spark)
    spark.dataSource.register(RestSource)
    view = f"supplier_{abs(hash(path)) % 10**8}"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} USING tidewire OPTIONS (config '{path}', table 'supplier')")
    return spark.sql(f"SELECT s_suppkey, s_name FROM {view} WHERE s_acctbal > 0")


def _aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = engine(spark, sf_dir).aggregate("orders", n=("count", None), total=("sum", "o_totalprice"), mean=("avg", "o_totalprice"))
    return out.select("n", F.round("total", 2).alias("total"), F.round("mean", 4).alias("mean"))


def _join_parallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = engine(spark, sf_dir)
    df = e.table("orders_in", parallelism=4)
    return df.groupBy(F.col("_parent_c_custkey").cast("bigint").alias("c_custkey")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def _window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("o_orderstatus").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    df = engine(spark, sf_dir).table("orders", columns=["o_orderkey", "o_orderstatus", "o_totalprice"])
    return df.withColumn("rank", rank).filter("rank <= 5")


ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
EVENTS = "event_id, ts, user_id, event_type, value"

#: Name: (the query, its SQL on the tables or None).
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "s1_three_part_name": (lambda s, d: (e := engine(s, d)).sql(f"SELECT r_regionkey, r_name FROM {e.name}.default.region"), "SELECT r_regionkey, r_name FROM region"),
    "s2_scan_offset_nation": (_sql("SELECT n_nationkey, n_name, n_regionkey FROM api.nation"), "SELECT n_nationkey, n_name, n_regionkey FROM nation"),
    "s6_scan_ndjson_part": (_sql("SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM api.part", fmt="ndjson"), "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part"),
    "s7_scan_sse_events": (_sql(f"SELECT {EVENTS} FROM api.events", fmt="sse"), f"SELECT {EVENTS} FROM events"),
    "s9_discovered_table": (_sql("SELECT n_nationkey, n_name FROM api.nation_lines", fmt="ndjson"), "SELECT n_nationkey, n_name FROM nation"),
    "p1_scan_single_region": (_sql("SELECT r_regionkey, r_name FROM api.region"), "SELECT r_regionkey, r_name FROM region"),
    "p2_scan_cursor_customer": (_sql("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM api.customer", page=400), "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"),
    "p4_scan_offset_orders": (_sql(f"SELECT {ORDERS} FROM api.orders", page=4000), f"SELECT {ORDERS} FROM orders"),
    "p8_scan_link_supplier": (_sql("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM api.supplier"), "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"),
    "v1_column_pruning": (_sql("SELECT o_orderstatus, count(*) AS n FROM api.orders GROUP BY o_orderstatus"), "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus"),
    "v4_coerce_messy": (_messy, "SELECT CAST(id AS BIGINT) AS id, CAST(small AS INTEGER) AS small, flag, CAST(seen AS TIMESTAMP) AS seen_at FROM (VALUES (42, 1, true, '2024-01-02 03:04:05'), (7, NULL, true, NULL), (NULL, 2, NULL, '2024-01-02 03:04:05'), (3, -5, NULL, NULL)) AS t(id, small, flag, seen)"),
    "v11_variant_extract": (_sql("SELECT variant_get(value, '$.event_id', 'bigint') AS event_id, variant_get(value, '$.event_type', 'string') AS event_type, round(variant_get(value, '$.value', 'double'), 6) AS value FROM api.events", mode="variant"), "SELECT event_id, event_type, round(value, 6) AS value FROM events"),
    "f1_filter_eq": (_sql("SELECT c_custkey, c_mktsegment FROM api.customer WHERE c_mktsegment = 'BUILDING'"), "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'"),
    "f1_filter_neq": (_sql("SELECT c_custkey FROM api.customer WHERE c_mktsegment <> 'BUILDING'"), "SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'"),
    "f3_filter_range": (_sql("SELECT o_orderkey, o_totalprice FROM api.orders WHERE o_totalprice >= 1000 AND o_totalprice < 200000 AND o_totalprice >= 5000"), "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 5000 AND o_totalprice < 200000"),
    "f5_filter_time": (_sql("SELECT o_orderkey FROM api.orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1997-07-01 00:00:00'"), "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-07-01'"),
    "f6_filter_residual": (_sql("SELECT o_orderkey, o_orderpriority FROM api.orders WHERE o_orderpriority LIKE '1%' OR o_orderkey IN (3, 4, 5) OR o_orderstatus IS NULL"), "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority LIKE '1%' OR o_orderkey IN (3, 4, 5)"),
    "l1_limit_pushdown": (_sql("SELECT count(*) AS n FROM (SELECT c_custkey FROM api.customer LIMIT 25)", page=400), "SELECT count(*) AS n FROM (SELECT c_custkey FROM customer LIMIT 25)"),
    "st1_limited_broadcast": (_limited_broadcast, "SELECT c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment"),
    "r2p_partition_offset": (_sql("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM api.lineitem GROUP BY l_returnflag, l_linestatus"), "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY l_returnflag, l_linestatus"),
    "r3p_partition_enum": (_sql("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM api.orders_by_status GROUP BY o_orderstatus"), "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus"),
    "r4p_partition_date_range": (_sql("SELECT o_orderkey, o_orderdate FROM api.orders_by_date WHERE o_orderdate >= TIMESTAMP '1996-03-01 00:00:00' AND o_orderdate < TIMESTAMP '1999-06-15 00:00:00'"), "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1999-06-15'"),
    "a1_count": (_sql("SELECT count(*) AS n FROM api.orders"), "SELECT count(*) AS n FROM orders"),
    "a3_sum": (_sql("SELECT sum(o_totalprice) AS total FROM api.orders WHERE o_orderstatus = 'F'"), "SELECT round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'F'"),
    "a4_aggregates": (_aggregate, "SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS mean FROM orders"),
    "a5_minmax_declined": (_sql("SELECT min(o_totalprice) AS least, max(o_totalprice) AS most FROM api.orders"), "SELECT min(o_totalprice) AS least, max(o_totalprice) AS most FROM orders"),
    "a7_distinct_declined": (_sql("SELECT count(DISTINCT o_custkey) AS n FROM api.orders"), "SELECT count(DISTINCT o_custkey) AS n FROM orders"),
    "a7_group_declined": (_sql("SELECT o_orderpriority, count(*) AS n FROM api.orders GROUP BY o_orderpriority"), "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority"),
    "j1_join_nested": (_sql("SELECT CAST(_parent_c_custkey AS bigint) AS c_custkey, o_orderkey FROM api.order_of"), None),
    "j3_join_batch": (_sql("SELECT CAST(_parent_c_custkey AS bigint) AS c_custkey, o_orderkey, o_totalprice FROM api.orders_in"), "SELECT c_custkey, o_orderkey, o_totalprice FROM customer JOIN orders ON o_custkey = c_custkey"),
    "j8_join_parallel": (_join_parallel, "SELECT c_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey"),
    "c1_checkpoint_incremental": (_checkpoint("events"), "SELECT CAST(1 AS INTEGER) AS run, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events UNION ALL SELECT 2, 0, 0"),
    "w1_stream_available_now": (_stream, f"SELECT {EVENTS} FROM events WHERE ts > TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20'"),
    "c5_checkpoint_timestamp": (_checkpoint("events_since"), "SELECT CAST(1 AS INTEGER) AS run, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events UNION ALL SELECT 2, count(*), CAST(sum(event_id) AS BIGINT) FROM events WHERE ts = (SELECT max(ts) FROM events)"),
    "s3_view_by_name": (_by_name, "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0"),
    "h2_oauth_refresh": (_oauth, "SELECT n_name, n_nationkey FROM nation"),
    "h4_retries": (_retry, "SELECT n_name, n_nationkey FROM nation"),
    "p5_oversize_pages": (_greedy_pages, "SELECT n_name, n_nationkey FROM nation"),
    "f2_verified_filter": (lambda s, d: engine(s, d).table("customer", columns=["c_custkey"], where={"c_mktsegment": "BUILDING"}, verify=True), "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'"),
    "f4_reserved_parameter": (_sql("SELECT o_orderkey FROM api.orders_reserved WHERE o_custkey = 7"), "SELECT o_orderkey FROM orders WHERE o_custkey = 7"),
    "l2_limit_offset": (lambda s, d: engine(s, d, page=400).table("orders", columns=["o_orderkey"], limit=137).agg(F.count("*").alias("n")), "SELECT count(*) AS n FROM (SELECT 1 FROM orders LIMIT 137)"),
    "g1_rollup": (_sql("SELECT coalesce(o_orderstatus, '-') AS status, coalesce(o_orderpriority, '-') AS priority, count(*) AS n FROM api.orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)"), "SELECT coalesce(o_orderstatus, '-') AS status, coalesce(o_orderpriority, '-') AS priority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)"),
    "g2_window_rank": (_window, "SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(rank AS INTEGER) AS rank FROM (SELECT o_orderkey, o_orderstatus, o_totalprice, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 5"),
    "g3_topk": (_sql("SELECT o_orderkey, o_totalprice FROM api.orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"), "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"),
    "g4_set_operations": (_sql("SELECT n_regionkey AS k FROM api.nation INTERSECT SELECT r_regionkey FROM api.region EXCEPT SELECT 0"), "SELECT n_regionkey AS k FROM nation INTERSECT SELECT r_regionkey FROM region EXCEPT SELECT 0"),
    "g5_join_tables": (_sql("SELECT r_name, count(*) AS n FROM api.customer JOIN api.nation ON c_nationkey = n_nationkey JOIN api.region ON n_regionkey = r_regionkey GROUP BY r_name"), "SELECT r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name"),
}


def _explode(outer: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        e = engine(spark, sf_dir)
        spec = e.catalog.exploded(e.catalog.base("customer_orders"), "orders_keys")
        if outer:
            from .operators.explode import view_sql

            e.table("customer_orders").createOrReplaceTempView(f"{e.name}_base")
            return spark.sql(view_sql(spec, f"{e.name}_base", True)).select("c_custkey", F.col("orders_keys").alias("o_orderkey"))
        return e.sql(f"SELECT c_custkey, orders_keys AS o_orderkey FROM {e.name}.customer_orders_orders_keys")

    return run


QUERIES["e1_explode_inner"] = (_explode(False), "SELECT c_custkey, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_custkey % 3 <> 0")
QUERIES["e2_explode_outer"] = (_explode(True), "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND c_custkey % 3 <> 0")
QUERIES["j1_join_nested"] = (QUERIES["j1_join_nested"][0], "SELECT c_custkey, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey")
QUERIES["a3_sum"] = (lambda s, d: _sql("SELECT sum(o_totalprice) AS total FROM api.orders WHERE o_orderstatus = 'F'")(s, d).select(F.round("total", 2).alias("total")), QUERIES["a3_sum"][1])


def _all() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    from .feature_queries import QUERIES as features  # they are made with this module's helpers

    return QUERIES | features


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: q for k, (q, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in _all().items() if sql}
