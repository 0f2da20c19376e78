"""Queries for single features of the engine, each over an API of its own, and their SQL on the tables."""

from __future__ import annotations

import base64
import gzip
import json
import os
import tempfile
import time
import urllib.parse
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .errors import ConfigError, EngineError, collect_clean, redact, redact_url
from .plans.engine import Engine
from .queries import _sql, api, engine
from .session import prepare
from .sources import config as configs
from .sources import hocon
from .sources.datasource import RestSource
from .testing.mockapi import describe, schema_of

Query = Callable[[SparkSession, str], DataFrame]

CART_ORDERS = 10_000


def own(spark: SparkSession, sf_dir: str, name: str, text: str, paths: dict[str, Any], media: str = "application/json", **values: str) -> Engine:
    """An engine over some paths of the API, described by the schemas given."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    m = api(sf_dir)
    source = configs.of(hocon.parse("openapi = mock\nbase-url = ${BASE}\n" + text, "queries", {"BASE": m.url} | values))
    spec = {"openapi": "3.0.0", "paths": {p: {"get": {"responses": {"200": {"content": {media: {"schema": s}}}}}} for p, s in paths.items()}}
    return Engine(spark, f"{name}_{abs(hash((spark.sparkContext.applicationId, sf_dir))) % 10**8}", source, spec).register()


def _rows(sf_dir: str, name: str) -> list[str]:
    return api(sf_dir).resources[name].rows


def _row_schema(sf_dir: str, name: str) -> dict:
    return schema_of(api(sf_dir).resources[name].schema)


def _array(item: dict) -> dict:
    return {"type": "array", "items": item}


def _body(sf_dir: str, name: str) -> str:
    return "[" + ", ".join(_rows(sf_dir, name)) + "]"


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters above a value, and up to one."""
    api(sf_dir).resources["orders"].enums |= {"over_price": "o_totalprice", "max_total": "o_totalprice"}
    page = {"type": "object", "properties": {"results": _array(_row_schema(sf_dir, "orders"))}}
    text = 'pagination { style = offset, page-size-param = limit, max-page-size = 10000, max-pages = 100000 }\ntables { orders { endpoint = "/orders", data-path = "/results", filters = [{ param = over_price, column = o_totalprice, operators = [gt] }, { param = max_total, column = o_totalprice, operators = [lte] }] } }'
    e = own(spark, sf_dir, "compared", text, {"/orders": page})
    return e.sql(f"SELECT o_orderkey, o_totalprice FROM {e.name}.orders WHERE o_totalprice > 1000 AND o_totalprice <= 250000")


def _incremental(e: Engine, name: str, key: str, run: int) -> tuple[int, int, int]:
    with e.incremental(name) as df:
        got = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(key), F.lit(0)).alias("ids")).collect()[0]
    return run, got["n"], got["ids"]


def _cursor_engine(spark: SparkSession, sf_dir: str) -> Engine:
    page = {"type": "object", "properties": {"items": _array(_row_schema(sf_dir, "customer")), "next": {"type": "string"}}}
    text = 'pagination { style = cursor, cursor-path = "/next", page-size-param = page_size, max-page-size = 400, max-pages = 100000 }\ntables { customer { endpoint = "/customer.cursor", data-path = "/items", checkpoint { enabled = true, path = ${STATE}, mode = cursor } } }'
    folder = tempfile.mkdtemp(prefix="tidewire-state-")
    return own(spark, sf_dir, f"cursor_{os.path.basename(folder)[-8:].replace('-', '_')}", text, {"/customer.cursor": page}, STATE=folder)


def _cursor_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two incremental reads by cursor: the second reads the last page again, where new rows would show."""
    e = _cursor_engine(spark, sf_dir)
    return spark.createDataFrame([_incremental(e, "customer", "c_custkey", i) for i in (1, 2)], "run int, n bigint, ids bigint")


def _failing_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block that fails after its read leaves the position where it was: the next read gives all rows again."""
    e, parts = _cursor_engine(spark, sf_dir), []
    try:
        with e.incremental("customer") as df:
            parts.append((1, df.count()))
            raise RuntimeError("the sink fails")
    except RuntimeError:
        parts.append((2, _incremental(e, "customer", "c_custkey", 2)[1]))
    return spark.createDataFrame(parts, "run int, n bigint")


def _simple(name: str, text: str, path: str, rows: str, wrapped: bool = False, **kwargs: Any) -> Query:
    """All rows of one table whose path the API serves itself."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        schema = _row_schema(sf_dir, rows) if kwargs.get("media") else _array(_row_schema(sf_dir, rows))
        return own(spark, sf_dir, name, text, {path: {"type": "object", "properties": {"results": schema}} if wrapped else schema}, **kwargs).table(rows)

    return run


def _foreign_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A next link to another origin: nothing is asked there when there are credentials to send."""
    m, asked = api(sf_dir), []
    m.routes["/leading/nation"] = lambda q, h, b: (200, {"Link": f'<{m.url.replace("127.0.0.1", "localhost")}/elsewhere>; rel="next"'}, _body(sf_dir, "nation"))
    m.routes["/elsewhere"] = lambda q, h, b: (asked.append(1), "[]")[1]
    e = own(spark, sf_dir, "leading", 'auth { type = bearer, token = hush }\npagination { style = link_header }\ntables { nation { endpoint = "/leading/nation" } }', {"/leading/nation": _array(_row_schema(sf_dir, "nation"))})
    try:
        collect_clean(e.table("nation"))
        refused = False
    except EngineError as error:
        refused = "another origin" in str(error)
    return spark.createDataFrame([(refused, len(asked))], "refused boolean, asked bigint")


def _credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bearer, basic and header credentials, each asked for by its own path."""
    m, out = api(sf_dir), None
    wanted = {"bearer": ("Authorization", "Bearer hush"), "basic": ("Authorization", "Basic " + base64.b64encode(b"me:hush").decode()), "header": ("X-Key", "hush")}
    given = {"bearer": "token = hush", "basic": "username = me, password = hush", "header": "header-name = X-Key, header-value = hush"}
    for kind, (header, value) in wanted.items():
        m.routes[f"/{kind}/nation"] = lambda q, h, b, header=header, value=value: _body(sf_dir, "nation") if h.get(header) == value else (403, {}, "{}")
        e = own(spark, sf_dir, f"with_{kind}", f'auth {{ type = {kind}, {given[kind]} }}\ntables {{ nation {{ endpoint = "/{kind}/nation" }} }}', {f"/{kind}/nation": _array(_row_schema(sf_dir, "nation"))})
        part = e.table("nation").select(F.lit(kind).alias("kind"), "n_nationkey", "n_name")
        out = part if out is None else out.unionByName(part)
    return out


def _flaky_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of lines that is refused at first."""
    m, seen = api(sf_dir), []
    m.routes["/flaky/nation"] = lambda q, h, b: (503, {"Retry-After": "0"}, "") if (seen.append(1), len(seen) % 2)[1] else (200, {"Content-Type": "application/x-ndjson"}, "\n".join(_rows(sf_dir, "nation")))
    return _simple("flaky", 'http { response-format = ndjson }\ntables { nation { endpoint = "/flaky/nation" } }', "/flaky/nation", "nation", media="application/x-ndjson")(spark, sf_dir)


def _slow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer that takes longer than the timeout at first."""
    m, seen = api(sf_dir), []

    def answer(q, h, b):
        seen.append(1)
        if len(seen) % 2:
            time.sleep(1.5)
        return _body(sf_dir, "nation")

    m.routes["/slow/nation"] = answer
    return _simple("slow", 'http { timeout = "1 seconds", max-backoff = "100 ms", max-retries = 3 }\ntables { nation { endpoint = "/slow/nation" } }', "/slow/nation", "nation")(spark, sf_dir)


def _compressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A body in gzip, for those who say that they take it."""
    api(sf_dir).routes["/gzip/customer"] = lambda q, h, b: (200, {"Content-Encoding": "gzip"}, gzip.compress(_body(sf_dir, "customer").encode(), 1)) if "gzip" in h.get("Accept-Encoding", "") else (406, {}, "{}")
    return _simple("packed", 'tables { customer { endpoint = "/gzip/customer" } }', "/gzip/customer", "customer")(spark, sf_dir)


def _error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an error tells: status, request id and the message's beginning, without the secret of the URL."""
    api(sf_dir).routes["/gone/nation"] = lambda q, h, b: (410, {"Correlation-Id": "r-77"}, {"message": "moved away"})
    e = own(spark, sf_dir, "gone", 'http { max-retries = 0 }\ntables { nation { endpoint = "/gone/nation?access_key=hush" } }', {"/gone/nation?access_key=hush": _array(_row_schema(sf_dir, "nation"))})
    try:
        collect_clean(e.table("nation"))
        said = ""
    except EngineError as error:
        said = str(error)
    return spark.createDataFrame([(what, what in said) for what in ("410", "correlation-id: r-77", "moved away", "hush", "Traceback")], "what string, said boolean")


def _redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensitive parameters and values as messages show them."""
    names = ["key", "access_key", "pass", "password", "api-key", "session_id", "auth", "page"]
    rows = [(n, redact_url(f"http://x/y?{n}=v1&size=2")) for n in names] + [("body", redact('{"pass": "v1", "private_key": "v2", "page": "3"}'))]
    return spark.createDataFrame(rows, "name string, shown string")


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested objects as columns."""
    m = api(sf_dir)
    cols = m.resources["customer"].table.select(["c_custkey", "c_nationkey", "c_mktsegment"]).to_pylist()
    m.routes["/nested/customers"] = json.dumps([{"id": r["c_custkey"], "home": {"nation": r["c_nationkey"], "market": {"segment": r["c_mktsegment"]}}} for r in cols])
    schema = {"type": "object", "properties": {"id": {"type": "integer"}, "home": {"type": "object", "properties": {"nation": {"type": "integer", "format": "int32"}, "market": {"type": "object", "properties": {"segment": {"type": "string"}}}}}}}
    e = own(spark, sf_dir, "nested", 'schema { flatten-depth = 3 }\ntables { customers { endpoint = "/nested/customers" } }', {"/nested/customers": _array(schema)})
    return e.sql(f"SELECT id AS c_custkey, home_nation AS c_nationkey, home_market_segment AS c_mktsegment FROM {e.name}.customers")


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates and booleans, and NULL for what is neither."""
    api(sf_dir).routes["/days"] = [{"id": 1, "day": "2024-02-29", "ok": True}, {"id": 2, "day": "2023-02-29", "ok": "FALSE"}, {"id": 3, "day": "soon", "ok": 1}, {"id": 4, "day": None, "ok": "no"}, {"id": 5}]
    schema = {"type": "object", "properties": {"id": {"type": "integer"}, "day": {"type": "string", "format": "date"}, "ok": {"type": "boolean"}}}
    return own(spark, sf_dir, "days", 'tables { days { endpoint = "/days" } }', {"/days": _array(schema)}).table("days")


def _pushed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count of a column and the older form of a row count, both asked of the API."""
    page = {"type": "object", "properties": {"results": _array(_row_schema(sf_dir, "orders"))}}
    text = 'tables { orders { endpoint = "/orders", data-path = "/results", count { endpoint = "/orders/stats", response-path = "/count" }, aggregations { keys { function = count, column = o_custkey, endpoint = "/orders/stats", response-path = "/count" } } } }'
    e = own(spark, sf_dir, "counts", text, {"/orders": page})
    return e.sql(f"SELECT count(*) AS n, count(o_custkey) AS n_keys FROM {e.name}.orders")


def _objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of objects as rows with the objects' columns."""
    m = api(sf_dir)
    orders = m.keyed("orders", "o_custkey")

    def answer(q, h, b):
        """Whole carts from a row on, until they hold as many orders as a page should."""
        at, carts, n = int(q.get("cursor") or 0), [], 0
        for rows in orders.cut({}, at, len(orders.rows)):
            for r in rows.select(["o_custkey", "o_orderkey", "o_totalprice"]).to_pylist():
                k = r.pop("o_custkey")
                if not carts or carts[-1]["c_custkey"] != k:
                    if n >= CART_ORDERS:
                        return {"items": carts, "next": str(at + n)}
                    carts.append({"c_custkey": k, "cart": []})
                carts[-1]["cart"].append(r)
                n += 1
        return {"items": carts, "next": ""}

    m.routes["/carts"] = answer
    item = {"type": "object", "properties": {"o_orderkey": {"type": "integer"}, "o_totalprice": {"type": "number"}}}
    schema = {"type": "object", "properties": {"c_custkey": {"type": "integer"}, "cart": _array(item)}}
    page = {"type": "object", "properties": {"items": _array(schema), "next": {"type": "string"}}}
    text = 'schema { array-handling = both }\npagination { style = cursor, cursor-path = "/next", max-pages = ${PAGES} }\ntables { carts { endpoint = "/carts", data-path = "/items" } }'
    e = own(spark, sf_dir, "carts", text, {"/carts": page}, PAGES=str(1 + len(orders.rows)))
    return e.sql(f"SELECT c_custkey, cart_o_orderkey AS o_orderkey, cart_o_totalprice AS o_totalprice FROM {e.name}.carts_cart")


def _arrays_engine(spark: SparkSession, sf_dir: str, mode: str) -> Engine:
    row = _row_schema(sf_dir, "customer")
    row["properties"]["orders_keys"] = _array({"type": "integer", "format": "int64"})
    text = f'schema {{ mode = {mode}, array-handling = both }}\npagination {{ style = offset, page-size-param = limit, max-page-size = 10000, max-pages = 100000 }}\ntables {{ customer_orders {{ endpoint = "/customer_orders", data-path = "/results" }} }}'
    return own(spark, sf_dir, f"arrays_{mode}", text, {"/customer_orders": {"type": "object", "properties": {"results": _array(row)}}})


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables that are listed, exploded ones among them, with their columns."""
    e = _arrays_engine(spark, sf_dir, "strict")
    return spark.createDataFrame([(t, ",".join(f"{c}:{k}" for c, k in sorted(e.describe(t)))) for t in e.tables()], "name string, columns string")


def _strict_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exploded table is typed where its parent is a variant."""
    e = _arrays_engine(spark, sf_dir, "variant")
    return e.sql(f"SELECT c_custkey, orders_keys AS o_orderkey FROM {e.name}.customer_orders_orders_keys")


def _encoded_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent keys with characters that a path must encode."""
    m = api(sf_dir)
    for r in m.resources["supplier"].table.select(["s_name", "s_acctbal"]).to_pylist():
        m.routes[f"/named/{urllib.parse.quote(r['s_name'], safe='')}/balance"] = [{"s_acctbal": r["s_acctbal"]}]
    text = 'tables { supplier { endpoint = "/supplier.all" }, balance { endpoint = "/named/{s_name}/balance", parent-table = supplier, parent-key = s_name } }'
    e = own(spark, sf_dir, "named", text, {"/supplier.all": _array(_row_schema(sf_dir, "supplier")), "/named/{s_name}/balance": _array({"type": "object", "properties": {"s_acctbal": {"type": "number"}}})})
    return e.table("balance", parallelism=4).select(F.col("_parent_s_name").alias("s_name"), "s_acctbal")


def _repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parent's key that repeats in a batch gives each child row once."""
    api(sf_dir).children["nation"] = ("supplier", "n_nationkey")
    text = 'tables { supplier { endpoint = "/supplier.all" }, homes { endpoint = "/nation_by", parent-table = supplier, parent-key = s_nationkey, join-strategy = batch, batch-param = ids, batch-size = 100000, child-key-field = n_nationkey } }'
    e = own(spark, sf_dir, "homes", text, {"/supplier.all": _array(_row_schema(sf_dir, "supplier")), "/nation_by": _array(_row_schema(sf_dir, "nation"))})
    return e.table("homes").select("n_nationkey", "n_name")


def _relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A description in a file beside the configuration."""
    m = api(sf_dir)
    folder = tempfile.mkdtemp(prefix="tidewire-config-")
    with open(os.path.join(folder, "api.json"), "w", encoding="utf-8") as f:
        json.dump(describe(m), f)
    with open(os.path.join(folder, "shop.conf"), "w", encoding="utf-8") as f:
        f.write(f'openapi = "api.json"\nbase-url = "{m.url}"\ncache {{ enabled = false }}\ntables {{ region {{ endpoint = "/region.all" }} }}\n')
    prepare(spark)
    spark.dataSource.register(RestSource)
    return spark.read.format("tidewire").option("config", os.path.join(folder, "shop.conf")).option("table", "region").load().select("r_regionkey", "r_name")


_BAD_CONFIGS = {
    "tables.t.partition": 'tables { t { endpoint = "/t", partition { type = offset, size = 5 } } }',
    "pagination.cursor-path": "pagination { style = cursor }",
    "http.timeout": 'http { timeout = "soon" }',
    "tables.t.filters[0].operators": 'tables { t { endpoint = "/t", filters = [{ param = a, column = b, operators = [like] }] } }',
    "auth.token": "auth { type = bearer }",
}


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configurations that are refused, by the path that the message names."""
    out = []
    for path, text in _BAD_CONFIGS.items():
        try:
            configs.of(hocon.parse("openapi = x\n" + text, env={}))
            out.append((path, False))
        except ConfigError as error:
            out.append((path, str(error).startswith(path)))
    return spark.createDataFrame(out, "path string, named boolean")


def _count_limited(name: str, limit: int, **kwargs: Any) -> Query:
    return lambda s, d: engine(s, d, **kwargs).table(name, limit=limit).agg(F.count("*").alias("n"))


def _values(columns: str, *rows: str) -> str:
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS t({columns})"


_NATION = "SELECT n_nationkey, n_name, n_regionkey FROM nation"
_EXPLODED = "SELECT c_custkey, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_custkey % 3 <> 0"
_COLUMNS = "c_acctbal:double,c_custkey:bigint,c_mktsegment:string,c_name:string,c_nationkey:int"

#: Name: (the query, its SQL on the tables).
QUERIES: dict[str, tuple[Query, str]] = {
    "f1_filter_gt_lte": (_compared, "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1000 AND o_totalprice <= 250000"),
    "p3_checkpoint_cursor": (_cursor_checkpoint, "SELECT CAST(1 AS INTEGER) AS run, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS ids FROM customer UNION ALL SELECT 2, count(*), CAST(sum(c_custkey) AS BIGINT) FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS i, count(*) OVER () AS n FROM customer) WHERE i >= ((n - 1) // 400) * 400"),
    "c4_failing_block": (_failing_block, "SELECT CAST(1 AS INTEGER) AS run, count(*) AS n FROM customer UNION ALL SELECT 2, count(*) FROM customer"),
    "p7_default_results_path": (_simple("defaults", 'pagination { style = offset, page-size-param = limit, max-page-size = 4 }\ntables { nation { endpoint = "/nation", data-path = "/results" } }', "/nation", "nation", wrapped=True), _NATION),
    "p9_foreign_link": (_foreign_link, "SELECT true AS refused, CAST(0 AS BIGINT) AS asked"),
    "p10_max_pages": (lambda s, d: _simple("cut_short", 'pagination { style = offset, page-size-param = limit, max-page-size = 4, max-pages = 3 }\ntables { nation { endpoint = "/nation", data-path = "/results" } }', "/nation", "nation", wrapped=True)(s, d).agg(F.count("*").alias("n")), "SELECT count(*) AS n FROM (SELECT 1 FROM nation LIMIT 12)"),
    "h1_credentials": (_credentials, "SELECT kind, n_nationkey, n_name FROM nation, (VALUES ('bearer'), ('basic'), ('header')) AS t(kind)"),
    "h6_stream_retry": (_flaky_lines, _NATION),
    "h7_rate_limit": (_simple("paced", 'http { rate-limit = 20 }\npagination { style = offset, page-size-param = limit, max-page-size = 5 }\ntables { nation { endpoint = "/nation", data-path = "/results" } }', "/nation", "nation", wrapped=True), _NATION),
    "h8_timeout": (_slow, _NATION),
    "h9_compression": (_compressed, "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"),
    "h10_error_message": (_error, _values("what, said", "('410', true)", "('correlation-id: r-77', true)", "('moved away', true)", "('hush', false)", "('Traceback', false)")),
    "h11_redaction": (_redacted, _values("name, shown", *[f"('{n}', 'http://x/y?{n}={'v1' if n == 'page' else '[REDACTED]'}&size=2')" for n in ("key", "access_key", "pass", "password", "api-key", "session_id", "auth", "page")], """('body', '{"pass": [SCRUBBED], "private_key": [SCRUBBED], "page": "3"}')""")),
    "v2_nested_columns": (_nested, "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer"),
    "v7_dates_and_booleans": (_dates, "SELECT CAST(id AS BIGINT) AS id, CAST(day AS DATE) AS day, ok FROM (VALUES (1, '2024-02-29', true), (2, NULL, false), (3, NULL, NULL), (4, NULL, NULL), (5, NULL, NULL)) AS t(id, day, ok)"),
    "a2_count_column": (_pushed_counts, "SELECT count(*) AS n, count(o_custkey) AS n_keys FROM orders"),
    "r6p_rate_shares": (_simple("shared_rate", 'http { rate-limit = 40 }\npagination { style = offset, page-size-param = limit, max-page-size = 4, results-path = "/results" }\ntables { nation { endpoint = "/nation", data-path = "/results", partition { type = offset, size = 7, count = 4 } } }', "/nation", "nation", wrapped=True), _NATION),
    "e3_explode_objects": (_objects, "SELECT o_custkey AS c_custkey, o_orderkey, o_totalprice FROM orders"),
    "e4_exploded_listing": (_listed, _values("name, columns", f"('customer_orders', '{_COLUMNS},orders_keys:string')", f"('customer_orders_orders_keys', '{_COLUMNS},orders_keys:bigint')")),
    "e6_strict_in_variant": (_strict_arrays, _EXPLODED),
    "j2_encoded_keys": (_encoded_keys, "SELECT s_name, s_acctbal FROM supplier"),
    "j7_repeated_keys": (_repeated_keys, "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)"),
    "s8_stream_limit": (_count_limited("part", 10, fmt="ndjson"), "SELECT count(*) AS n FROM (SELECT 1 FROM part LIMIT 10)"),
    "l3_limit_partitioned": (_count_limited("lineitem", 100), "SELECT count(*) AS n FROM (SELECT 1 FROM lineitem LIMIT 100)"),
    "l4_limit_exploded": (_sql("SELECT count(*) AS n FROM (SELECT orders_keys FROM api.customer_orders_orders_keys LIMIT 10)"), f"SELECT count(*) AS n FROM ({_EXPLODED} LIMIT 10)"),
    "s12_relative_description": (_relative, "SELECT r_regionkey, r_name FROM region"),
    "s13_rejected_configs": (_rejected, _values("path, named", *[f"('{p}', true)" for p in _BAD_CONFIGS])),
}
