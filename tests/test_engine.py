import datetime as dt
import itertools
import os

import pytest
from pyspark.sql import functions as F

from tidewire import Engine, EngineError
from tidewire.errors import ConfigError, NoSuchTable, collect_clean, count_clean
from tidewire.plans import rewrites
from tidewire.sources import config, hocon

_NAMES = itertools.count()


def get(schema, media="application/json"):
    return {"get": {"responses": {"200": {"content": {media: {"schema": schema}}}}}}


def obj(**props):
    return {"type": "object", "properties": props}


def arr(items):
    return {"type": "array", "items": items}


INT, TEXT, NUM, TIME = {"type": "integer"}, {"type": "string"}, {"type": "number"}, {"type": "string", "format": "date-time"}


def engine(spark, api, paths, text=""):
    source = config.of(hocon.parse("openapi = x\n" + text, env={}) | {"base-url": api.url})
    return Engine(spark, f"t{next(_NAMES)}", source, {"openapi": "3.0.0", "paths": paths}).register()


def sql(e, text):
    return e.sql(text.replace("api.", f"{e.name}."))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


ITEMS = obj(results=arr(obj(id=INT, kind=TEXT, size=NUM, at=TIME)))
PAGING = 'pagination { style = offset, page-size-param = limit, max-page-size = 100, results-path = "/results" }\n'


def items(n):
    every = [{"id": i, "kind": str(1 + i % 2), "size": i / 2, "at": f"2024-01-{1 + i % 28:02d}T00:00:00Z"} for i in range(n)]

    def answer(q, h, b):
        found = [r for r in every if ("kind" not in q or r["kind"] == q["kind"]) and ("min" not in q or r["id"] >= int(q["min"])) and ("ne" not in q or r["id"] != int(q["ne"])) and ("since" not in q or r["at"] >= q["since"]) and ("until" not in q or r["at"] < q["until"])]
        lo = int(q.get("offset", 0))
        return {"results": found[lo : lo + int(q.get("limit", 100))], "count": len(found), "sum": sum(r["size"] for r in found)}

    return answer


FILTERS = 'filters = [{ param = kind, column = kind, operators = [eq] }, { param = min, column = id, operators = [gte, gt] }, { param = ne, column = id, operators = [neq] }, { param = limit, column = size, operators = [eq] }]'


@pytest.fixture()
def shop(spark, api):
    api.routes["/items"] = items(300)
    e = engine(spark, api, {"/items": get(ITEMS)}, PAGING + 'tables { items { endpoint = "/items", data-path = "/results", %s, aggregations { n { function = count, response-path = "/count" }, s { function = sum, column = size, response-path = "/sum" }, m { function = max, column = size, response-path = "/sum" } } } }' % FILTERS)
    api.clear()
    yield e, api
    e.unregister()


def test_names(shop, spark):
    e, _ = shop
    assert e.tables() == ["items"] and e.exists("items") and not e.exists("nope")
    assert e.describe("items") == [("at", "timestamp"), ("id", "bigint"), ("kind", "string"), ("size", "double")]
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {e.name}").collect()] == ["items"]
    with pytest.raises(NoSuchTable, match="items"):
        e.table("nope")
    assert e.sql(f"SELECT count(id) AS c FROM {e.name}.default.items WHERE kind = 'api.default.x' -- {e.name}.default.items").collect()[0].c == 0


def test_filters_become_parameters(shop):
    e, api = shop
    assert rows(sql(e, "SELECT id FROM api.items WHERE kind = '2' AND id >= 290 AND id <> 295")) == [(291,), (293,), (297,), (299,)]
    assert {"kind=2", "min=290", "ne=295"} <= set(api.log[0].partition("?")[2].split("&"))
    api.clear()
    assert rows(sql(e, "SELECT id FROM api.items WHERE size = 2.0")) == [(4,)]
    assert all("limit=100" in x for x in api.log)
    api.clear()
    assert sql(e, "SELECT id FROM api.items WHERE kind IN ('1', '2') AND (id < 3 OR kind LIKE '9%') AND at IS NOT NULL").count() == 3
    assert not any("kind=" in x or "min=" in x for x in api.log)


def test_one_value_for_a_parameter(shop):
    e, api = shop
    assert rows(sql(e, "SELECT id FROM api.items WHERE id >= 5 AND id >= 297 AND kind = '2'")) == [(297,), (299,)]
    assert sum(x.count("min=") for x in api.log[:1]) == 1


def test_pushed_filters_are_trusted_unless_verified(shop):
    e, api = shop
    api.routes["/items"] = {"results": [{"id": 1, "kind": "other"}]}
    df = lambda **kw: e.table("items", **kw).filter("kind = '1'").filter("id < 10")
    api.routes["/items"] = lambda q, h, b: {"results": [{"id": 1, "kind": "other"}] if q["offset"] == "0" else []}
    assert df().count() == 1 and df(verify=True).count() == 0


def test_columns_and_limits_reach_the_reader(shop, spark):
    e, api = shop
    out = sql(e, "SELECT id FROM api.items LIMIT 7")
    assert len(out.collect()) == 7 and api.log[-1].endswith("limit=7")
    options = rewrites.read_options(spark.sql(f"SELECT kind, count(*) FROM {e.name}.items WHERE id > 3 GROUP BY kind")._jdf.queryExecution().optimizedPlan(), e.name)
    assert set(__import__("json").loads(options["items"]["_columns"])) == {"id", "kind"} and "_limit" not in options["items"]
    assert e.table("items", columns=["id"], limit=3).collect()[0].asDict().keys() == {"id"}
    assert rewrites.with_options("SELECT * FROM a.t x, a.t y", "a", "t", {"k": "v"}) is None
    assert rewrites.with_options("SELECT 'a.t' FROM a.t WHERE x", "a", "t", {"k": "it's"}) == "SELECT 'a.t' FROM a.t WITH ('k' = 'it\\'s') WHERE x"


def test_aggregates_reach_the_api(shop):
    e, api = shop
    assert rows(sql(e, "SELECT count(*) AS n, sum(size) AS s FROM api.items WHERE kind = '1'")) == [(150, 11175.0)]
    assert len(api.log) == 1 and "kind=1" in api.log[0] and "offset" not in api.log[0]
    for text in ("SELECT count(DISTINCT id) FROM api.items", "SELECT max(size) FROM api.items", "SELECT kind, count(*) FROM api.items GROUP BY kind", "SELECT count(*) FROM api.items WHERE size = 2.0", "SELECT count(*), max(size) FROM api.items", "SELECT count(id) FROM api.items"):
        api.clear()
        assert sql(e, text).collect()
        assert any("offset" in x for x in api.log), text
    assert rows(e.aggregate("items", n=("count", None))) == [(300,)]
    with pytest.raises(EngineError, match=r"count\(\*\), sum\(size\)"):
        e.aggregate("items", x=("avg", "size"))


@pytest.mark.parametrize(("value", "want"), [(42.0, 42), (None, None), ("42", "number"), (4.5, "whole"), ("absent", "nothing at")])
def test_aggregate_values(shop, value, want):
    e, api = shop
    api.routes["/items"] = {} if value == "absent" else {"count": value}
    if isinstance(want, str):
        with pytest.raises(EngineError, match=want):
            collect_clean(e.aggregate("items", n=("count", None)))
    else:
        assert rows(e.aggregate("items", n=("count", None))) == [(want,)]


def parts(spark, api, table, where="", text=""):
    api.routes["/items"] = items(400)
    e = engine(spark, api, {"/items": get(ITEMS)}, PAGING + text + 'tables { items { endpoint = "/items", data-path = "/results", filters = [{ param = kind, column = kind, operators = [eq] }, { param = since, column = at, operators = [gte] }, { param = until, column = at, operators = [lt] }], %s } }' % table)
    api.clear()
    df = sql(e, f"SELECT id, at FROM api.items {where}")
    return df, sorted(r.id for r in df.collect())


def test_offset_partitions(spark, api):
    df, got = parts(spark, api, "partition { type = offset, size = 90, count = 4 }")
    assert got == list(range(360)) and df.rdd.getNumPartitions() == 4


def test_enum_partitions(spark, api):
    df, got = parts(spark, api, "partition { type = enum, param = kind, values = [1, 2] }")
    assert got == list(range(400)) and df.rdd.getNumPartitions() == 2
    df, got = parts(spark, api, "partition { type = enum, param = kind, values = [1, 2] }", "WHERE kind = '2'")
    assert got == list(range(1, 400, 2)) and df.rdd.getNumPartitions() == 1


DATES = 'partition { type = date-range, column = at, start-param = since, end-param = until, range = "7 days" }'


def test_date_partitions(spark, api):
    df, got = parts(spark, api, DATES, "WHERE at >= TIMESTAMP '2024-01-03 00:00:00' AND at < TIMESTAMP '2024-01-20 00:00:00'")
    assert got == [i for i in range(400) if 3 <= 1 + i % 28 < 20] and df.rdd.getNumPartitions() == 3
    spans = {tuple(p.split("=")[1] for p in x.partition("?")[2].split("&") if p.startswith(("since", "until"))) for x in api.log}
    assert spans == {("2024-01-03T00%3A00%3A00Z", "2024-01-10T00%3A00%3A00Z"), ("2024-01-10T00%3A00%3A00Z", "2024-01-17T00%3A00%3A00Z"), ("2024-01-17T00%3A00%3A00Z", "2024-01-20T00%3A00%3A00Z")}
    df, got = parts(spark, api, DATES, "WHERE at >= TIMESTAMP '2024-01-05 00:00:00' AND at < TIMESTAMP '2024-01-05 00:00:00'")
    assert got == [] and api.log == []
    df, got = parts(spark, api, DATES)
    assert len(got) == 400 and df.rdd.getNumPartitions() == 1


def test_rate_shares(spark, api):
    from tidewire.sources.datasource import shares

    assert shares(10, 3) == [4, 3, 3] and shares(None, 2) == [None, None]
    with pytest.raises(Exception, match="less than"):
        parts(spark, api, "partition { type = offset, size = 90, count = 4 }", text="http { rate-limit = 2 }\n")[0]


RECORD = obj(id=INT, name=TEXT, tags=arr(TEXT), scores=arr(INT), addresses=arr(obj(city=TEXT, zip=INT)))


@pytest.mark.parametrize("outer", [False, True])
def test_explode(spark, api, outer):
    people = [{"id": 1, "name": "a", "tags": ["x", "y"], "scores": [1, "2", "z"], "addresses": [{"city": "p", "zip": "7"}, {"zip": 8}]}, {"id": 2, "name": "b", "tags": [], "addresses": None}, {"id": 3, "name": "c"}]
    api.routes["/people"] = lambda q, h, b: [p for p in people if "id" not in q or str(p["id"]) == q["id"]]
    e = engine(spark, api, {"/people": get(arr(RECORD))}, f'schema {{ array-handling = both, explode-outer = {str(outer).lower()} }}\ntables {{ people {{ endpoint = "/people", filters = [{{ param = id, column = id, operators = [eq] }}] }} }}')
    assert e.tables() == ["people", "people_addresses", "people_scores", "people_tags"]
    nothing = [(2, None), (3, None)] if outer else []
    assert rows(sql(e, "SELECT id, coalesce(tags, '-') FROM api.people_tags")) == [(1, "x"), (1, "y")] + [(i, "-") for i, _ in nothing]
    assert rows(sql(e, "SELECT id, coalesce(scores, -1) FROM api.people_scores")) == [(1, -1), (1, 1), (1, 2)] + [(i, -1) for i, _ in nothing]
    assert rows(e.table("people_addresses").select("id", F.coalesce("addresses_city", F.lit("-")), F.coalesce("addresses_zip", F.lit(0))).filter("id = 1")) == [(1, "-", 8), (1, "p", 7)]
    api.clear()
    assert sql(e, "SELECT tags FROM api.people_tags WHERE id = 1").count() == 2
    assert api.log == ["/people?id=1"]
    assert sql(e, "SELECT tags FROM api.people_tags LIMIT 1").collect()[0].tags == "x"


def test_variant(spark, api):
    api.routes["/v"] = {"rows": [{"a": {"b": [1, 2.50]}}, None, 3]}
    e = engine(spark, api, {}, 'schema { mode = variant }\ntables { v { endpoint = "/v", data-path = "/rows" } }')
    assert e.describe("v") == [("value", "variant")]
    got = sql(e, "SELECT variant_get(value, '$.a.b[1]', 'double') AS x, value IS NULL AS n FROM api.v").collect()
    assert sorted((r.x or 0.0, r.n) for r in got) == [(0.0, False), (0.0, True), (2.5, False)]


def test_exploded_tables_are_strict(spark, api):
    api.routes["/people"] = [{"id": 1, "tags": ["x", "y"]}]
    e = engine(spark, api, {"/people": get(arr(RECORD))}, "schema { mode = variant, array-handling = both }")
    assert e.describe("people") == [("value", "variant")] and ("tags", "string") in e.describe("people_tags")
    assert rows(sql(e, "SELECT id, tags FROM api.people_tags")) == rows(e.table("people_tags", columns=["id", "tags"])) == [(1, "x"), (1, "y")]


def test_raw_json_keeps_its_numbers(spark, api):
    api.routes["/r"] = '[{"id": 1.0, "t": "x", "o": [1e2, 2.50]}, {"t": 1e2}, {"id": 1e309}]'
    schema = arr(obj(id=NUM, t=TEXT, o=arr(NUM)))
    e = engine(spark, api, {"/r": get(schema)})
    assert rows(sql(e, "SELECT coalesce(id, 0), coalesce(t, '-'), coalesce(o, '-') FROM api.r")) == [(0.0, "-", "-"), (0.0, "1e2", "-"), (1.0, "x", "[1e2,2.50]")]
    assert rows(sql(e, "SELECT coalesce(id, 0) FROM api.r")) == [(0.0,), (0.0,), (1.0,)]


def test_nulls_of_required_fields(spark, api):
    api.routes["/u"] = [{"id": 1, "nick": "a", "profile": {"name": "Ada"}}, {"id": 2, "nick": None}, {"id": 3}]
    schema = arr(obj(id=INT, nick=TEXT, profile=obj(name=TEXT)) | {"required": ["id", "nick", "profile"]})
    e = engine(spark, api, {"/u": get(schema)})
    assert rows(sql(e, "SELECT id FROM api.u WHERE profile_name IS NULL")) == [(2,), (3,)]
    assert rows(sql(e, "SELECT id FROM api.u WHERE nick IS NULL")) == [(2,), (3,)]


CUSTOMERS = [{"id": 1, "name": "ada"}, {"id": 2, "name": "bob"}, {"id": 3, "name": "cy"}, {"name": "no key"}, {"id": 3, "name": "again"}]
ORDERS = {1: [10, 11], 2: [20], 3: [30]}


@pytest.mark.parametrize("parallelism", [1, 3])
def test_joins(spark, api, parallelism):
    api.routes["/customers"] = CUSTOMERS
    for k, v in ORDERS.items():
        api.routes[f"/customers/{k}/orders"] = [{"order_id": o} for o in v]
    api.routes["/orders"] = lambda q, h, b: [{"order_id": o, "customer_id": k} for k, v in ORDERS.items() for o in v if str(k) in q["customer_ids"].split(",") or k == 1]
    order = arr(obj(order_id=INT))
    e = engine(spark, api, {"/customers": get(arr(obj(id=INT, name=TEXT))), "/customers/{x}/orders": get(order), "/orders": get(order)}, """
        tables {
          customers { endpoint = "/customers" }
          each { endpoint = "/customers/{customer_id}/orders", parent-table = customers, parent-key = id }
          batch { endpoint = "/orders", parent-table = customers, parent-key = id, join-strategy = batch, batch-param = customer_ids, batch-size = 2, child-key-field = customer_id }
        }""")
    assert e.describe("each")[0] == ("_parent_customer_id", "string") and e.describe("batch")[0] == ("_parent_id", "string")
    api.clear()
    assert rows(e.table("each", parallelism=parallelism)) == [("1", 10), ("1", 11), ("2", 20), ("3", 30), ("3", 30)]
    api.clear()
    assert rows(e.table("batch", parallelism=parallelism)) == [("1", 10), ("1", 11), ("2", 20), ("3", 30)]
    assert len(api.requests("/orders")) == 2


def test_odd_parent_keys(spark, api):
    keys = ["x#y", "p?admin=1", "a b", "a/b", "..", "plain"]
    api.routes["/users"] = [{"login": k} for k in keys]
    for k in ("/users/x%23y/r", "/users/p%3Fadmin%3D1/r", "/users/a%20b/r", "/users/a%2Fb/r", "/users/%2E%2E/r", "/users/plain/r"):
        api.routes[k] = [{"repo": k}]
    e = engine(spark, api, {"/users": get(arr(obj(login=TEXT))), "/users/{l}/r": get(arr(obj(repo=TEXT)))}, 'tables { users { endpoint = "/users" }, r { endpoint = "/users/{login}/r", parent-table = users, parent-key = login } }')
    assert len(rows(e.table("r"))) == 6 and "/users/%2E%2E/r" in api.log


EVENTS = obj(next=TEXT, items=arr(obj(id=INT, at=TIME)))


def cursor_events(q, h, b):
    return {"next": "c2", "items": [{"id": 1}]} if not q.get("cursor") else {"next": "", "items": [{"id": 2}]}


def test_cursor_checkpoint(spark, api, tmp_path):
    api.routes["/e"] = cursor_events
    e = engine(spark, api, {"/e": get(EVENTS)}, 'http { max-retries = 0 }\npagination { style = cursor, cursor-path = "/next" }\ntables { e { endpoint = "/e", data-path = "/items", checkpoint { enabled = true, path = "%s", mode = cursor } } }' % tmp_path)
    state = tmp_path / "e.checkpoint.json"
    with pytest.raises(RuntimeError), e.incremental("e") as df:
        df.count()
        raise RuntimeError("the sink fails")
    assert os.listdir(tmp_path) == []
    with e.incremental("e") as df:
        assert [r.id for r in df.collect()] == [1, 2]
    assert state.read_text() == '{"type": "cursor", "value": "c2"}'
    with e.incremental("e") as df:
        assert [r.id for r in df.collect()] == [2]
    state.write_text("rubbish")
    with e.incremental("e") as df:
        assert df.count() == 2
    with e.incremental("e") as df:  # a limit stops the read early: nothing was read to its end
        pass
    api.routes["/e"] = lambda q, h, b: (500, {}, "") if q.get("cursor") else cursor_events(q, h, b)
    state.unlink()
    with pytest.raises(EngineError), e.incremental("e") as df:
        collect_clean(df)
    assert not state.exists()


def test_timestamp_checkpoint(spark, api, tmp_path):
    every = [{"id": 1, "at": "2024-01-02T00:00:00Z"}, {"id": 2, "at": "2024-01-03T01:00:00+02:00"}, {"id": 3}]
    api.routes["/e"] = lambda q, h, b: [r for r in every if r.get("at", "9") >= q.get("since", "")]
    e = engine(spark, api, {"/e": get(arr(obj(id=INT, at=TIME)))}, 'tables { e { endpoint = "/e", filters = [{ param = since, column = at, operators = [gte] }], checkpoint { enabled = true, path = "%s", mode = timestamp, timestamp-path = "/at", timestamp-param = since } } }' % tmp_path)
    for want in (3, 2):
        with e.incremental("e") as df:
            assert df.filter(F.col("at").isNull() | (F.col("at") >= F.lit(dt.datetime(2000, 1, 1)))).count() == want
    assert "2024-01-03T01:00:00+02:00" in (tmp_path / "e.checkpoint.json").read_text()


def test_stream(spark, api, tmp_path):
    every = [{"id": i, "at": f"2024-01-01T00:00:{i:02d}Z"} for i in range(20)] + [{"id": 99}]
    api.routes["/e"] = lambda q, h, b: [r for r in every if r.get("at", "9") >= q["since"]]
    e = engine(spark, api, {"/e": get(arr(obj(id=INT, at=TIME))), "/plain": get(arr(obj(id=INT)))}, 'tables { e { endpoint = "/e", checkpoint { mode = timestamp, timestamp-path = "/at", timestamp-param = since } }, plain { endpoint = "/plain" } }')
    with pytest.raises(EngineError, match="timestamp-param"):
        e.read_stream("plain")
    clock = tmp_path / "now"
    df = e.read_stream("e", {"_now": str(clock), "_start": "2024-01-01T00:00:03Z"})
    for now in ("03", "07", "07", "12"):
        clock.write_text(f"2024-01-01T00:00:{now}Z")
        df.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [4, 5, 6, 7, 8, 9, 10, 11, 12, 99, 99]
    assert {x for x in api.log if x.startswith("/e")} == {"/e?since=2024-01-01T00%3A00%3A03Z", "/e?since=2024-01-01T00%3A00%3A07Z"}


def test_conversions(spark, api):
    api.routes["/m"] = [{"id": "42", "ok": True}, {"id": "x", "ok": "maybe"}]
    e = engine(spark, api, {"/m": get(arr(obj(id=INT, ok={"type": "boolean"})))})
    with e.conversions("m") as (df, counts):
        assert df.count() == 2
    assert counts == {"converted": 1, "nulled": 2}


def test_source_by_name(spark, api, tmp_path):
    from tidewire.session import prepare
    from tidewire.sources.datasource import RestSource

    prepare(spark)
    spark.dataSource.register(RestSource)
    api.routes["/r"] = [{"id": 1}, {"id": 2}]
    api.routes["/spec"] = {"openapi": "3.0.0", "paths": {"/r": get(arr(obj(id=INT)))}}
    path = tmp_path / "c.conf"
    path.write_text(f'openapi = "{api.url}/spec", base-url = "{api.url}", cache {{ enabled = false }}')
    assert spark.read.format("tidewire").option("config", str(path)).option("table", "r").load().count() == 2
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW by_name USING tidewire OPTIONS (config '{path}', table 'r')")
    assert spark.sql("SELECT id FROM by_name WHERE id > 1").count() == 1
    for options, what in (({}, "config is missing"), ({"config": str(path)}, "there are: r"), ({"config": str(path), "table": "x"}, "no table x"), ({"config": "/none.conf", "table": "r"}, "can't be read")):
        with pytest.raises(EngineError, match=what):
            count_clean(_load(spark, options))
    with pytest.raises(EngineError, match="schema can't be given"):
        count_clean(spark.read.format("tidewire").options(config=str(path), table="r").schema("k int").load())


def _load(spark, options):
    from tidewire.errors import clean_errors

    with clean_errors():
        return spark.read.format("tidewire").options(**options).load()


def test_read_only(shop, spark):
    e, _ = shop
    with pytest.raises(Exception, match=r"(?i)write|append|support|implement"):
        spark.sql(f"INSERT INTO {e.name}.items SELECT * FROM {e.name}.items")


def test_bad_database_name(spark, api):
    with pytest.raises(EngineError, match="database"):
        Engine(spark, "a b", config.of({"openapi": "x"}), {"openapi": "3.0.0", "paths": {}})
    assert issubclass(ConfigError, EngineError)
