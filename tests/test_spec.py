import json
import os

import pytest

from tidewire.errors import NoSuchTable, SpecError
from tidewire.sources import config, spec
from tidewire.sources.tables import Catalog


def get(schema, media="application/json", **more):
    return {"get": {"responses": {"200": {"content": {media: {"schema": schema} if schema else {}}}}, **more}}


ROW = {"type": "object", "properties": {"id": {"type": "integer"}, "name": {"type": "string"}, "tags": {"type": "array", "items": {"type": "string"}}, "addresses": {"type": "array", "items": {"type": "object", "properties": {"city": {"type": "string"}, "zip": {"type": "string"}}}}}}
LIST = {"type": "array", "items": ROW}


def doc(paths, **more):
    return {"openapi": "3.0.3", "paths": paths, **more}


def catalog(paths, text="", **more):
    from tidewire.sources import hocon

    return Catalog(config.of(hocon.parse('openapi = x\n' + text, env={})), spec.parse(doc(paths, **more)))


def test_references_and_cycles():
    d = doc({"/n": get({"$ref": "#/components/schemas/N"})}, components={"schemas": {"N": {"type": "object", "properties": {"next": {"$ref": "#/components/schemas/N"}, "id": {"type": "integer"}}}}}, servers=[{"url": "https://h/v1/"}])
    got = spec.parse(d)
    assert got.base_url == "https://h/v1" and dict(got.endpoints[0].body.properties)["next"].kind == "variant"
    with pytest.raises(SpecError, match="leads nowhere"):
        spec.parse(doc({"/n": get({"$ref": "#/components/schemas/X"})}))


def test_swagger():
    got = spec.parse({"swagger": "2.0", "host": "h", "basePath": "/v2", "schemes": ["http"], "produces": ["application/json"], "definitions": {"R": ROW}, "paths": {"/r": {"get": {"operationId": "listR", "responses": {"200": {"schema": {"type": "array", "items": {"$ref": "#/definitions/R"}}}}}}}})
    assert got.base_url == "http://h/v2" and got.endpoints[0].is_array and got.endpoints[0].body.kind == "object"


@pytest.mark.parametrize("media", ["application/json; charset=utf-8", "application/vnd.api+json", "*/*"])
def test_media_types(media):
    assert spec.parse(doc({"/r": get(ROW, media)})).endpoints[0].body is not None


def test_not_a_spec():
    for bad in ({}, {"paths": {}}, [], {"openapi": "4.0", "paths": {}}):
        with pytest.raises(SpecError):
            spec.parse(bad)
    with pytest.raises(SpecError):
        spec.parse_text("{unclosed: [")


def test_resolution_order():
    paths = {"/users/{id}": get(ROW, operationId="one"), "/users": get(LIST, operationId="people"), "/a/things": get(LIST)}
    c = catalog(paths, 'tables { a { endpoint = "/users" }, b { endpoint = "/users/{login}" }, people {}, Things {}, c { endpoint = "/users/5" } }')
    assert [c.endpoint(c.source.tables[t]).path for t in ("a", "b", "people", "Things", "c")] == ["/users", "/users/{id}", "/users", "/a/things", "/users/{id}"]
    assert c.base("c").path == "/users/5"


def test_discovery_and_listing():
    paths = {"/users": get(LIST, operationId="listUsers"), "/users/{id}": get(ROW), "/raw": get(None), "/text": get({"type": "string"}), "/things": get(LIST)}
    assert catalog(paths).names() == ["listUsers", "things"]
    assert catalog(paths, "schema { array-handling = both }").names() == ["listUsers", "listUsers_addresses", "listUsers_tags", "things", "things_addresses", "things_tags"]
    assert catalog(paths, "schema { array-handling = explode_view }").names() == ["listUsers_addresses", "listUsers_tags", "things_addresses", "things_tags"]
    with pytest.raises(NoSuchTable, match="listUsers, things"):
        catalog(paths).table("nope")


def test_exploded_names():
    c = catalog({"/a_b": get(LIST)}, 'tables { a_b { endpoint = "/a_b" } }')
    assert [x.name for x in c.table("a_b_addresses").columns] == ["id", "name", "tags", "addresses_city", "addresses_zip"]
    assert [x.name for x in c.table("a_b_tags").columns] == ["addresses", "id", "name", "tags"]


def test_strict_refuses_what_has_no_schema():
    c = catalog({"/report": get({"type": "string"}, "text/csv")}, 'tables { report { endpoint = "/report" }, ghost { endpoint = "/ghost" } }')
    with pytest.raises(SpecError, match="text/csv"):
        c.base("report")
    with pytest.raises(SpecError, match="isn't in the API description"):
        c.base("ghost")
    v = catalog({}, 'schema { mode = variant }\ntables { ghost { endpoint = "/ghost" } }')
    assert v.base("ghost").variant


def test_data_path(caplog):
    body = {"type": "object", "properties": {"data": {"type": "object", "properties": {"rows": LIST}}, "n": {"type": "integer"}}}
    c = catalog({"/x": get(body)}, 'tables { a { endpoint = "/x", data-path = "/data/rows" }, b { endpoint = "/x", data-path = "/nowhere" } }')
    assert [x.name for x in c.base("a").columns] == ["addresses", "id", "name", "tags"]
    assert [x.name for x in c.base("b").columns] == ["data_rows", "n"] and "nowhere" in caplog.text


def test_child_columns():
    c = catalog({"/p": get(LIST), "/p/{id}/c": get(LIST)}, 'tables { p { endpoint = "/p" }, c { endpoint = "/p/{pid}/c", parent-table = p, parent-key = id } }')
    assert [x.name for x in c.table("c").columns][0] == "_parent_pid" and c.table("c").kind == "child"


def test_cache(tmp_path):
    path = tmp_path / "spec.json"
    path.write_text(json.dumps(doc({"/a": get(LIST)})))
    cache = config.SpecCache(True, None, str(tmp_path / "kept"))
    assert len(spec.read(str(path), cache).endpoints) == 1
    path.write_text(json.dumps(doc({"/a": get(LIST), "/b": get(LIST)})))
    os.utime(path, (1, 1))
    assert len(spec.read(str(path), cache).endpoints) == 2
    held = config.SpecCache(True, 1000.0, str(tmp_path / "kept"))
    path.write_text(json.dumps(doc({})))
    assert len(spec.read(str(path), held).endpoints) == 2
    with pytest.raises(SpecError, match="can't be read"):
        spec.read(str(tmp_path / "none.json"))


def test_yaml():
    pytest.importorskip("yaml")
    assert spec.parse(spec.parse_text("openapi: 3.1.0\npaths:\n  /a:\n    get:\n      responses:\n        200:\n          content:\n            application/json:\n              schema: {type: [object, 'null'], properties: {id: {type: [integer, 'null']}}}\n")).endpoints[0].body.kind == "object"
