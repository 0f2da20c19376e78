import logging

import pytest

from tidewire.errors import ConfigError
from tidewire.sources import config, hocon


def parse(text, **env):
    return hocon.parse(text, "test", env)


def test_hocon_values():
    got = parse(
        """
        # a comment
        a = 1, b : "two" // another
        c.d.e = true
        c { f = null, d { g = 2.5 } }
        list = [1, "x", y z,
                 {k = v}]
        text = three words here
        url = "http://x/y#z"
        path = /a/b.c
        long = \"\"\"raw "text" \\n\"\"\"
        """
    )
    assert got["a"] == 1 and got["b"] == "two"
    assert got["c"] == {"d": {"e": True, "g": 2.5}, "f": None}
    assert got["list"] == [1, "x", "y z", {"k": "v"}]
    assert got["text"] == "three words here" and got["url"] == "http://x/y#z" and got["path"] == "/a/b.c"
    assert got["long"] == 'raw "text" \\n'


def test_hocon_substitution():
    assert parse("a = ${X}\nb = ${?Y}\nc = pre-${X}-post\nd = 1\nd = ${?Y}", X="v") == {"a": "v", "c": "pre-v-post", "d": 1}
    assert parse("base = {x = 1}\nmore = ${base} {y = 2}")["more"] == {"x": 1, "y": 2}
    with pytest.raises(ConfigError, match="NOPE"):
        parse("a = ${NOPE}")
    with pytest.raises(ConfigError, match="itself"):
        parse("a = ${b}\nb = ${a}")


@pytest.mark.parametrize("text", ["a = [1, 2", 'a = "x', "a {", "= 1", "a 1", "a = 1 }"])
def test_hocon_broken(text):
    with pytest.raises(ConfigError, match="line"):
        parse(text)


def of(text, **env):
    return config.of(parse('openapi = "spec.json"\n' + text, **env), "/etc/x")


def test_defaults():
    c = of("")
    assert c.openapi == "/etc/x/spec.json"
    assert (c.pagination.style, c.pagination.max_page_size, c.pagination.max_pages) == ("none", 100, 1000)
    assert (c.schema.flatten_depth, c.schema.array_handling, c.schema.batch_size, c.schema.prefetch, c.schema.explode_outer, c.schema.mode) == (2, "keep_array", 4096, 2, False, "strict")
    assert (c.http.max_retries, c.http.max_backoff, c.http.timeout, c.http.response_format, c.http.compression) == (5, 30.0, 30.0, "json", True)
    assert (c.http.cache, c.http.cache_ttl, c.http.cache_entries) == (False, 300.0, 1000)


@pytest.mark.parametrize("location", ["https://x/spec", "/abs/spec.json"])
def test_spec_location_untouched(location):
    assert config.of({"openapi": location}, "/etc").openapi == location


@pytest.mark.parametrize(
    ("text", "what"),
    [
        ("tabels {}", "tabels"),
        ("tables { t { endpont = x } }", r"tables\.t\.endpont"),
        ("http { response-cache { size = 1 } }", r"http\.response-cache\.size"),
        ("auth { type = magic }", "auth.type"),
        ("auth { type = bearer }", "auth.token"),
        ("auth { type = oauth2, client-id = a }", "oauth2"),
        ("pagination { style = cursor }", "cursor-path"),
        ("pagination { max-page-size = 0 }", "max-page-size"),
        ("pagination { max-pages = many }", "max-pages"),
        ('http { timeout = "soon" }', "timeout"),
        ("http { rate-limit = 0 }", "rate-limit"),
        ("tables { t { data-path = results } }", "data-path"),
        ("tables { t { filters = [{ param = a, column = b, operators = [like] }] } }", "operators"),
        ("tables { t { aggregations { a { function = median } } } }", "function"),
        ("tables { t { aggregations { a { function = sum } } } }", "column"),
        ("tables { t { count { response-path = \"/n\" } } }", "endpoint or param"),
        ("tables { t { parent-table = p, parent-key = id, endpoint = \"/x/{id}\" } }", "no table p"),
        ("tables { p {}, t { parent-table = p, endpoint = \"/x/{id}\" } }", "go together"),
        ("tables { p {}, t { parent-table = p, parent-key = id, endpoint = \"/x\" } }", "placeholder"),
        ("tables { p {}, t { parent-table = p, parent-key = id, join-strategy = batch, endpoint = \"/x\" } }", "batch-param"),
        ("tables { p {}, t { parent-table = p, parent-key = id, join-strategy = batch, batch-param = ids, endpoint = \"/x/{id}\" } }", "batch join"),
        ("tables { t { checkpoint { enabled = true } } }", r"checkpoint\.path"),
        ("tables { t { checkpoint { enabled = true, path = x, mode = timestamp } } }", "timestamp-path"),
        ("pagination { style = link_header }\ntables { t { checkpoint { enabled = true, path = x, mode = cursor } } }", "link_header"),
        ("pagination { style = offset, page-size-param = n }\ntables { t { checkpoint { enabled = true, path = x, mode = timestamp, timestamp-path = \"/t\", timestamp-param = n } } }", "pagination sends n"),
        ("tables { t { partition { type = offset, size = 10, count = 2 } } }", "pagination style offset"),
        ("pagination { style = offset }\ntables { t { partition { type = offset, size = 2000000000, count = 2 } } }", "2147483647"),
        ("tables { t { partition { type = enum, param = a, values = [] } } }", "values"),
        ("tables { t { partition { column = c, start-param = a, end-param = b, range = \"90 seconds\", format = \"yyyy-MM-dd\" } } }", "multiple"),
        ("tables { t { partition { column = c, start-param = a, end-param = b, range = \"1 day\", format = \"yyyy-Q\" } } }", "format"),
        ("tables { t { partition { type = enum, param = a, values = [1] }, checkpoint { enabled = true, path = x } } }", "partitioned"),
        ("pagination { style = offset, offset-param = a }\ntables { t { partition { type = enum, param = a, values = [1] } } }", "pagination sends a"),
    ],
)
def test_rejected(text, what):
    with pytest.raises(ConfigError, match=what):
        of(text)


def test_missing_spec_and_file():
    with pytest.raises(ConfigError, match="openapi"):
        config.of({})
    with pytest.raises(ConfigError, match="can't be read"):
        config.load("/no/such/file.conf")


def test_free_names_and_legacy_count():
    c = of('tables { "my table" { aggregations { any { function = count, params { "x-y" = true } } }, count { param = per_page, param-value = 1, response-path = "/n" } } }')
    a, b = c.tables["my table"].aggregations
    assert (a.name, a.params) == ("any", (("x-y", "true"),))
    assert (b.function, b.column, b.params, b.response_path) == ("count", None, (("per_page", "1"),), "/n")


def test_warnings(caplog):
    with caplog.at_level(logging.WARNING, "tidewire"):
        of('base-url = "http://x"\nauth { type = bearer, token = t }\npagination { style = offset, page-size-param = limit }\ntables { t { filters = [{ param = limit, column = size }] } }')
    assert "plain http" in caplog.text and "never pushed" in caplog.text


def test_reserved():
    c = of('pagination { style = cursor, cursor-path = "/n", page-size-param = n }\ntables { t { checkpoint { enabled = true, path = x, mode = timestamp, timestamp-path = "/t", timestamp-param = since } } }')
    assert c.reserved(c.tables["t"]) == {"cursor", "n", "since"}
