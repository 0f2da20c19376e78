"""Configuration files: parsing, defaults and every check that can be made before a request is sent."""

from __future__ import annotations

import logging
import os
import re
from dataclasses import dataclass, field
from typing import Any

from ..errors import ConfigError
from ..functions import pointers
from ..streaming.times import TimeFormat
from . import hocon

log = logging.getLogger("tidewire")

STYLES = ("none", "cursor", "offset", "link_header")
OPERATORS = ("eq", "gt", "gte", "lt", "lte", "neq")
FUNCTIONS = ("count", "sum", "avg", "min", "max", "custom")


@dataclass(frozen=True)
class Auth:
    type: str = "none"
    token: str | None = None
    username: str = ""
    password: str = ""
    header_name: str = ""
    header_value: str = ""
    client_id: str | None = None
    client_secret: str | None = None
    token_url: str | None = None


@dataclass(frozen=True)
class Pagination:
    style: str = "none"
    cursor_path: str | None = None
    cursor_param: str = "cursor"
    offset_param: str = "offset"
    page_size_param: str | None = None
    max_page_size: int = 100
    results_path: str | None = None
    max_pages: int = 1000

    def own_params(self) -> set[str]:
        """Query parameters that paging itself sends."""
        if self.style == "none":
            return set()
        out = {self.page_size_param} if self.page_size_param else set()
        return out | ({self.cursor_param} if self.style == "cursor" else {self.offset_param} if self.style == "offset" else set())


@dataclass(frozen=True)
class SchemaConfig:
    flatten_depth: int = 2
    array_handling: str = "keep_array"
    batch_size: int = 4096
    prefetch: int = 2
    explode_outer: bool = False
    mode: str = "strict"


@dataclass(frozen=True)
class Http:
    max_retries: int = 5
    max_backoff: float = 30.0
    timeout: float = 30.0
    rate_limit: int | None = None
    response_format: str = "json"
    compression: bool = True
    cache: bool = False
    cache_ttl: float = 300.0
    cache_entries: int = 1000


@dataclass(frozen=True)
class Filter:
    param: str
    column: str
    operators: tuple[str, ...]


@dataclass(frozen=True)
class Partition:
    type: str
    column: str = ""
    start_param: str = ""
    end_param: str = ""
    range: float = 0.0
    format: str = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    param: str = ""
    values: tuple[str, ...] = ()
    size: int = 0
    count: int = 0


@dataclass(frozen=True)
class Aggregation:
    name: str
    function: str
    response_path: str
    column: str | None = None
    endpoint: str | None = None
    params: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Checkpoint:
    enabled: bool = False
    path: str | None = None
    mode: str = "cursor"
    timestamp_path: str | None = None
    timestamp_param: str | None = None

    @property
    def streams(self) -> bool:
        return self.mode == "timestamp" and bool(self.timestamp_path and self.timestamp_param)


@dataclass(frozen=True)
class Table:
    name: str
    endpoint: str | None = None
    data_path: str | None = None
    pagination: Pagination | None = None
    filters: tuple[Filter, ...] = ()
    parent_table: str | None = None
    parent_key: str | None = None
    join_strategy: str = "nested_loop"
    partition: Partition | None = None
    batch_param: str | None = None
    batch_size: int = 100
    batch_separator: str = ","
    child_key_field: str | None = None
    aggregations: tuple[Aggregation, ...] = ()
    checkpoint: Checkpoint | None = None

    @property
    def placeholder(self) -> str | None:
        found = re.search(r"\{([^}]+)\}", self.endpoint or "")
        return found[1] if found else None

    @property
    def parent_column(self) -> str:
        return f"_parent_{self.placeholder or self.parent_key}"


@dataclass(frozen=True)
class SpecCache:
    enabled: bool = True
    ttl: float | None = None
    directory: str | None = None


@dataclass(frozen=True)
class Source:
    openapi: str
    base_url: str | None = None
    auth: Auth = Auth()
    pagination: Pagination = Pagination()
    schema: SchemaConfig = SchemaConfig()
    http: Http = Http()
    tables: dict[str, Table] = field(default_factory=dict)
    cache: SpecCache = SpecCache()

    def paging(self, table: Table) -> Pagination:
        return table.pagination or self.pagination

    def reserved(self, table: Table) -> set[str]:
        """Parameters that a filter must not set, as something else sends them."""
        out = self.paging(table).own_params()
        if table.batch_param:
            out.add(table.batch_param)
        if table.checkpoint and table.checkpoint.enabled and table.checkpoint.mode == "timestamp" and table.checkpoint.timestamp_param:
            out.add(table.checkpoint.timestamp_param)
        return out


_UNITS = {"": 0.001, "ms": 0.001, "millis": 0.001, "milliseconds": 0.001, "s": 1, "second": 1, "seconds": 1, "m": 60, "minute": 60, "minutes": 60, "h": 3600, "hour": 3600, "hours": 3600, "d": 86400, "day": 86400, "days": 86400}

_PAGING = dict.fromkeys("style cursor-path cursor-param offset-param page-size-param max-page-size results-path max-pages".split())
_SHAPE: dict[str, Any] = {
    **dict.fromkeys(["openapi", "base-url"]),
    "auth": dict.fromkeys("type token username password header-name header-value client-id client-secret token-url".split()),
    "pagination": _PAGING,
    "schema": dict.fromkeys("flatten-depth array-handling arrow-batch-size prefetch-batches explode-outer mode".split()),
    "http": {**dict.fromkeys("max-retries max-backoff timeout rate-limit response-format compression".split()), "response-cache": dict.fromkeys("enabled backend ttl max-entries".split())},
    "cache": dict.fromkeys("enabled ttl directory".split()),
    "tables": {
        "*": {
            **dict.fromkeys("endpoint data-path parent-table parent-key join-strategy batch-param batch-size batch-separator child-key-field".split()),
            "pagination": _PAGING,
            "filters": [dict.fromkeys("param column operators".split())],
            "partition": dict.fromkeys("type range column start-param end-param format param values size count".split()),
            "count": dict.fromkeys("endpoint param param-value response-path".split()),
            "aggregations": {"*": {**dict.fromkeys("function name column endpoint response-path".split()), "params": {"*": None}}},
            "checkpoint": dict.fromkeys("enabled path mode timestamp-path timestamp-param".split()),
        }
    },
}


def unknown_keys(value: Any, shape: Any = _SHAPE, at: str = "") -> list[str]:
    """Dotted paths of the keys that no shape has."""
    if isinstance(shape, list) and isinstance(value, list):
        return [k for i, v in enumerate(value) for k in unknown_keys(v, shape[0], f"{at}[{i}]")]
    if not isinstance(shape, dict) or not isinstance(value, dict):
        return []
    out = []
    for k, v in value.items():
        path = f"{at}.{k}" if at else k
        if k in shape or "*" in shape:
            out += unknown_keys(v, shape.get(k, shape.get("*")), path)
        else:
            out.append(path)
    return out


class _Node:
    """A configuration object that knows its path."""

    def __init__(self, value: Any, at: str):
        if not isinstance(value, dict):
            raise ConfigError(f"{at}: expected an object")
        self.value, self.at = value, at

    def path(self, key: str) -> str:
        return f"{self.at}.{key}" if self.at else key

    def has(self, key: str) -> bool:
        return self.value.get(key) is not None

    def text(self, key: str, default: Any = None) -> Any:
        v = self.value.get(key)
        if v is None:
            return default
        if isinstance(v, (dict, list)):
            raise ConfigError(f"{self.path(key)}: expected a string")
        return str(v).lower() if isinstance(v, bool) else str(v)

    def need(self, key: str) -> str:
        v = self.text(key)
        if v is None or v == "":
            raise ConfigError(f"{self.path(key)}: is missing")
        return v

    def whole(self, key: str, default: Any = None, least: int | None = None) -> Any:
        v = self.value.get(key)
        if v is None:
            return default
        if isinstance(v, bool) or not re.fullmatch(r"[+-]?\d+", str(v)):
            raise ConfigError(f"{self.path(key)}: expected a whole number, found {v!r}")
        if least is not None and int(v) < least:
            raise ConfigError(f"{self.path(key)}: must be at least {least}")
        return int(v)

    def flag(self, key: str, default: bool = False) -> bool:
        v = self.value.get(key)
        if v is None:
            return default
        word = str(v).lower()
        if word in ("true", "yes", "on"):
            return True
        if word in ("false", "no", "off"):
            return False
        raise ConfigError(f"{self.path(key)}: expected true or false, found {v!r}")

    def seconds(self, key: str, default: Any = None) -> Any:
        v = self.value.get(key)
        if v is None:
            return default
        m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([a-z]*)\s*", str(v))
        if not m or m[2] not in _UNITS:
            raise ConfigError(f"{self.path(key)}: expected a duration such as '30 seconds', found {v!r}")
        return float(m[1]) * _UNITS[m[2]]

    def one_of(self, key: str, allowed: tuple[str, ...], default: str | None = None) -> str:
        v = self.text(key, default)
        word = None if v is None else v.lower()
        if word not in allowed:
            raise ConfigError(f"{self.path(key)}: expected one of {', '.join(allowed)}, found {v!r}")
        return word

    def pointer(self, key: str) -> str | None:
        v = self.text(key)
        if v is not None:
            try:
                pointers.parts(v)
            except ValueError as error:
                raise ConfigError(f"{self.path(key)}: {error}") from None
        return v

    def sub(self, key: str) -> "_Node":
        return _Node(self.value.get(key) or {}, self.path(key))


def _auth(n: _Node) -> Auth:
    kind = n.one_of("type", ("none", "bearer", "basic", "header", "oauth2"), "none")
    if kind == "bearer":
        return Auth(kind, token=n.need("token"))
    if kind == "basic":
        return Auth(kind, username=n.need("username"), password=n.need("password"))
    if kind == "header":
        return Auth(kind, header_name=n.need("header-name"), header_value=n.need("header-value"))
    if kind == "oauth2":
        keys = ("client-id", "client-secret", "token-url")
        if not n.has("token") and not all(n.has(k) for k in keys):
            raise ConfigError(f"{n.at}: oauth2 needs a token, or all of {', '.join(keys)}")
        return Auth(kind, token=n.text("token"), client_id=n.text("client-id"), client_secret=n.text("client-secret"), token_url=n.text("token-url"))
    return Auth()


def _pagination(n: _Node) -> Pagination:
    style = n.one_of("style", STYLES, "none")
    out = Pagination(
        style, n.pointer("cursor-path"), n.text("cursor-param", "cursor"), n.text("offset-param", "offset"), n.text("page-size-param"), n.whole("max-page-size", 100, 1), n.pointer("results-path"), n.whole("max-pages", 1000, 1)
    )
    if style == "cursor" and not out.cursor_path:
        raise ConfigError(f"{n.path('cursor-path')}: is missing; style cursor needs it")
    return out


def _http(n: _Node) -> Http:
    fmt = n.one_of("response-format", ("json", "ndjson", "jsonl", "sse"), "json")
    cache = n.sub("response-cache")
    if cache.has("backend"):
        cache.one_of("backend", ("memory", "in-memory"))
    return Http(
        n.whole("max-retries", 5, 0), n.seconds("max-backoff", 30.0), n.seconds("timeout", 30.0), n.whole("rate-limit", None, 1), "ndjson" if fmt == "jsonl" else fmt, n.flag("compression", True), cache.flag("enabled"), cache.seconds("ttl", 300.0), cache.whole("max-entries", 1000, 1)
    )


def _partition(n: _Node) -> Partition:
    kind = n.one_of("type", ("date-range", "enum", "offset"), "date-range")
    if kind == "offset":
        size, count = n.whole("size", None, 1), n.whole("count", None, 1)
        if size is None or count is None:
            raise ConfigError(f"{n.at}: offset partitions need size and count")
        if size * count > 2**31 - 1:
            raise ConfigError(f"{n.at}: size * count is over 2147483647")
        return Partition(kind, size=size, count=count)
    if kind == "enum":
        values = n.value.get("values")
        if not isinstance(values, list) or not values:
            raise ConfigError(f"{n.path('values')}: expected a list that isn't empty")
        return Partition(kind, param=n.need("param"), values=tuple(str(v).lower() if isinstance(v, bool) else str(v) for v in values))
    span = n.seconds("range")
    if not span:
        raise ConfigError(f"{n.path('range')}: expected a duration over 0")
    out = Partition(kind, column=n.need("column"), start_param=n.need("start-param"), end_param=n.need("end-param"), range=span, format=n.text("format", Partition.format))
    try:
        step = TimeFormat(out.format).step
    except ValueError as error:
        raise ConfigError(f"{n.path('format')}: {error}") from None
    if span % step:
        raise ConfigError(f"{n.path('range')}: must be a multiple of the {step:g} s that the format can tell apart")
    return out


def _aggregations(n: _Node, table: _Node) -> tuple[Aggregation, ...]:
    out = []
    for key in n.value:
        a = n.sub(key)
        function = a.one_of("function", FUNCTIONS)
        column = a.text("column")
        if function in ("sum", "avg", "min", "max") and not column:
            raise ConfigError(f"{a.path('column')}: is missing; {function} needs it")
        if function == "custom" and not a.has("name"):
            raise ConfigError(f"{a.path('name')}: is missing; custom needs it")
        params = a.sub("params").value
        out.append(Aggregation(a.text("name", key), function, a.pointer("response-path") or f"/{key}", column, a.text("endpoint"), tuple((str(k), str(v).lower() if isinstance(v, bool) else str(v)) for k, v in params.items())))
    if table.has("count"):
        c = table.sub("count")
        if not c.has("endpoint") and not c.has("param"):
            raise ConfigError(f"{c.at}: needs endpoint or param")
        params = () if c.has("endpoint") else ((c.need("param"), c.text("param-value", "true")),)
        out.append(Aggregation("count", "count", c.pointer("response-path") or "/count", None, c.text("endpoint"), params))
    return tuple(out)


def _table(name: str, n: _Node, source_paging: Pagination, http: Http) -> Table:
    filters = []
    for i, f in enumerate(n.value.get("filters") or []):
        node = _Node(f, f"{n.at}.filters[{i}]")
        ops = f.get("operators", ["eq"])
        ops = [ops] if isinstance(ops, str) else ops
        bad = [o for o in ops if o not in OPERATORS]
        if bad:
            raise ConfigError(f"{node.path('operators')}: unknown {', '.join(map(str, bad))}; allowed: {', '.join(OPERATORS)}")
        filters.append(Filter(node.need("param"), node.need("column"), tuple(ops)))
    checkpoint = None
    if n.has("checkpoint"):
        c = n.sub("checkpoint")
        checkpoint = Checkpoint(c.flag("enabled"), c.text("path"), c.one_of("mode", ("cursor", "offset", "timestamp"), "cursor"), c.pointer("timestamp-path"), c.text("timestamp-param"))
    out = Table(
        name, n.text("endpoint"), n.pointer("data-path"), _pagination(n.sub("pagination")) if n.has("pagination") else None, tuple(filters), n.text("parent-table"), n.text("parent-key"),
        n.one_of("join-strategy", ("nested_loop", "batch"), "nested_loop"), _partition(n.sub("partition")) if n.has("partition") else None, n.text("batch-param"), n.whole("batch-size", 100, 1), n.text("batch-separator", ","),
        n.text("child-key-field"), _aggregations(n.sub("aggregations"), n), checkpoint,
    )
    _check_table(out, n, source_paging if out.pagination is None else out.pagination, http)
    return out


def _check_table(t: Table, n: _Node, paging: Pagination, http: Http) -> None:
    if bool(t.parent_table) != bool(t.parent_key):
        raise ConfigError(f"{n.at}: parent-table and parent-key go together")
    if t.parent_table and t.join_strategy == "batch":
        if not t.batch_param:
            raise ConfigError(f"{n.path('batch-param')}: is missing; join-strategy batch needs it")
        if t.placeholder:
            raise ConfigError(f"{n.path('endpoint')}: a batch join has no {{placeholder}}")
    elif t.parent_table and not t.placeholder:
        raise ConfigError(f"{n.path('endpoint')}: a nested_loop join needs a {{placeholder}} for the parent's key")
    c, own = t.checkpoint, paging.own_params()
    if c is not None:
        at = n.path("checkpoint")
        if c.enabled and not c.path:
            raise ConfigError(f"{at}.path: is missing")
        if c.enabled and c.mode == "timestamp" and not (c.timestamp_path and c.timestamp_param):
            raise ConfigError(f"{at}: mode timestamp needs timestamp-path and timestamp-param")
        if c.enabled and paging.style == "link_header" and c.mode in ("cursor", "offset"):
            raise ConfigError(f"{at}.mode: link_header pagination has no {c.mode} to save")
        if c.timestamp_param and c.mode == "timestamp" and c.timestamp_param in own:
            raise ConfigError(f"{at}.timestamp-param: pagination sends {c.timestamp_param}, too")
    p = t.partition
    if p is not None:
        at = n.path("partition")
        if c is not None and c.enabled:
            raise ConfigError(f"{at}: a partitioned table can't have a checkpoint")
        clash = own & {x for x in (p.param, p.start_param, p.end_param) if x}
        if clash:
            raise ConfigError(f"{at}: pagination sends {', '.join(sorted(clash))}, too")
        if p.type == "offset" and (paging.style != "offset" or http.response_format != "json"):
            raise ConfigError(f"{at}: offset partitions need pagination style offset and response-format json")
    for i, f in enumerate(t.filters):
        if f.param in own or f.param == t.batch_param:
            log.warning("%s.filters[%d]: %s is sent by the engine itself; this filter is never pushed", n.at, i, f.param)
    if t.parent_table and t.pagination is None and paging.style != "none" and not t.data_path:
        log.warning("%s: without its own data-path and pagination a child endpoint may give no rows", n.at)


def _plain(url: str | None, auth: Auth) -> bool:
    return auth.type != "none" and bool(url) and url.lower().startswith("http://")


def of(value: dict, directory: str = ".") -> Source:
    """A checked configuration from a parsed one; a relative spec path is below the directory."""
    bad = unknown_keys(value)
    if bad:
        raise ConfigError(f"unknown keys: {', '.join(sorted(bad))}")
    root = _Node(value, "")
    openapi = root.need("openapi")
    if not re.match(r"[a-zA-Z][a-zA-Z0-9+.-]+:", openapi) and not os.path.isabs(openapi):
        openapi = os.path.join(directory, openapi)
    paging, http = _pagination(root.sub("pagination")), _http(root.sub("http"))
    s = root.sub("schema")
    schema = SchemaConfig(
        s.whole("flatten-depth", 2, 0), s.one_of("array-handling", ("keep_array", "explode_view", "both"), "keep_array"), s.whole("arrow-batch-size", 4096, 1), s.whole("prefetch-batches", 2, 1), s.flag("explode-outer"), s.one_of("mode", ("strict", "variant"), "strict")
    )
    auth = _auth(root.sub("auth"))
    tables_node = root.sub("tables")
    tables = {name: _table(name, tables_node.sub(name), paging, http) for name in tables_node.value}
    for t in tables.values():
        if t.parent_table and t.parent_table not in tables:
            raise ConfigError(f"tables.{t.name}.parent-table: there is no table {t.parent_table}")
        if t.parent_table and tables[t.parent_table].parent_table:
            raise ConfigError(f"tables.{t.name}.parent-table: {t.parent_table} is a child table itself")
    cache = root.sub("cache")
    out = Source(openapi, root.text("base-url"), auth, paging, schema, http, tables, SpecCache(cache.flag("enabled", True), cache.seconds("ttl"), cache.text("directory")))
    for key, url in (("base-url", out.base_url), ("auth.token-url", auth.token_url)):
        if _plain(url, auth):
            log.warning("%s: credentials will be sent over plain http", key)
    return out


def load(path: str, env: dict[str, str] | None = None) -> Source:
    try:
        with open(path, encoding="utf-8") as f:
            text = f.read()
    except OSError as error:
        raise ConfigError(f"{path}: can't be read: {error.strerror}") from None
    return of(hocon.parse(text, path, env), os.path.dirname(os.path.abspath(path)))
