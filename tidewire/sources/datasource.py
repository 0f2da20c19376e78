"""The Spark data source: planning and reading a table.

A registered source is a subclass with its configuration bound to it, as planner and executor processes see no state
of the driver. Options of a read: ``config`` and ``table`` (for the unbound source), and those that the engine sets:
``_columns`` (only these are converted, the others are NULL), ``_limit``, ``_aggregates`` with ``_schema``, ``_params``.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import os
from collections.abc import Iterator
from dataclasses import dataclass, replace
from typing import Any

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, Not
from pyspark.sql.types import StructType, VariantVal

from ..errors import ConfigError, EngineError
from ..functions import pointers
from ..functions.columnar import PageReader, array, reader
from ..functions.convert import TYPES, Counts, column, compact, inexact, instant
from ..operators.joins import child_records, parent_keys
from ..streaming.checkpoints import Store
from ..streaming.times import TimeFormat, bound, iso
from . import config as configs
from . import metrics
from . import spec as specs
from .config import Source
from .http import Client, close_quietly
from .paging import Page, ahead, fetch
from .tables import Catalog, TableSpec

log = logging.getLogger("tidewire")

_OPERATORS = {EqualTo: "eq", GreaterThan: "gt", GreaterThanOrEqual: "gte", LessThan: "lt", LessThanOrEqual: "lte"}
_CATALOGS: dict[tuple[str, float], Catalog] = {}


def catalog_of(path: str) -> Catalog:
    """The catalog of a configuration file; an edited file is read again."""
    path = os.path.abspath(path)
    try:
        key = (path, os.stat(path).st_mtime)
    except OSError as error:
        raise ConfigError(f"{path}: can't be read: {error.strerror}") from None
    if key not in _CATALOGS:
        source = configs.load(path)
        _CATALOGS[key] = Catalog(source, specs.read(source.openapi, source.cache, source.http.timeout))
    return _CATALOGS[key]


@dataclass
class Part(InputPartition):
    """A share of a read: parameters of its own, a window of offsets, keys of parents, and its rate limit."""

    params: dict[str, str]
    window: tuple[int, int] | None = None
    rate: float | None = None
    keys: tuple[str, ...] | None = None
    nothing: bool = False

    def __init__(self, params: dict[str, str], window=None, rate=None, keys=None, nothing: bool = False):
        super().__init__(None)
        self.params, self.window, self.rate, self.keys, self.nothing = params, window, rate, keys, nothing


def literal(value: Any) -> str | None:
    """A filter's value as a parameter: instants in ISO form, dates as midnight UTC."""
    if value is None:
        return None
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, dt.datetime):
        return iso(value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc))
    if isinstance(value, dt.date):
        return iso(dt.datetime(value.year, value.month, value.day, tzinfo=dt.timezone.utc))
    return str(value) if isinstance(value, (str, int, float)) or hasattr(value, "as_tuple") else None


def shares(limit: int | None, n: int) -> list[float | None]:
    """A rate limit divided among n partitions, the first ones getting what remains."""
    if limit is None:
        return [None] * n
    if n > limit:
        raise EngineError(f"http.rate-limit {limit} is less than the table's {n} partitions")
    return [limit // n + (i < limit % n) for i in range(n)]


class Pushed:
    """Filters that became parameters, and what partitions made of them."""

    def __init__(self, source: Source, spec: TableSpec, params: dict[str, str] | None = None):
        self.source, self.spec, self.params = source, spec, dict(params or {})
        self.reserved = source.reserved(spec.table)

    def push(self, name: str, operator: str, value: Any) -> bool:
        """Sets the parameter of a comparison, if the table has one that is free. Then the API is trusted with it."""
        text = literal(value)
        if text is None:
            return False
        for f in self.spec.table.filters:
            if f.column == name and operator in f.operators and f.param not in self.reserved and f.param not in self.params:
                self.params[f.param] = text
                return True
        return False

    def partitions(self) -> list[Part]:
        p, limit = self.spec.table.partition, self.source.http.rate_limit
        if p is None or self.spec.kind != "base":
            return [Part(self.params, rate=limit)]
        if p.type == "offset":
            rates = shares(limit, p.count)
            return [Part(self.params, (i * p.size, (i + 1) * p.size), rates[i]) for i in range(p.count)]
        if p.type == "enum":
            if p.param in self.params:
                return [Part(self.params, rate=limit)]
            rates = shares(limit, len(p.values))
            return [Part(self.params | {p.param: v}, rate=r) for v, r in zip(p.values, rates)]
        lo, hi = self.params.get(p.start_param), self.params.get(p.end_param)
        if lo is None or hi is None:
            return [Part(self.params, rate=limit)]
        a, b = bound(lo), bound(hi)
        if a is None or b is None:
            log.warning("table %s: %s and %s aren't both times; one partition reads all", self.spec.name, lo, hi)
            return [Part(self.params, rate=limit)]
        if a >= b:
            return [Part({}, nothing=True)]
        fmt, step = TimeFormat(p.format), dt.timedelta(seconds=p.range)
        edges, at = [lo], a + step
        while at < b:
            edges.append(fmt.format(at))
            at += step
        edges.append(hi)
        rates = shares(limit, len(edges) - 1)
        return [Part(self.params | {p.start_param: x, p.end_param: y}, rate=r) for x, y, r in zip(edges, edges[1:], rates)]


def batches(spec: TableSpec, records: list | pa.StructArray, needed: set[str] | None, counts: Counts | None) -> pa.RecordBatch:
    """Records as a batch; columns that aren't needed are NULL and never converted."""
    arrays, fields = [], []
    for c in spec.columns:
        kind = TYPES[c.type][0]
        fields.append(pa.field(c.name, kind))
        if needed is not None and c.name not in needed:
            arrays.append(pa.nulls(len(records), kind))
            continue
        if isinstance(records, pa.StructArray):
            arrays.append(array(records, c, counts))
            continue
        if len(c.path) == 1:
            k = c.path[0]
            values = [r.get(k) if isinstance(r, dict) else None for r in records]
        else:
            values = [None if (v := pointers.get(r, list(c.path))) is pointers.MISSING else v for r in records]
        arrays.append(column(c.type, values, c.name, counts))
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))


class RestReader(DataSourceReader):
    """Reads a table, or its pushed aggregates."""

    def __init__(self, source: Source, base_url: str, spec: TableSpec, options: dict[str, str]):
        self.source, self.base_url, self.spec, self.options = source, base_url, spec, dict(options)
        self.pushed = Pushed(source, spec, json.loads(options.get("_params", "{}")))
        self.needed = set(json.loads(options["_columns"])) if "_columns" in options else None
        self.limit = int(options["_limit"]) if "_limit" in options else None
        self.aggregates = json.loads(options["_aggregates"]) if "_aggregates" in options else None
        self.metrics = options.get("_metrics")
        self.incremental = options.get("_incremental") == "true"

    def pushFilters(self, filters):
        for f in filters:
            g, operator = (f.child, "neq") if isinstance(f, Not) and isinstance(f.child, EqualTo) else (f, _OPERATORS.get(type(f)))
            done = operator is not None and len(g.attribute) == 1 and self.options.get("_verify") != "true" and self.pushed.push(g.attribute[0], operator, g.value)
            log.info("table %s: %s %s", self.spec.name, "pushed" if done else "left to Spark", f)
            if not done:
                yield f

    def partitions(self):
        if self.aggregates is not None:
            return [Part(self.pushed.params, rate=self.source.http.rate_limit)]
        split = int(self.options.get("_parallelism", "1"))
        if self.spec.kind == "child" and split > 1:
            client = Client(self.source.http, self.source.auth, self.base_url)
            try:
                keys = list(parent_keys(client, self.spec))
            finally:
                close_quietly(client)
            size = self.spec.table.batch_size if self.spec.table.join_strategy == "batch" else 1
            groups = [keys[i : i + size] for i in range(0, len(keys), size)]
            n = max(1, min(split, len(groups)))
            rates = shares(self.source.http.rate_limit, n)
            return [Part(self.pushed.params, rate=rates[i], keys=tuple(k for g in groups[i::n] for k in g)) for i in range(n)]
        return self.pushed.partitions()

    def _store(self) -> Store | None:
        c = self.spec.table.checkpoint
        return Store(c.path, self.spec.table.name) if c is not None and c.enabled and self.spec.kind == "base" and self.source.http.response_format == "json" else None

    def read(self, part):
        if part is None or part.nothing:
            return
        client = Client(self.source.http, self.source.auth, self.base_url, part.rate)
        try:
            if self.aggregates is not None:
                yield self._aggregate(client, part.params)
                return
            yield from self._rows(client, part)
        finally:
            close_quietly(client)

    def _pages(self, client: Client, part: Part, start: str | None, params: dict[str, str]) -> Iterator[Page]:
        if self.spec.kind == "child":
            keys = iter(part.keys) if part.keys is not None else parent_keys(client, self.spec)
            return (Page(r) for r in child_records(client, self.spec, params, keys, self.limit))
        return fetch(client, self.spec.path, params, self.spec.paging, self.spec.table.data_path, self.limit, start, part.window, self.source.schema.batch_size)

    def _rows(self, client: Client, part: Part) -> Iterator[Any]:
        store, c = self._store(), self.spec.table.checkpoint
        saved = store.load(c.mode) if store else None
        params, start = dict(part.params), None
        if saved is not None:
            if c.mode == "timestamp":
                params[c.timestamp_param] = saved
            else:
                start = saved
        counts = Counts()
        size, state, latest = self.source.schema.batch_size, None, None
        client.exact = self.spec.variant or self.spec.kind == "child"
        client.columns = self._columnar(store)
        for page in ahead(self._pages(client, part, start, params), self.source.schema.prefetch):
            state = page.state or state
            if store and c.mode == "timestamp":
                latest = _latest(page.records, c.timestamp_path, latest)
            records = page.records
            if page.again is not None and self._raw(records):
                records = page.again()
            for i in range(0, len(records), size):
                yield from self.emit(records[i : i + size], counts)
        if store and self.incremental:
            value = latest[1] if c.mode == "timestamp" and latest else None if c.mode == "timestamp" else state
            if value is not None:
                store.stage(c.mode, value)
        for name, n in counts.nulled.items():
            log.warning("table %s: %d values of %s don't fit its type and are NULL, the first %s", self.spec.name, n, name, counts.first[name])
        if self.metrics:
            metrics.write(self.metrics, {"table": self.spec.name, "converted": counts.converted, "nulled": counts.nulled})

    def _columnar(self, store: Store | None) -> PageReader | None:
        """The reader of whole pages; None where records are looked at one by one, or counted by another list."""
        paging, data_path = self.spec.paging, self.spec.table.data_path
        if self.spec.variant or self.spec.kind != "base" or self.source.http.response_format != "json" or store and self.spec.table.checkpoint.mode == "timestamp":
            return None
        if paging.style == "offset" and paging.results_path not in (None, data_path):
            return None
        return reader(self.spec.columns, self.needed, data_path, paging.cursor_path if paging.style == "cursor" else None)

    def _raw(self, records: list) -> bool:
        """Whether a text column would show numbers, whose source text is needed then."""
        texts = [c for c in self.spec.columns if c.type == "string" and (self.needed is None or c.name in self.needed)]
        return any(inexact(pointers.get(r, list(c.path)) if len(c.path) > 1 else r.get(c.path[0]) if isinstance(r, dict) else None) for c in texts for r in records)

    def emit(self, records: list | pa.StructArray, counts: Counts | None) -> Iterator[Any]:
        if self.spec.variant:
            for r in records:
                yield (None if r is None else VariantVal.parseJson(compact(r)),)
        elif len(records):
            yield batches(self.spec, records, self.needed, counts)

    def _aggregate(self, client: Client, params: dict[str, str]) -> tuple:
        bodies: dict[tuple, Any] = {}
        by_name = {a.name: a for a in self.spec.table.aggregations}
        out = []
        for name, kind in self.aggregates:
            a = by_name[name]
            mine = params | dict(a.params)
            key = (a.endpoint or self.spec.path, tuple(sorted(mine.items())))
            if key not in bodies:
                got = client.get(client.url(key[0], mine))
                try:
                    bodies[key] = json.loads(got.body)
                except ValueError as error:
                    raise EngineError(f"aggregation {name}: the response isn't JSON: {error}") from None
            out.append(coerce(name, kind, pointers.get(bodies[key], a.response_path), a.response_path))
        return tuple(out)


def coerce(name: str, kind: str, value: Any, pointer: str) -> Any:
    """An aggregate's value in its planned type; null stays null, anything else that doesn't fit is an error."""
    if value is pointers.MISSING:
        raise EngineError(f"aggregation {name}: the response has nothing at {pointer}")
    if value is None:
        return None
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        raise EngineError(f"aggregation {name}: expected a number at {pointer}, found {json.dumps(value)[:60]}")
    if kind == "bigint":
        if float(value) != int(value):
            raise EngineError(f"aggregation {name}: expected a whole number at {pointer}, found {value}")
        return int(value)
    return float(value)


def _latest(records: list, pointer: str, best: tuple[dt.datetime, str] | None) -> tuple[dt.datetime, str] | None:
    """The latest timestamp of records, and its text."""
    for r in records:
        text = pointers.get(r, pointer)
        at = instant(text) if isinstance(text, str) else None
        if at is not None and (best is None or at > best[0]):
            best = (at, text)
    return best


def now_floor(now: dt.datetime) -> dt.datetime:
    """The last second that has fully elapsed."""
    return (now - dt.timedelta(seconds=1)).replace(microsecond=0)


class RestStreamReader(DataSourceStreamReader):
    """Micro-batches over what changed in (start, end]. Offsets are times with whole seconds."""

    def __init__(self, source: Source, base_url: str, spec: TableSpec, options: dict[str, str]):
        self.inner = RestReader(replace(source), base_url, spec, {k: v for k, v in options.items() if k.startswith("_")})
        self.spec, self.clock, self.start = spec, options.get("_now"), options.get("_start")

    def _now(self) -> str:
        if self.clock and os.path.exists(self.clock):
            with open(self.clock, encoding="utf-8") as f:
                return f.read().strip()
        return iso(now_floor(dt.datetime.now(dt.timezone.utc)))

    def initialOffset(self) -> dict:
        return {"type": "timestamp", "value": self.start or self._now()}

    def latestOffset(self) -> dict:
        return {"type": "timestamp", "value": self._now()}

    def partitions(self, start: dict, end: dict):
        a, b = instant(start["value"]), instant(end["value"])
        if a is None or b is None:
            raise EngineError(f"the offsets {start} and {end} aren't times")
        if a >= b:
            return []
        return [Part({"since": start["value"], "until": end["value"]}, rate=self.inner.source.http.rate_limit)]

    def read(self, part):
        c = self.spec.table.checkpoint
        lo, hi = instant(part.params["since"]), instant(part.params["until"])
        client = Client(self.inner.source.http, self.inner.source.auth, self.inner.base_url, part.rate)
        try:
            params = self.inner.pushed.params | {c.timestamp_param: part.params["since"]}
            for page in fetch(client, self.spec.path, params, self.spec.paging, self.spec.table.data_path):
                kept = []
                for r in page.records:
                    text = pointers.get(r, c.timestamp_path)
                    at = instant(text) if isinstance(text, str) else None
                    if at is None or lo < at <= hi:  # a record without a time is kept
                        kept.append(r)
                yield from self.inner.emit(kept, None)
        finally:
            close_quietly(client)

    def commit(self, end: dict) -> None:
        pass


def streams(spec: TableSpec) -> bool:
    return spec.kind == "base" and spec.table.checkpoint is not None and spec.table.checkpoint.streams


def check_streams(spec: TableSpec) -> None:
    if not streams(spec):
        raise EngineError(f"table {spec.name} can't be streamed: it needs checkpoint.mode = timestamp with timestamp-path and timestamp-param, on a base table")


class RestSource(DataSource):
    """``spark.read.format("tidewire").option("config", path).option("table", name)``, or a subclass bound to a table."""

    CATALOG: Catalog | None = None
    TABLE: str | None = None

    @classmethod
    def name(cls) -> str:
        return "tidewire"

    def _catalog(self) -> Catalog:
        if self.CATALOG is not None:
            return self.CATALOG
        if not self.options.get("config"):
            raise ConfigError("option config is missing: the path of a configuration file")
        return catalog_of(self.options["config"])

    def _spec(self) -> TableSpec:
        catalog = self._catalog()
        name = self.TABLE or self.options.get("table")
        if not name:
            raise ConfigError(f"option table is missing; there are: {', '.join(catalog.names())}")
        spec = catalog.table(name)
        if spec.kind == "exploded":
            raise ConfigError(f"table {name} is an exploded one; read it through the engine, or explode {spec.parent.name}")
        return spec

    def schema(self):
        return self.options["_schema"] if "_schema" in self.options else self._spec().struct

    def _check(self, schema: StructType) -> None:
        if "_schema" in self.options:
            return
        ours = self._spec().struct
        if [(f.name, f.dataType) for f in schema] != [(f.name, f.dataType) for f in ours]:
            raise ConfigError("a schema can't be given: it comes from the API description")

    def reader(self, schema: StructType) -> RestReader:
        self._check(schema)
        catalog = self._catalog()
        return RestReader(catalog.source, catalog.base_url, self._spec(), dict(self.options))

    def streamReader(self, schema: StructType) -> RestStreamReader:
        catalog, spec = self._catalog(), self._spec()
        check_streams(spec)
        return RestStreamReader(catalog.source, catalog.base_url, spec, dict(self.options))
