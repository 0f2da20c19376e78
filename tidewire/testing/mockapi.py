"""A threaded HTTP server that serves parquet tables as a paginated JSON API.

Rows are read from disk and rendered to JSON as they are asked for, a batch at a time. Every request is logged.
"""

from __future__ import annotations

import json
import math
import re
import threading
import zlib
from collections import OrderedDict
from collections.abc import Iterable, Iterator, Sequence
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from typing import Any
from urllib.parse import parse_qsl, unquote, urlsplit

import pyarrow as pa
import pyarrow.compute as pc

from .stored import Stored

_TYPES = {"int32": ("integer", "int32"), "int64": ("integer", "int64"), "double": ("number", None), "float": ("number", None), "string": ("string", None), "large_string": ("string", None)}
_CURSORS = 8
_COUNTS = 256


def _cells(col: pa.Array) -> pa.Array:
    kind = col.type
    if pa.types.is_timestamp(kind):
        texts = pc.replace_substring(pc.cast(pc.cast(col, pa.timestamp("us")), pa.string()), " ", "T")
        texts = pc.replace_substring_regex(texts, r"\.000000$", "")
        return pc.binary_join_element_wise('"', texts, 'Z"', "")
    if pa.types.is_integer(kind) or pa.types.is_boolean(kind):
        return pc.cast(col, pa.string())
    if pa.types.is_floating(kind):
        texts = pc.cast(col, pa.string())
        return pc.if_else(pc.match_substring_regex(texts, "^-?[0-9]+$"), pc.binary_join_element_wise(texts, ".0", ""), texts)
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        texts = pc.cast(col, pa.string())
        if not pc.any(pc.match_substring_regex(texts, r"[\x00-\x1f]")).as_py():
            texts = pc.replace_substring(pc.replace_substring(texts, "\\", "\\\\"), '"', '\\"')
            return pc.binary_join_element_wise('"', texts, '"', "")
    return pa.array([None if v is None else json.dumps(v, ensure_ascii=False) for v in col.to_pylist()], pa.string())


def render(rows: pa.RecordBatch | pa.Table) -> pa.Array:
    """Each row as a JSON object; timestamps as ISO instants."""
    parts: list[Any] = []
    for name, col in zip(rows.schema.names, rows.columns):
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        parts += [(", " if parts else "{") + json.dumps(name) + ": ", pc.fill_null(_cells(col), "null")]
    return pc.binary_join_element_wise(*parts, "}", "")


def join(rows: Iterable[pa.RecordBatch | pa.Table], between: str = ", ") -> bytes:
    """The rows as JSON with a text between them."""
    return between.encode().join(_joined(r, between) for r in rows if r.num_rows)


def _joined(rows: pa.RecordBatch | pa.Table, between: str) -> bytes:
    texts = render(rows)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), between)[0].as_buffer().to_pybytes()


def schema_of(schema: pa.Schema) -> dict:
    props: dict[str, Any] = {}
    for f in schema:
        if pa.types.is_timestamp(f.type):
            props[f.name] = {"type": "string", "format": "date-time"}
        else:
            kind, fmt = _TYPES.get(str(f.type), ("string", None))
            props[f.name] = {"type": kind} | ({"format": fmt} if fmt else {})
    return {"type": "object", "properties": props}


class Rows(Sequence):
    """A resource's rows as JSON, none of them held."""

    def __init__(self, resource: "Resource"):
        self.resource = resource

    def __len__(self) -> int:
        return self.resource.stored.num_rows

    def __iter__(self) -> Iterator[str]:
        for b in self.resource.cut({}, 0, len(self)):
            yield from render(b).to_pylist()

    def __getitem__(self, at: int | slice) -> Any:
        asked = range(len(self))[at]
        if isinstance(at, slice):
            if asked.step != 1:
                return [self[i] for i in asked]
            return [x for b in self.resource.cut({}, asked.start, asked.stop) for x in render(b).to_pylist()]
        return self[asked : asked + 1][0]


class Resource:
    """A table's rows, and filters on its columns."""

    def __init__(self, path: str, order: str, time: str | None = None, enums: dict[str, str] | None = None, keyed: bool = False):
        self.stored = Stored(path, order, keyed)
        self.path, self.schema = path, self.stored.schema
        self.order, self.time, self.enums = order, time, enums or {}
        self.rows = Rows(self)
        self._lock = threading.Lock()
        self._counts: OrderedDict[tuple, list[int]] = OrderedDict()
        # where reads of a page ended, so that the next page goes on from there
        self._cursors: OrderedDict[tuple, tuple[pa.RecordBatch | None, Iterator[pa.RecordBatch]]] = OrderedDict()

    @property
    def table(self) -> pa.Table:
        """All rows, read anew each time."""
        return pa.Table.from_batches(self.stored.batches(), self.schema)

    def _wanted(self, params: dict[str, str]) -> tuple:
        return tuple(sorted((k, v) for k, v in params.items() if k in self.enums or k in ("since", "until", "ids")))

    def _column(self, param: str) -> str:
        return self.enums.get(param) or (self.time if param in ("since", "until") and self.time else self.order)

    def _mask(self, rows: pa.RecordBatch, wanted: tuple) -> pa.Array:
        mask = None
        for k, v in wanted:
            col = rows.column(self._column(k))
            values: Any = v
            if pa.types.is_timestamp(col.type):
                values = pa.scalar(v.rstrip("Z")).cast(pa.timestamp("us")).cast(col.type)
            elif k != "ids":
                values = pa.scalar(v).cast(col.type)
            if k == "ids":
                test = pc.is_in(col, pa.array(v.split(",")).cast(col.type))
            else:
                ops = {"since": pc.greater_equal, "until": pc.less, "min": pc.greater_equal, "max": pc.less_equal, "over": pc.greater, "under": pc.less, "not": pc.not_equal}
                test = ops.get(k.partition("_")[0], pc.equal)(col, values)
            mask = test if mask is None else pc.and_(mask, test)
        return mask

    def counts(self, wanted: tuple) -> list[int]:
        """The rows that pass, by row group."""
        groups = self.stored.groups
        if not wanted:
            return [n for _, _, n in groups]
        with self._lock:
            if wanted not in self._counts:
                names = sorted({self._column(k) for k, _ in wanted})
                self._counts[wanted] = [sum(pc.sum(self._mask(b, wanted)).as_py() or 0 for b in self.stored.group(g, names)) for g in range(len(groups))]
                while len(self._counts) > _COUNTS:
                    self._counts.popitem(last=False)
            return self._counts[wanted]

    def _from(self, wanted: tuple, lo: int) -> Iterator[pa.RecordBatch]:
        first, skip = 0, lo
        for n in self.counts(wanted):
            if skip < n:
                break
            first, skip = first + 1, skip - n
        for b in self.stored.batches(first):
            if wanted:
                b = b.filter(self._mask(b, wanted))
            if skip < b.num_rows:
                yield b.slice(skip)
            skip = max(0, skip - b.num_rows)

    def cut(self, params: dict[str, str], lo: int, hi: int) -> Iterator[pa.RecordBatch]:
        """Rows lo to hi of those that pass."""
        wanted = self._wanted(params)
        with self._lock:
            left, rest = self._cursors.pop((wanted, lo), (None, None))
        if rest is None:
            rest = self._from(wanted, lo)
        while lo < hi:
            b = next(rest, None) if left is None else left
            if b is None:
                return
            n = min(b.num_rows, hi - lo)
            left = b.slice(n) if n < b.num_rows else None
            lo += n
            yield b.slice(0, n)
        with self._lock:
            self._cursors[wanted, lo] = (left, rest)
            while len(self._cursors) > _CURSORS:
                self._cursors.popitem(last=False)

    def page(self, params: dict[str, str], lo: int, hi: int) -> tuple[bytes, int]:
        """Rows lo to hi that pass, joined, and the number of all that pass."""
        return join(self.cut(params, lo, hi)), sum(self.counts(self._wanted(params)))

    def text(self, params: dict[str, str], lo: int, hi: int) -> tuple[str, int]:
        """The same as text."""
        found, total = self.page(params, lo, hi)
        return found.decode(), total

    def stats(self, params: dict[str, str]) -> dict[str, Any]:
        """The number of rows that pass, and a column's sum and mean over them."""
        wanted, column = self._wanted(params), params.get("column", self.order)
        n, held, sums = 0, 0, []
        for b in self.stored.batches(0, sorted({column, *(self._column(k) for k, _ in wanted)})):
            if wanted:
                b = b.filter(self._mask(b, wanted))
            col = b.column(column)
            n, held = n + len(col), held + len(col) - col.null_count
            if len(col) > col.null_count:
                sums.append(pc.sum(col).as_py())
        total = None if not held else math.fsum(sums) if pa.types.is_floating(self.schema.field(column).type) else sum(sums)
        return {"count": n, "sum": total, "avg": total / held if held else None}


class MockApi:
    """Serves resources, and fixed routes that tests add.

    ``/t?offset&limit`` gives {results, count}; ``/t.cursor?cursor&page_size`` {items, next}; ``/t.link?page`` an array
    with Link headers; ``/t.all`` an array; ``/t.ndjson`` lines; ``/t.sse`` events; ``/t/stats`` aggregates of a column;
    ``/t/{key}/u`` the rows of u whose foreign key it is, ``/u_by?ids=`` those of several keys; ``/t_with_u`` rows of t
    with an array of u's keys.
    """

    def __init__(self):
        self.resources: dict[str, Resource] = {}
        self.children: dict[str, tuple[str, str]] = {}  # u: (t, foreign key)
        self.arrays: dict[str, tuple[str, str, str]] = {}  # name: (t, u, foreign key)
        self.routes: dict[str, Any] = {}
        self.log: list[str] = []
        self.page_size, self.lock = 1000, threading.Lock()
        self.compress = False  # whether large bodies go out in gzip to clients that take it
        self._by_key: dict[tuple[str, str], Resource] = {}
        self.server: ThreadingHTTPServer | None = None

    def add(self, name: str, path: str, order: str, time: str | None = None, enums: dict[str, str] | None = None) -> None:
        self.resources[name] = Resource(path, order, time, enums)

    def start(self) -> "MockApi":
        api = self

        class Handler(BaseHTTPRequestHandler):
            protocol_version = "HTTP/1.1"
            disable_nagle_algorithm = True
            wbufsize = 1 << 16

            def log_message(self, *args):
                pass

            def do_GET(self):
                api._serve(self)

            do_POST = do_GET

        ThreadingHTTPServer.daemon_threads = True
        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        return self

    @property
    def url(self) -> str:
        return f"http://127.0.0.1:{self.server.server_address[1]}"

    def stop(self) -> None:
        self.server.shutdown()
        self.server.server_close()

    def requests(self, part: str = "") -> list[str]:
        with self.lock:
            return [x for x in self.log if part in x]

    def clear(self) -> None:
        with self.lock:
            self.log.clear()

    def _serve(self, h: BaseHTTPRequestHandler) -> None:
        x = urlsplit(h.path)
        params = dict(parse_qsl(x.query, keep_blank_values=True))
        with self.lock:
            self.log.append(h.path)
        length = int(h.headers.get("Content-Length") or 0)
        sent = h.rfile.read(length) if length else b""
        route = self.routes.get(x.path)
        status, headers, body = 200, {"Content-Type": "application/json"}, b""
        if route is not None:
            got = route(params, dict(h.headers), sent) if callable(route) else route
            if isinstance(got, tuple):
                status, more, got = got
                headers |= more
            body = got if isinstance(got, bytes) else got.encode() if isinstance(got, str) else json.dumps(got).encode()
        else:
            found = self._resource(x.path, params)
            if found is None:
                status, body = 404, b'{"message": "no such path"}'
            else:
                headers |= found[0]
                body = found[1]
        packed = self.compress and "gzip" in (h.headers.get("Accept-Encoding") or "") and "stream" not in headers["Content-Type"]
        if isinstance(body, bytes) and packed and len(body) > 1 << 20 or not isinstance(body, bytes) and packed:
            headers["Content-Encoding"] = "gzip"
            body = b"".join(_gzip([body])) if isinstance(body, bytes) else _gzip(body)
        h.send_response(status)
        for k, v in headers.items():
            h.send_header(k, v)
        h.send_header(*(("Content-Length", str(len(body))) if isinstance(body, bytes) else ("Transfer-Encoding", "chunked")))
        h.end_headers()
        try:
            if isinstance(body, bytes):
                h.wfile.write(body)
                return
            for part in body:
                if part:
                    h.wfile.write(b"%x\r\n" % len(part) + part + b"\r\n")
            h.wfile.write(b"0\r\n\r\n")
        except (BrokenPipeError, ConnectionResetError):
            h.close_connection = True

    def keyed(self, name: str, column: str) -> Resource:
        """A table's rows by a column that isn't its key."""
        with self.lock:
            if (name, column) not in self._by_key:
                # the path as read: a thread that serves a request has no Spark session to copy from a store with
                self._by_key[name, column] = Resource(self.resources[name].stored.path, column, keyed=True)
            return self._by_key[name, column]

    def _children(self, name: str, keys: list[int]) -> bytes:
        """The child rows of keys, in the keys' order."""
        column = self.children[name][1]
        out: dict[int, list[str]] = {k: [] for k in keys}
        for t in self.keyed(name, column).stored.where(out):
            for k, text in zip(t[column].to_pylist(), render(t).to_pylist()):
                out[k].append(text)
        return ("[" + ", ".join(x for texts in out.values() for x in texts) + "]").encode()

    def _resource(self, path: str, params: dict[str, str]) -> tuple[dict, bytes | Iterator[bytes]] | None:
        parts = path.strip("/").split("/")
        name, _, style = parts[0].partition(".")
        if len(parts) == 3 and parts[2] in self.children and self.children[parts[2]][0] == name:
            return {}, self._children(parts[2], [int(unquote(parts[1]))])
        if len(parts) == 1 and name.endswith("_by") and name[:-3] in self.children:
            return {}, self._children(name[:-3], [int(k) for k in params.get("ids", "").split(",") if k])
        if name in self.arrays and len(parts) == 1:
            lo, n = int(params.get("offset", 0)), int(params.get("limit", self.page_size))
            return {}, b'{"results": [%b], "count": %d}' % (self._arrays(name, lo, lo + n), len(self.resources[self.arrays[name][0]].rows))
        r = self.resources.get(name)
        if r is None:
            return None
        if len(parts) == 2 and parts[1] == "stats":
            return {}, json.dumps(r.stats(params)).encode()
        if len(parts) != 1:
            return None
        if style == "all":
            return {}, self._whole(r, params, b"[", b", ", b"]")
        if style == "ndjson":
            return {"Content-Type": "application/x-ndjson"}, self._whole(r, {}, b"", b"\n", b"\n")
        if style == "sse":
            return {"Content-Type": "text/event-stream"}, self._whole(r, {}, b": row\nevent: row\ndata: ", b"\n\n: row\nevent: row\ndata: ", b"\n\n")
        if style == "cursor":
            lo = int(re.sub(r"\D", "", params.get("cursor", "")) or 0)
            n = min(int(params.get("page_size", self.page_size)), self.page_size)
            found, total = r.page(params, lo, lo + n)
            after = f"c{lo + n}" if lo + n < total else ""
            return {}, b'{"items": [%b], "next": "%b"}' % (found, after.encode())
        if style == "link":
            page, n = int(params.get("page", 1)), min(int(params.get("per_page", self.page_size)), self.page_size)
            found, total = r.page(params, (page - 1) * n, page * n)
            link = {"Link": f'</{name}.link?page={page + 1}&per_page={n}>; rel="next", </{name}.link?page=1>; rel="first"'} if page * n < total else {}
            return link, b"[%b]" % found
        lo, n = int(params.get("offset", 0)), min(int(params.get("limit", self.page_size)), self.page_size)
        found, total = r.page(params, lo, lo + n)
        return {}, b'{"results": [%b], "count": %d}' % (found, total)

    def _whole(self, r: Resource, params: dict[str, str], before: bytes, between: bytes, after: bytes) -> Iterator[bytes]:
        """All rows that pass, in parts."""
        lead = before
        for b in r.cut(params, 0, len(r.rows)):
            if b.num_rows:
                yield lead + join([b], between.decode())
                lead = between
        if lead is before:
            yield before if before == b"[" else b""
        yield after if lead is between or before == b"[" else b""

    def _arrays(self, name: str, lo: int, hi: int) -> bytes:
        """Rows lo to hi of a parent with their children's keys; every third has none."""
        parent, child, fk = self.arrays[name]
        p, c, out = self.resources[parent], self.resources[child], []
        for b in p.cut({}, lo, hi):
            keys: dict[Any, list[Any]] = {k: [] for k in b.column(p.order).to_pylist()}
            for t in self.keyed(child, fk).stored.where(k for k in keys if k % 3):
                for k, x in zip(t[fk].to_pylist(), t[c.order].to_pylist()):
                    keys[k].append(x)
            out += [f'{row[:-1]}, "{child}_keys": {json.dumps(keys[k])}}}' for row, k in zip(render(b).to_pylist(), b.column(p.order).to_pylist())]
        return ", ".join(out).encode()


def _gzip(parts: Iterable[bytes]) -> Iterator[bytes]:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    for part in parts:
        yield packer.compress(part)
    yield packer.flush()


def describe(api: MockApi) -> dict:
    """The API's own description, in OpenAPI 3."""
    paths: dict[str, Any] = {}

    def get(path: str, operation: str, schema: Any, media: str = "application/json") -> None:
        paths[path] = {"get": {"operationId": operation, "responses": {"200": {"description": "rows", "content": {media: {"schema": schema}}}}}}

    for name, r in api.resources.items():
        row = {"$ref": f"#/components/schemas/{name}"}
        get(f"/{name}", f"{name}_pages", {"type": "object", "properties": {"results": {"type": "array", "items": row}, "count": {"type": "integer"}}})
        get(f"/{name}.cursor", f"{name}_cursor", {"type": "object", "properties": {"items": {"type": "array", "items": row}, "next": {"type": "string"}}})
        get(f"/{name}.link", f"{name}_link", {"type": "array", "items": row})
        get(f"/{name}.all", f"{name}_all", {"type": "array", "items": row})
        get(f"/{name}.sse", f"{name}_sse", row)
        get(f"/{name}.ndjson", f"{name}_lines", row, "application/x-ndjson")
    for child, (parent, _) in api.children.items():
        row = {"type": "array", "items": {"$ref": f"#/components/schemas/{child}"}}
        get(f"/{parent}/{{id}}/{child}", f"{parent}_{child}", row)
        get(f"/{child}_by", f"{child}_by", row)
    for name, (parent, child, _) in api.arrays.items():
        props = dict(schema_of(api.resources[parent].schema)["properties"]) | {f"{child}_keys": {"type": "array", "items": {"type": "integer", "format": "int64"}}}
        get(f"/{name}", name, {"type": "object", "properties": {"results": {"type": "array", "items": {"type": "object", "properties": props}}}})
    return {"openapi": "3.0.3", "info": {"title": "rows", "version": "1"}, "servers": [{"url": api.url}], "paths": paths, "components": {"schemas": {n: schema_of(r.schema) for n, r in api.resources.items()}}}
