"""Pages of records: paging styles, and the streaming formats that have none."""

from __future__ import annotations

import json
import logging
import queue
import re
import threading
import urllib.parse
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa

from ..errors import EngineError
from ..functions import pointers
from ..functions.convert import loads
from .config import Pagination
from .http import Client, Response, origin

log = logging.getLogger("tidewire")


@dataclass
class Page:
    """The records of a page, values or columns, and the position to resume from. again: reads them once more, exactly."""

    records: list | pa.StructArray
    state: str | None = None
    again: Callable[[], list] | None = None


def _json(body: bytes, url: str, exact: bool = True) -> Any:
    try:
        return loads(body, exact)
    except ValueError as error:
        raise EngineError(f"GET {url.partition('?')[0]}: the response isn't JSON: {error}") from None


def next_link(header: str | None, url: str) -> str | None:
    """The rel="next" target of a Link header."""
    for target, attributes in re.findall(r"<([^>]*)>((?:\s*;\s*[^,;<]+)*)", header or ""):
        rel = re.search(r";\s*rel\s*=\s*(?:\"([^\"]*)\"|([^\s;,]+))", attributes, re.I)
        if rel and "next" in (rel[1] or rel[2]).lower().split():
            return urllib.parse.urljoin(url, target)
    return None


@dataclass
class Body:
    """A response read as columns, with the cursor that it holds, or as a value."""

    response: Response
    value: Any = None
    records: pa.StructArray | None = None
    cursor: str | None = None

    def find(self, data_path: str | None) -> list | pa.StructArray:
        return pointers.records(self.value, data_path) if self.records is None else self.records

    def page(self, client: Client, data_path: str | None, records: list | pa.StructArray, state: str | None = None) -> Page:
        if self.records is not None or client.exact:
            return Page(records, state)
        n = len(records)
        return Page(records, state, lambda: pointers.records(_json(self.response.body, self.response.url), data_path)[:n])


def _read(client: Client, url: str) -> Body:
    got = client.get(url)
    if client.columns is not None and (found := client.columns.read(got.body)) is not None:
        return Body(got, None, *found)
    return Body(got, _json(got.body, got.url, client.exact))


def _whole(text: str | None) -> int:
    return int(text) if text is not None and re.fullmatch(r"\d+", str(text)) else 0


def pages(client: Client, path: str, params: dict[str, str], paging: Pagination, data_path: str | None, limit: int | None = None, start: str | None = None, window: tuple[int, int] | None = None) -> Iterator[Page]:
    """Pages of an endpoint. start: a saved position. window: the offsets to read, the end excluded."""
    size_param = {paging.page_size_param: str(min(paging.max_page_size, limit) if limit else paging.max_page_size)} if paging.page_size_param else {}
    if paging.style == "none":
        body = _read(client, client.url(path, params))
        yield body.page(client, data_path, body.find(data_path))
        return
    if paging.style == "cursor":
        cursor, held = start or None, 0
        for _ in range(paging.max_pages):
            body = _read(client, client.url(path, params | size_param | ({paging.cursor_param: cursor} if cursor else {})))
            found = pointers.get(body.value, paging.cursor_path) if body.records is None else body.cursor
            after = found if isinstance(found, str) and found else None
            # the last page has no next cursor: the one that fetched it is saved, so that later records aren't missed
            page = body.page(client, data_path, body.find(data_path), after or cursor)
            held += len(page.records)
            yield page
            if after is None or limit and held >= limit:
                return
            cursor = after
        _cut_short(path, paging)
        return
    if paging.style == "link_header":
        url, held = client.url(path, params | size_param), 0
        home = origin(url)
        for _ in range(paging.max_pages):
            body = _read(client, url)
            page = body.page(client, data_path, body.find(data_path))
            held += len(page.records)
            yield page
            after = next_link(body.response.headers.get("link"), url)
            if after is None or limit and held >= limit:
                return
            if client.auth.type != "none" and origin(after) != home:
                raise EngineError(f"the next page's link leads to {urllib.parse.urlsplit(after).netloc}; credentials aren't sent to another origin")
            url = after
        _cut_short(path, paging)
        return
    yield from _offset(client, path, params, paging, data_path, limit, start, window)


def _offset(client: Client, path: str, params: dict[str, str], paging: Pagination, data_path: str | None, limit: int | None, start: str | None, window: tuple[int, int] | None) -> Iterator[Page]:
    results = paging.results_path if paging.results_path is not None else data_path
    at = window[0] if window else _whole(start) if start is not None else _whole(params.get(paging.offset_param))
    left = window[1] - window[0] if window else None
    if limit:
        left = limit if left is None else min(left, limit)
    for _ in range(paging.max_pages):
        if left is not None and left <= 0:
            return
        ask = paging.max_page_size if left is None else min(left, paging.max_page_size)
        mine = {paging.offset_param: str(at)} | ({paging.page_size_param: str(ask)} if paging.page_size_param else {})
        body = _read(client, client.url(path, params | mine))
        found = body.records if body.records is not None else body.value if results is None else pointers.get(body.value, results)
        if isinstance(found, (list, pa.StructArray)):
            held = len(found)
            if not held:
                return
            if left is not None and held > left:  # more than asked for: the rest belongs to the next window
                if body.records is None:
                    del found[left:]
                else:
                    body.records = found[:left]
                held = left
        elif results is not None:
            return
        else:
            held = ask  # nothing to count
        at += held
        if left is not None:
            left -= held
        yield body.page(client, data_path, body.find(data_path), str(at))
    if left is None or left > 0:
        _cut_short(path, paging)


def _cut_short(path: str, paging: Pagination) -> None:
    log.warning("%s: the read ended at max-pages (%d), and there may be more pages", path, paging.max_pages)


def lines(client: Client, path: str, params: dict[str, str], limit: int | None = None) -> Iterator[Any]:
    """Records of an NDJSON response, one per line."""
    url = client.url(path, params)
    for n, line in enumerate(x for x in client.lines(url) if x.strip()):
        if limit is not None and n >= limit:
            return
        try:
            yield loads(line)
        except ValueError as error:
            raise EngineError(f"GET {url.partition('?')[0]}: line {n + 1} isn't JSON: {error}") from None


def sse(texts: Iterator[str]) -> Iterator[str]:
    """The data of server-sent events."""
    data: list[str] = []
    for line in texts:
        if not line:
            if data:
                yield "\n".join(data)
            data = []
        elif not line.startswith(":"):
            name, _, value = line.partition(":")
            if name == "data":
                data.append(value.removeprefix(" "))
    if data:
        yield "\n".join(data)


def events(client: Client, path: str, params: dict[str, str], limit: int | None = None) -> Iterator[Any]:
    """Records of an SSE response, one per event with data."""
    url = client.url(path, params)
    for n, text in enumerate(sse(client.lines(url))):
        if limit is not None and n >= limit:
            return
        try:
            yield loads(text)
        except ValueError as error:
            raise EngineError(f"GET {url.partition('?')[0]}: event {n + 1} isn't JSON: {error}") from None


def fetch(client: Client, path: str, params: dict[str, str], paging: Pagination, data_path: str | None, limit: int | None = None, start: str | None = None, window: tuple[int, int] | None = None, batch: int = 4096) -> Iterator[Page]:
    """Pages in the client's response format; the streaming formats have no paging and no data path."""
    kind = client.settings.response_format
    if kind == "json":
        yield from pages(client, path, params, paging, data_path, limit, start, window)
        return
    rows: list = []
    for record in (lines if kind == "ndjson" else events)(client, path, params, limit):
        rows.append(record)
        if len(rows) >= batch:
            yield Page(rows)
            rows = []
    if rows:
        yield Page(rows)


def ahead(items: Iterator, depth: int) -> Iterator:
    """The same items, fetched by a thread up to ``depth`` ahead; leaving early stops it."""
    held: queue.Queue = queue.Queue(max(1, depth))
    stop = threading.Event()
    end = object()

    def put(x: Any) -> bool:
        while not stop.is_set():
            try:
                held.put(x, timeout=0.1)
                return True
            except queue.Full:
                pass
        return False

    def work() -> None:
        try:
            for x in items:
                if not put((x, None)):
                    return
            put((end, None))
        except BaseException as error:  # handed to the reader
            put((end, error))

    thread = threading.Thread(target=work, daemon=True)
    thread.start()
    try:
        while True:
            x, error = held.get()
            if error is not None:
                raise error
            if x is end:
                return
            yield x
    finally:
        stop.set()


def dump_state(kind: str, value: str) -> str:
    return json.dumps({"type": kind, "value": value})
