"""HTTP: credentials, retries, rate limits, compression, a response cache."""

from __future__ import annotations

import base64
import collections
import email.utils
import hashlib
import http.client
import json
import threading
import time
import urllib.parse
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from ..errors import ApiError, EngineError
from ..functions.columnar import PageReader
from .config import Auth, Http

_RETRIED = (http.client.HTTPException, ConnectionError, TimeoutError, OSError)


class RateLimiter:
    """Permits at a fixed spacing, without bursts."""

    def __init__(self, per_second: float | None, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap, self.clock, self.sleep, self.next = (1.0 / per_second if per_second else 0.0), clock, sleep, 0.0

    def take(self) -> None:
        if self.gap:
            now = self.clock()
            at = max(now, self.next)
            self.next = at + self.gap
            if at > now:
                self.sleep(at - now)


class ResponseCache:
    """The bodies of successful responses, least recently used ones dropped, for a time."""

    def __init__(self, entries: int, ttl: float, clock: Callable[[], float] = time.monotonic):
        self.entries, self.ttl, self.clock, self.lock = entries, ttl, clock, threading.Lock()
        self.kept: collections.OrderedDict[str, tuple[float, bytes, dict[str, str]]] = collections.OrderedDict()

    def get(self, key: str) -> tuple[bytes, dict[str, str]] | None:
        with self.lock:
            found = self.kept.get(key)
            if found is None or self.clock() - found[0] > self.ttl:
                self.kept.pop(key, None)
                return None
            self.kept.move_to_end(key)
            return found[1:]

    def put(self, key: str, body: bytes, headers: dict[str, str]) -> None:
        with self.lock:
            self.kept[key] = (self.clock(), body, headers)
            self.kept.move_to_end(key)
            while len(self.kept) > self.entries:
                self.kept.popitem(last=False)


#: By (entries, ttl): shared by all reads of a worker process.
_CACHES: dict[tuple[int, float], ResponseCache] = {}


class Token:
    """An OAuth2 client-credentials token, refreshed a minute before it ends, by one thread at a time."""

    def __init__(self, auth: Auth, timeout: float):
        self.auth, self.timeout, self.lock, self.value, self.until = auth, timeout, threading.Lock(), auth.token, float("inf") if auth.token else 0.0
        self.static = bool(auth.token)

    def get(self) -> str:
        with self.lock:
            if not self.value or time.time() >= self.until - 60:
                self._fetch()
            return self.value

    def drop(self, used: str) -> None:
        with self.lock:
            if self.value == used:
                self.value = None

    def _fetch(self) -> None:
        form = urllib.parse.urlencode({"grant_type": "client_credentials", "client_id": self.auth.client_id, "client_secret": self.auth.client_secret}).encode()
        status, reason, headers, body = _send("POST", self.auth.token_url, {"Content-Type": "application/x-www-form-urlencoded", "Accept": "application/json"}, self.timeout, form)
        if status != 200:
            raise ApiError("POST", self.auth.token_url, status, reason, headers, body)
        got = json.loads(body)
        if not isinstance(got, dict) or not got.get("access_token"):
            raise EngineError("the token endpoint's answer has no access_token")
        self.value, self.until = str(got["access_token"]), time.time() + float(got.get("expires_in") or 3600)


def _connect(url: str, timeout: float) -> tuple[http.client.HTTPConnection, str]:
    x = urllib.parse.urlsplit(url)
    if x.scheme not in ("http", "https") or not x.hostname:
        raise EngineError(f"{url!r} isn't an http or https URL; set base-url")
    kind = http.client.HTTPSConnection if x.scheme == "https" else http.client.HTTPConnection
    # the path goes out as it is: no dots or escapes are changed
    at = url.find("/", len(x.scheme) + 3)
    target = url[at:].partition("#")[0] if at >= 0 else "/"
    return kind(x.hostname, x.port, timeout=timeout), target if target.startswith("/") else "/" + target


def _send(method: str, url: str, headers: dict[str, str], timeout: float, body: bytes | None = None) -> tuple[int, str, dict[str, str], bytes]:
    connection, target = _connect(url, timeout)
    try:
        connection.request(method, target, body, headers)
        response = connection.getresponse()
        found = {k.lower(): v for k, v in response.getheaders()}
        return response.status, response.reason, found, _inflate(response.read(), found)
    finally:
        connection.close()


def _inflate(body: bytes, headers: dict[str, str]) -> bytes:
    kind = headers.get("content-encoding", "").strip().lower()
    if kind in ("gzip", "x-gzip"):
        return zlib.decompress(body, 31)
    if kind == "deflate":
        try:
            return zlib.decompress(body)
        except zlib.error:
            return zlib.decompress(body, -15)
    return body


def origin(url: str) -> tuple[str, str, int]:
    x = urllib.parse.urlsplit(url)
    return x.scheme.lower(), (x.hostname or "").lower(), x.port or (443 if x.scheme.lower() == "https" else 80)


def query(params: dict[str, str]) -> str:
    return urllib.parse.urlencode(params, quote_via=urllib.parse.quote, safe="")


@dataclass
class Response:
    url: str
    body: bytes
    headers: dict[str, str]


class Client:
    """GET requests under one source's settings. rate: this client's share of the rate limit."""

    def __init__(self, settings: Http, auth: Auth = Auth(), base_url: str = "", rate: float | None = None, sleep: Callable[[float], None] = time.sleep):
        self.settings, self.auth, self.base, self.sleep = settings, auth, base_url.rstrip("/"), sleep
        self.exact = True  # whether numbers keep their source text
        self.columns: PageReader | None = None  # reads pages as columns, where it can
        self.limiter = RateLimiter(rate if rate is not None else settings.rate_limit, sleep=sleep)
        self.token = Token(auth, settings.timeout) if auth.type == "oauth2" else None
        self.connections: dict[tuple[str, str, int], http.client.HTTPConnection] = {}
        self.cache = _CACHES.setdefault((settings.cache_entries, settings.cache_ttl), ResponseCache(settings.cache_entries, settings.cache_ttl)) if settings.cache else None

    def headers(self) -> tuple[dict[str, str], str | None]:
        out = {"Accept": {"ndjson": "application/x-ndjson, application/json", "sse": "text/event-stream"}.get(self.settings.response_format, "application/json"), "User-Agent": "tidewire"}
        out["Accept-Encoding"] = "gzip, deflate" if self.settings.compression else "identity"
        used = None
        a = self.auth
        if a.type == "bearer":
            out["Authorization"] = f"Bearer {a.token}"
        elif a.type == "basic":
            out["Authorization"] = "Basic " + base64.b64encode(f"{a.username}:{a.password}".encode()).decode()
        elif a.type == "header":
            out[a.header_name] = a.header_value
        elif self.token is not None:
            used = self.token.get()
            out["Authorization"] = f"Bearer {used}"
        return out, used

    def url(self, path: str, params: dict[str, str]) -> str:
        head = path if path.lower().startswith(("http://", "https://")) else self.base + (path if path.startswith("/") else "/" + path)
        return head + (("&" if "?" in head else "?") + query(params) if params else "")

    def _wait(self, attempt: int, headers: dict[str, str] | None) -> None:
        pause = min(2.0**attempt, self.settings.max_backoff)
        after = (headers or {}).get("retry-after", "").strip()
        if after.isdigit():
            pause = float(after)
        elif after:
            try:
                pause = max(0.0, email.utils.parsedate_to_datetime(after).timestamp() - time.time())
            except (TypeError, ValueError):
                pass
        self.sleep(pause)

    def _open(self, url: str) -> http.client.HTTPResponse:
        """A response whose body isn't read yet; failures that may pass are tried again."""
        attempt, refreshed = 0, False
        while True:
            self.limiter.take()
            headers, used = self.headers()
            key = origin(url)
            fresh, target = _connect(url, self.settings.timeout)
            connection = self.connections.setdefault(key, fresh)
            problem: Exception | None = None
            try:
                connection.request("GET", target, headers=headers)
                response = connection.getresponse()
            except _RETRIED as error:
                connection.close()
                self.connections.pop(key, None)
                problem, response = error, None
            if response is not None:
                if response.status < 400:
                    if response.status >= 300:
                        response.read()
                        raise ApiError("GET", url, response.status, response.reason, dict(response.getheaders()), b"redirects aren't followed")
                    return response
                found = {k.lower(): v for k, v in response.getheaders()}
                body = _inflate(response.read(), found)
                if response.status == 401 and self.token is not None and not self.token.static and not refreshed:
                    refreshed = True
                    self.token.drop(used)
                    continue
                problem = ApiError("GET", url, response.status, response.reason, found, body)
                if response.status != 429 and response.status < 500:
                    raise problem
                if attempt < self.settings.max_retries:
                    self._wait(attempt, found)
            elif attempt < self.settings.max_retries:
                self._wait(attempt, None)
            if attempt >= self.settings.max_retries:
                if isinstance(problem, ApiError):
                    raise problem
                raise EngineError(f"GET {url.partition('?')[0]} failed: {type(problem).__name__}: {problem}")
            attempt += 1

    def get(self, url: str) -> Response:
        """A whole response."""
        key = ""
        if self.cache is not None:
            base, _, q = url.partition("?")
            who = hashlib.sha256(repr(self.auth).encode()).hexdigest()
            key = f"{origin(url)}|{who}|{base}|{'&'.join(sorted(q.split('&')))}"
            if (kept := self.cache.get(key)) is not None:
                return Response(url, *kept)
        for attempt in range(self.settings.max_retries + 1):
            response = self._open(url)
            headers = {k.lower(): v for k, v in response.getheaders()}
            try:
                body = _inflate(response.read(), headers)
                break
            except _RETRIED as error:
                self.connections.pop(origin(url), None)
                if attempt >= self.settings.max_retries:
                    raise EngineError(f"GET {url.partition('?')[0]} failed: {type(error).__name__}: {error}") from None
                self._wait(attempt, None)
        if self.cache is not None:
            self.cache.put(key, body, headers)
        return Response(url, body, headers)

    def lines(self, url: str) -> Iterator[str]:
        """The lines of a response as they arrive; tried again only while none has been given out."""
        attempt = 0
        while True:
            response = self._open(url)
            kind = (response.getheader("Content-Encoding") or "").lower()
            inflate = zlib.decompressobj(31 if "gzip" in kind else 15) if kind and kind != "identity" else None
            given, rest = False, b""
            try:
                while chunk := response.read1(1 << 16):
                    rest += inflate.decompress(chunk) if inflate else chunk
                    *whole, rest = rest.split(b"\n")
                    for line in whole:
                        given = True
                        yield line.decode("utf-8").removesuffix("\r")
                if response.length:
                    raise http.client.IncompleteRead(b"", response.length)
                if rest:
                    yield rest.decode("utf-8").removesuffix("\r")
                return
            except _RETRIED as error:
                self.connections.pop(origin(url), None)
                if given or attempt >= self.settings.max_retries:
                    raise EngineError(f"GET {url.partition('?')[0]} broke off: {type(error).__name__}: {error}") from None
                self._wait(attempt, None)
                attempt += 1

    def close(self) -> None:
        for connection in self.connections.values():
            connection.close()
        self.connections.clear()


def close_quietly(client: Client) -> None:
    try:
        client.close()
    except OSError:
        pass
