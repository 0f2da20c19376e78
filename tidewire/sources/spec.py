"""API descriptions: OpenAPI 3.0, 3.1 and Swagger 2.0 to the endpoints that can be read."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import time
import urllib.request
from dataclasses import dataclass
from typing import Any

from ..errors import SpecError
from ..functions.schema import Type, of_spec
from .config import SpecCache

_VERSION = 1
_NDJSON = ("application/x-ndjson", "application/ndjson", "application/jsonl", "application/x-jsonlines", "application/json-lines")


@dataclass(frozen=True)
class Endpoint:
    """A GET path, its query parameters, and the types of what it returns.

    body: of a JSON response, with whether it is a top-level array; lines: of an NDJSON line; offered: the media types.
    """

    path: str
    operation: str | None
    params: tuple[str, ...]
    body: Type | None
    is_array: bool
    lines: Type | None
    offered: tuple[str, ...]


@dataclass(frozen=True)
class Spec:
    base_url: str
    endpoints: tuple[Endpoint, ...]


def _resolve(node: Any, root: dict, open_: tuple[str, ...] = ()) -> Any:
    """The node with local references followed; one that leads back to itself stays."""
    if isinstance(node, list):
        return [_resolve(x, root, open_) for x in node]
    if not isinstance(node, dict):
        return node
    ref = node.get("$ref")
    if isinstance(ref, str) and ref.startswith("#/"):
        if ref in open_ or len(open_) > 30:
            return {"$ref": ref}
        found: Any = root
        for part in ref[2:].split("/"):
            part = part.replace("~1", "/").replace("~0", "~")
            if not isinstance(found, dict) or part not in found:
                raise SpecError(f"the reference {ref} leads nowhere")
            found = found[part]
        return _resolve(found, root, (*open_, ref))
    return {k: _resolve(v, root, open_) for k, v in node.items()}


def _media(content: dict) -> tuple[dict | None, dict | None]:
    """Schemas of the JSON and the NDJSON media type, of those that have one."""
    typed = {str(k).lower(): v["schema"] for k, v in content.items() if isinstance(v, dict) and isinstance(v.get("schema"), dict)}
    bare = {k: k.split(";")[0].strip() for k in typed}
    for test in (lambda k: k == "application/json", lambda k: bare[k] == "application/json", lambda k: bare[k].endswith("+json"), lambda k: k == "*/*"):
        body = next((typed[k] for k in typed if test(k)), None)
        if body is not None:
            break
    return body, next((typed[k] for k in typed if bare[k] in _NDJSON), None)


def parse(root: Any) -> Spec:
    if not isinstance(root, dict) or not isinstance(root.get("paths"), dict):
        raise SpecError("the API description has no paths")
    swagger = str(root.get("swagger", "")).startswith("2")
    if not swagger and not str(root.get("openapi", "")).startswith("3"):
        raise SpecError("expected an OpenAPI 3 or Swagger 2.0 description")
    if swagger:
        host, schemes = root.get("host"), root.get("schemes") or ["https"]
        base = f"{schemes[0]}://{host}{root.get('basePath') or ''}".rstrip("/") if host else str(root.get("basePath") or "").rstrip("/")
    else:
        servers = root.get("servers") or []
        base = str(servers[0].get("url", "")).rstrip("/") if servers else ""
    out = []
    for path, item in root["paths"].items():
        item = _resolve(item, root) if isinstance(item, dict) and "$ref" in item else item
        get = item.get("get") if isinstance(item, dict) else None
        if not isinstance(get, dict):
            continue
        params = [_resolve(p, root) for p in [*(item.get("parameters") or []), *(get.get("parameters") or [])]]
        responses = get.get("responses") or {}
        response = responses.get("200", responses.get(200, responses.get("default")))
        response = _resolve(response, root) if response is not None else {}
        if swagger:
            kinds = get.get("produces") or root.get("produces") or ["application/json"]
            content = {k: {"schema": response["schema"]} if "schema" in response else {} for k in kinds}
        else:
            content = response.get("content") or {}
        body, lines = _media(content)
        typed = None if body is None else of_spec(body)
        is_array = typed is not None and typed.kind == "array"
        record = typed.items if is_array else typed
        if record is None or record.kind != "object":
            record = None
        line = None if lines is None else of_spec(lines)
        out.append(Endpoint(str(path), get.get("operationId"), tuple(str(p.get("name")) for p in params if isinstance(p, dict) and p.get("in") == "query"), record, is_array, line if line is not None and line.kind == "object" else None, tuple(map(str, content))))
    return Spec(base, tuple(out))


def parse_text(text: str) -> Any:
    try:
        return json.loads(text)
    except ValueError:
        pass
    try:
        import yaml
    except ImportError:
        raise SpecError("the API description isn't JSON, and no YAML library is installed") from None
    try:
        return yaml.load(text, getattr(yaml, "CSafeLoader", yaml.SafeLoader))
    except yaml.YAMLError as error:
        raise SpecError(f"the API description is neither JSON nor YAML: {error}") from None


def _fetch(location: str, timeout: float, headers: dict[str, str] | None = None) -> tuple[int, str, dict[str, str]]:
    request = urllib.request.Request(location, headers=headers or {})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return r.status, r.read().decode("utf-8"), {k.lower(): v for k, v in r.headers.items()}
    except urllib.error.HTTPError as error:
        if error.code == 304:
            return 304, "", {}
        raise SpecError(f"{location}: HTTP {error.code}") from None
    except OSError as error:
        raise SpecError(f"{location}: {error}") from None


def _remote(location: str) -> bool:
    return location.lower().startswith(("http://", "https://"))


def read(location: str, cache: SpecCache = SpecCache(enabled=False), timeout: float = 30.0) -> Spec:
    """The description at a path or URL; a parsed copy is kept on disk, keyed by the hash of the location.

    It is used while younger than the cache's ttl; without one, while the file's time or the server's validators agree.
    """
    location = location.removeprefix("file://")
    kept = None
    if cache.enabled:
        folder = cache.directory or os.path.join(tempfile.gettempdir(), "tidewire-specs")
        path = os.path.join(folder, hashlib.sha256(location.encode()).hexdigest() + ".json")
        try:
            with open(path, encoding="utf-8") as f:
                kept = json.load(f)
            if kept.get("version") != _VERSION:
                kept = None
        except (OSError, ValueError):
            kept = None
    headers: dict[str, str] = {}
    mark: Any = None
    if not _remote(location):
        try:
            mark = os.stat(location).st_mtime_ns
        except OSError as error:
            raise SpecError(f"{location}: can't be read: {error.strerror}") from None
    if kept is not None:
        if cache.ttl is not None:
            if time.time() - kept["at"] < cache.ttl:
                return parse(kept["spec"])
        elif mark is not None:
            if kept["mark"] == mark:
                return parse(kept["spec"])
        else:
            headers = {h: kept[k] for h, k in (("If-None-Match", "etag"), ("If-Modified-Since", "modified")) if kept.get(k)}
    if _remote(location):
        status, text, got = _fetch(location, timeout, headers)
        if status == 304 and kept is not None:
            return parse(kept["spec"])
    else:
        with open(location, encoding="utf-8") as f:
            text, got = f.read(), {}
    root = parse_text(text)
    out = parse(root)
    if cache.enabled:
        try:
            os.makedirs(folder, exist_ok=True)
            with tempfile.NamedTemporaryFile("w", dir=folder, delete=False, encoding="utf-8") as f:
                json.dump({"version": _VERSION, "at": time.time(), "mark": mark, "etag": got.get("etag"), "modified": got.get("last-modified"), "spec": json.loads(json.dumps(root, default=str))}, f)
            os.replace(f.name, path)
        except OSError:
            pass  # without a cache it is slower only
    return out
