"""JSON pointers (RFC 6901)."""

from __future__ import annotations

from typing import Any

MISSING = object()


def parts(pointer: str) -> list[str]:
    """The reference tokens of a pointer; '' is the whole document."""
    if pointer == "":
        return []
    if not pointer.startswith("/"):
        raise ValueError(f"a JSON pointer begins with '/': {pointer!r}")
    return [p.replace("~1", "/").replace("~0", "~") for p in pointer[1:].split("/")]


def get(value: Any, pointer: str | list[str]) -> Any:
    """What a pointer finds, or MISSING."""
    for p in parts(pointer) if isinstance(pointer, str) else pointer:
        if isinstance(value, dict):
            value = value.get(p, MISSING)
        elif isinstance(value, list) and p.isdigit() and (p == "0" or p[0] != "0") and int(p) < len(value):
            value = value[int(p)]
        else:
            return MISSING
        if value is MISSING:
            return MISSING
    return value


def records(body: Any, pointer: str | None) -> list:
    """The records of a page: a top-level array or the single value; with a pointer, the array there or nothing."""
    if pointer is None:
        return body if isinstance(body, list) else [body]
    found = get(body, pointer)
    return found if isinstance(found, list) else []
