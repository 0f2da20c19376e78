"""Parent-child tables: child rows fetched for the keys of a parent table."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Any
from urllib.parse import quote

from ..functions import pointers
from ..functions.convert import compact
from ..sources.http import Client
from ..sources.paging import fetch
from ..sources.tables import TableSpec


def segment(key: str) -> str:
    """A key as one percent-encoded path segment."""
    return "%2E" * len(key) if key in (".", "..") else quote(key, safe="-._~")


def _text(value: Any) -> str | None:
    """A scalar as text; None for anything else."""
    if isinstance(value, str):
        return value
    return None if value is None or isinstance(value, (dict, list)) or value is pointers.MISSING else compact(value)


def key_of(record: Any, name: str) -> str | None:
    """A parent's key: the field, or the path that a flattened name stands for."""
    if not isinstance(record, dict):
        return None
    if name in record:
        return _text(record[name])
    for i in range(1, len(parts := name.split("_"))):
        head = "_".join(parts[:i])
        if isinstance(record.get(head), dict):
            found = key_of(record[head], "_".join(parts[i:]))
            if found is not None:
                return found
    return None


def parent_keys(client: Client, spec: TableSpec) -> Iterator[str]:
    """Keys of the parent's records, in order, as often as they come."""
    parent = spec.parent
    for page in fetch(client, parent.path, {}, parent.paging, parent.table.data_path):
        for record in page.records:
            key = key_of(record, spec.table.parent_key)
            if key is not None:
                yield key


def enrich(record: Any, column: str, key: str) -> dict:
    return {**record, column: key} if isinstance(record, dict) else {column: key, "value": record}


def _child_key(record: Any, spec: TableSpec) -> str | None:
    t = spec.table
    names = [t.child_key_field] if t.child_key_field else [t.parent_key, f"{t.parent_key}_id"]
    return next((k for k in (key_of(record, n) for n in names) if k is not None), None)


def child_records(client: Client, spec: TableSpec, params: dict[str, str], keys: Iterator[str], limit: int | None) -> Iterator[list]:
    """Lists of child records with their parent's key added."""
    t = spec.table
    if t.join_strategy == "nested_loop":
        for key in keys:
            path = re.sub(r"\{[^}]+\}", lambda _: segment(key), spec.path)  # noqa: B023
            for page in fetch(client, path, params, spec.paging, t.data_path, limit):
                yield [enrich(r, t.parent_column, key) for r in page.records]
        return
    batch: list[str] = []
    for key in keys:
        batch.append(key)
        if len(batch) == t.batch_size:
            yield from _batch(client, spec, params, batch, limit)
            batch = []
    if batch:
        yield from _batch(client, spec, params, batch, limit)


def _batch(client: Client, spec: TableSpec, params: dict[str, str], keys: list[str], limit: int | None) -> Iterator[list]:
    t = spec.table
    wanted = set(keys)  # a repeated parent gives each child row once
    for page in fetch(client, spec.path, params | {t.batch_param: t.batch_separator.join(keys)}, spec.paging, t.data_path, limit):
        found = ((r, _child_key(r, spec)) for r in page.records)
        yield [enrich(r, t.parent_column, k) for r, k in found if k in wanted]
