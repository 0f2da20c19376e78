"""Record schemas: from an API description's types to columns."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

from ..errors import SpecError

log = logging.getLogger("tidewire")


@dataclass(frozen=True)
class Type:
    """A neutral type: string, integer, number, boolean, array, object, variant or unknown."""

    kind: str
    format: str | None = None
    items: "Type | None" = None
    properties: tuple[tuple[str, "Type"], ...] = ()


VARIANT, UNKNOWN = Type("variant"), Type("unknown")


@dataclass(frozen=True)
class Column:
    """A column, and the keys that lead to its value in a record."""

    name: str
    type: str
    path: tuple[str, ...]
    element: Type | None = field(default=None, compare=False)


def of_spec(node: Any) -> Type:
    """The neutral type of a schema whose references are resolved."""
    if not isinstance(node, dict):
        return VARIANT
    if node.get("anyOf") or node.get("oneOf"):
        return VARIANT
    if node.get("allOf"):
        merged: dict[str, Any] = {"type": "object", "properties": {}}
        for part in node["allOf"]:
            if isinstance(part, dict):
                merged["properties"] |= part.get("properties") or {}
        merged["properties"] |= node.get("properties") or {}
        return of_spec(merged)
    kind = node.get("type")
    if isinstance(kind, list):
        some = [k for k in kind if k != "null"]
        if len(some) != 1:
            return VARIANT
        kind = some[0]
    if kind is None and "$ref" in node:
        kind = "object"
    if kind == "object" or kind is None and node.get("properties"):
        props = node.get("properties") or {}
        return Type("object", properties=tuple((str(k), of_spec(v)) for k, v in props.items())) if props else VARIANT
    if kind == "array":
        return Type("array", items=of_spec(node.get("items") or {}))
    if kind in ("string", "integer", "number"):
        return Type(kind, node.get("format"))
    if kind == "boolean":
        return Type("boolean")
    return VARIANT if kind is None else UNKNOWN


def _leaf(t: Type) -> str:
    if t.kind == "string":
        return {"date": "date", "date-time": "timestamp"}.get(t.format or "", "string")
    if t.kind == "integer":
        return "int" if t.format == "int32" else "bigint"
    return {"number": "double", "boolean": "boolean"}.get(t.kind, "string")


def flatten(record: Type, depth: int, prefix: tuple[str, ...] = ()) -> list[Column]:
    """Columns of an object, sorted by name at each level; objects below the depth become JSON text."""
    out: list[Column] = []
    for name, t in sorted(record.properties):
        path = (*prefix, name)
        if t.kind == "object" and t.properties and len(prefix) < depth:
            out += flatten(t, depth, path)
        else:
            out.append(Column("_".join(path), _leaf(t), path, t.items if t.kind == "array" else None))
    return out


def columns(record: Type, depth: int, table: str = "") -> list[Column]:
    """Columns of a record type; two that get the same name are an error."""
    out = flatten(record, depth)
    seen: dict[str, Column] = {}
    for c in out:
        if c.name in seen:
            raise SpecError(f"table {table}: {'.'.join(seen[c.name].path)} and {'.'.join(c.path)} both become column {c.name}; lower schema.flatten-depth")
        seen[c.name] = c
    return out


def array_fields(record: Type) -> list[tuple[str, Type]]:
    """Top-level arrays of a record type, and their elements' types."""
    return [(name, t.items or UNKNOWN) for name, t in sorted(record.properties) if t.kind == "array"]


_SPARK = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType()}


def struct(cols: list[Column]) -> T.StructType:
    """The Spark schema; every column is nullable, whatever the description requires."""
    return T.StructType([T.StructField(c.name, _SPARK[c.type], True) for c in cols])


def walk(record: Type, pointer: list[str]) -> Type | None:
    """The type at a pointer, through arrays; None if there is none."""
    for p in pointer:
        while record.kind == "array" and record.items is not None:
            record = record.items
        found = dict(record.properties).get(p)
        if found is None:
            return None
        record = found
    return record
