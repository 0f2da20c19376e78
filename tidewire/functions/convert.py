"""JSON values to typed columns. A value has one reading per type; what doesn't fit becomes NULL and is counted."""

from __future__ import annotations

import datetime as dt
import json
import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa

_INT = re.compile(r"[+-]?[0-9]+")
_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")
_TIME = re.compile(r"(\d{4}-\d{2}-\d{2})([T ])(\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)\s?(Z|z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?")
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


class Number(float):
    """A float that keeps its source text, for columns that hold raw JSON."""

    text = ""

    def __new__(cls, text: str):
        out = super().__new__(cls, text)
        out.text = text
        return out

    def __reduce__(self):
        return (Number, (self.text,))


def loads(text: str | bytes, exact: bool = True) -> Any:
    """JSON; exact: with numbers' source text kept, which takes longer."""
    return json.loads(text, parse_float=Number) if exact else json.loads(text)


def inexact(value: Any) -> bool:
    """Whether a value that was read without its numbers' text may hold a number that text would show otherwise."""
    return isinstance(value, (float, list, dict)) and not isinstance(value, Number)


def compact(value: Any) -> str:
    """JSON text without spaces, numbers as they stood."""
    if isinstance(value, Number):
        return value.text
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{compact(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(compact, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


@dataclass
class Counts:
    """Values that were converted from another type, and those replaced by NULL, by column."""

    converted: dict[str, int] = field(default_factory=dict)
    nulled: dict[str, int] = field(default_factory=dict)
    first: dict[str, str] = field(default_factory=dict)


#: What a reading returns: the value, and whether it was converted from another form. NO stands for no reading.
NO = (None, None)


def to_string(v: Any) -> tuple[Any, Any]:
    return (v, False) if isinstance(v, str) else (compact(v), False)


def _integer(bits: int) -> Callable[[Any], tuple[Any, Any]]:
    lo, hi = -(1 << bits - 1), (1 << bits - 1) - 1

    def read(v: Any) -> tuple[Any, Any]:
        if isinstance(v, bool):
            return NO
        if isinstance(v, int):
            return (v, False) if lo <= v <= hi else NO
        if isinstance(v, float):
            return (int(v), False) if v.is_integer() and lo <= int(v) <= hi else NO
        if isinstance(v, str) and _INT.fullmatch(v):
            n = int(v)
            return (n, True) if lo <= n <= hi else NO
        return NO

    return read


def to_double(v: Any) -> tuple[Any, Any]:
    if isinstance(v, bool):
        return NO
    if isinstance(v, (int, float)):
        try:
            x = float(v)
        except OverflowError:
            return NO
        return (x, False) if math.isfinite(x) else NO
    if isinstance(v, str) and re.fullmatch(r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?", v):
        x = float(v)
        return (x, True) if math.isfinite(x) else NO
    return NO


def to_boolean(v: Any) -> tuple[Any, Any]:
    if isinstance(v, bool):
        return (v, False)
    if isinstance(v, str) and v.lower() in ("true", "false"):
        return (v.lower() == "true", True)
    return NO


def to_date(v: Any) -> tuple[Any, Any]:
    if isinstance(v, str) and _DATE.fullmatch(v):
        try:
            return (dt.date.fromisoformat(v), False)
        except ValueError:
            return NO
    return NO


def instant(v: Any) -> dt.datetime | None:
    """The instant of an ISO timestamp, or None."""
    got = to_timestamp(v)[0]
    return None if got is None else _EPOCH + dt.timedelta(microseconds=got)


def to_timestamp(v: Any) -> tuple[Any, Any]:
    """Microseconds from 1970 in UTC; a space for T, or a missing zone, counts as converted."""
    if not isinstance(v, str) or not (m := _TIME.fullmatch(v)):
        return NO
    day, mark, clock, zone = m.groups()
    clock, _, fraction = clock.partition(".")
    z = "+00:00" if zone is None or zone in "Zz" else zone
    try:
        at = dt.datetime.fromisoformat(f"{day}T{clock}{z}")
        micros = (at - _EPOCH) // dt.timedelta(microseconds=1) + (int((fraction + "000000")[:6]) if fraction else 0)
        if not 1 <= (_EPOCH + dt.timedelta(microseconds=micros)).year <= 9999:
            return NO
    except (ValueError, OverflowError):
        return NO
    return (micros, mark == " " or zone is None)


#: By column type: Arrow type, reading, and the Python types of values that need none.
TYPES: dict[str, tuple[pa.DataType, Callable[[Any], tuple[Any, Any]], tuple[type, ...]]] = {
    "string": (pa.string(), to_string, (str,)),
    "int": (pa.int32(), _integer(32), ()),
    "bigint": (pa.int64(), _integer(64), ()),
    "double": (pa.float64(), to_double, ()),
    "boolean": (pa.bool_(), to_boolean, (bool,)),
    "date": (pa.date32(), to_date, ()),
    "timestamp": (pa.timestamp("us", tz="UTC"), to_timestamp, ()),
}
_NONE = type(None)


def _whole(kind: str, values: list) -> pa.Array | None:
    """The column at once, if all its values are in their type's own form."""
    types = set(map(type, values)) - {_NONE}
    try:
        if kind == "string" and types <= {str} or kind == "boolean" and types <= {bool}:
            return pa.array(values, TYPES[kind][0])
        if kind in ("int", "bigint") and types <= {int}:
            return pa.array(values, TYPES[kind][0])
        if kind == "double" and types <= {Number, float, int} and types & {Number, float}:
            out = pa.array([None if v is None else float(v) for v in values], pa.float64())
            return out if not any(v is not None and not math.isfinite(v) for v in values) else None
        if kind == "timestamp" and types <= {str} and all(v is None or (len(v) == 20 and v[0] != "0" and v[10] == "T" and v[19] == "Z") for v in values):
            return pa.array([None if v is None else v[:19] for v in values], pa.string()).cast(pa.timestamp("us")).cast(pa.timestamp("us", tz="UTC"))
    except (pa.ArrowInvalid, pa.ArrowTypeError, OverflowError):
        return None
    return None


def column(kind: str, values: list, name: str, counts: Counts | None = None) -> pa.Array:
    """A typed column; absent values and JSON nulls are NULL and not counted."""
    whole = _whole(kind, values)
    if whole is not None:
        return whole
    arrow, read, _ = TYPES[kind]
    out = []
    for v in values:
        if v is None:
            out.append(None)
            continue
        got, converted = read(v)
        if counts is not None:
            if converted is None:
                counts.nulled[name] = counts.nulled.get(name, 0) + 1
                counts.first.setdefault(name, compact(v)[:100])
            elif converted:
                counts.converted[name] = counts.converted.get(name, 0) + 1
        out.append(got)
    return pa.array(out, arrow)
