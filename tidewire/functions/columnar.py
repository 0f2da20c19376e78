"""Pages read straight into Arrow columns, where every value stands in its column's own JSON form.

Arrow's JSON parser reads only the columns that are needed, outside Python's lock. It has one reading per type and refuses
everything else (a number in a text column, text in a number's, records that aren't objects, a missing array); such a page,
like any whose text Python's parser would refuse, is left to the general path, which converts and counts value by value.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.json as pj

from . import pointers
from .convert import TYPES, Counts, column
from .schema import Column

#: How dates and times are read: as text, which is cast if all of it has the plain form. Year 0 isn't one.
_FORMS = {
    "date": r"^[1-9]\d{3}-\d{2}-\d{2}$",
    "timestamp": r"^[1-9]\d{3}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z$",
}
#: A reader that met as many pages that it couldn't read isn't asked again.
_TRIES = 3
_LARGEST = 1 << 30


def _nested(leaves: dict[tuple[str, ...], pa.DataType]) -> pa.StructType | None:
    """The struct that holds leaves at their paths; None if a path goes on below another's leaf."""
    below: dict[str, dict] = {}
    for path, kind in leaves.items():
        if not path:
            return None
        below.setdefault(path[0], {})[path[1:]] = kind
    fields = []
    for name, inner in below.items():
        kind = inner[()] if list(inner) == [()] else _nested(inner)
        if kind is None:
            return None
        fields.append(pa.field(name, kind))
    return pa.struct(fields)


class PageReader:
    """Reads the records of a page, and its next cursor. wanted: the columns that records are read for."""

    def __init__(self, wanted: Iterable[Column], data_path: str | None, cursor_path: str | None = None):
        leaves = {c.path: pa.string() if c.type in _FORMS else TYPES[c.type][0] for c in wanted}
        record = _nested(leaves) if leaves else pa.struct([])
        self.data = ("page", *pointers.parts(data_path or ""))
        self.cursor = None if cursor_path is None else ("page", *pointers.parts(cursor_path))
        whole = None
        if record is not None:
            whole = _nested({self.data: pa.list_(record)} | ({} if self.cursor is None else {self.cursor: pa.string()}))
        self.left = _TRIES if whole is not None else 0
        self.schema = None if whole is None else pa.schema(list(whole))

    def read(self, body: bytes) -> tuple[pa.StructArray, str | None] | None:
        """The records and the cursor; None if the page has to be read in the general way."""
        if not self.left or len(body) > _LARGEST:
            return None
        try:
            body.decode("utf-8")
            text = b'{"page":' + body + b"}"
            table = pj.read_json(
                pa.BufferReader(text),
                read_options=pj.ReadOptions(use_threads=False, block_size=len(text) + 1),
                parse_options=pj.ParseOptions(explicit_schema=self.schema, newlines_in_values=True, unexpected_field_behavior="ignore"),
            )
            if table.num_rows == 1:
                row = table.to_struct_array().combine_chunks()
                if isinstance(row, pa.ChunkedArray):
                    row = row.chunk(0)
                held = pc.struct_field(row, list(self.data))
                if held.null_count == 0 and (records := held.flatten()).null_count == 0:
                    return records, None if self.cursor is None else pc.struct_field(row, list(self.cursor))[0].as_py()
        except (pa.ArrowException, UnicodeDecodeError):
            pass
        self.left -= 1
        return None


def reader(columns: Iterable[Column], needed: set[str] | None, data_path: str | None, cursor_path: str | None) -> PageReader:
    """The reader for a table's needed columns. Arrays, which become JSON text, are left to the general path."""
    wanted = [c for c in columns if needed is None or c.name in needed]
    out = PageReader(wanted, data_path, cursor_path)
    if any(c.element is not None for c in wanted):
        out.left = 0
    return out


def array(records: pa.StructArray, c: Column, counts: Counts | None) -> pa.Array:
    """A typed column of records that a reader gave."""
    kind = TYPES[c.type][0]
    values = pc.struct_field(records, list(c.path))
    if c.type in _FORMS:
        if pc.all(pc.match_substring_regex(values, _FORMS[c.type]), min_count=0).as_py():
            try:
                plain = pc.utf8_rtrim(values, "Z")
                return plain.cast(kind) if c.type == "date" else plain.cast(pa.timestamp("us")).cast(kind)
            except pa.ArrowInvalid:
                pass
        return column(c.type, values.to_pylist(), c.name, counts)
    if c.type == "double" and not pc.all(pc.is_finite(values), min_count=0).as_py():
        return column(c.type, values.to_pylist(), c.name, counts)
    return values
