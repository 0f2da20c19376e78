"""The tables of a source: which endpoint each one reads, and its columns."""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass, replace

from pyspark.sql.types import StructField, StructType, VariantType

from ..errors import NoSuchTable, SpecError
from ..functions import pointers
from ..functions.schema import Column, Type, array_fields, columns, struct, walk
from .config import Pagination, Source, Table
from .spec import Endpoint, Spec

log = logging.getLogger("tidewire")


@dataclass(frozen=True)
class TableSpec:
    """All that reading a table needs. kind: base, child (rows fetched per parent key) or exploded (a view over base)."""

    name: str
    kind: str
    path: str
    columns: tuple[Column, ...]
    table: Table
    paging: Pagination
    record: Type
    variant: bool = False
    parent: "TableSpec | None" = None
    array: str | None = None
    element: tuple[Column, ...] = ()

    @property
    def struct(self) -> StructType:
        return StructType([StructField("value", VariantType(), True)]) if self.variant else struct(list(self.columns))


def _template(path: str) -> str:
    return re.sub(r"\{[^}]*\}", "{}", path)


def _matches_template(concrete: str, template: str) -> bool:
    pattern = "".join("[^/]+" if x.startswith("{") else re.escape(x) for x in re.split(r"(\{[^}]*\})", template) if x)
    return re.fullmatch(pattern, concrete) is not None


def _last(path: str) -> str:
    return next((p for p in reversed(path.strip("/").split("/")) if p and not p.startswith("{")), "")


class Catalog:
    """A source's tables."""

    def __init__(self, source: Source, spec: Spec):
        self.source, self.spec = source, spec
        self.base_url = source.base_url or spec.base_url
        self._found: dict[str, TableSpec] = {}

    def _readable(self, e: Endpoint) -> bool:
        if self.source.http.response_format == "ndjson":
            return e.lines is not None
        return e.body is not None

    def endpoint(self, table: Table) -> Endpoint | None:
        """The described endpoint of a configured table: exact path, path template, operation id, last path segment."""
        every = self.spec.endpoints
        if table.endpoint:
            for test in (lambda e: e.path == table.endpoint, lambda e: _template(e.path) == _template(table.endpoint), lambda e: "{" in e.path and _matches_template(re.sub(r"\{[^}]*\}", "x", table.endpoint), e.path)):
                if (found := next((e for e in every if test(e)), None)) is not None:
                    return found
        wanted = table.name.lower()
        for test in (lambda e: (e.operation or "").lower() == wanted, lambda e: _last(e.path).lower() == wanted):
            if not table.endpoint and (found := next((e for e in every if test(e)), None)) is not None:
                return found
        return None

    def base_names(self) -> list[str]:
        """Configured tables, then those found in the description."""
        out = list(self.source.tables)
        for e in self.spec.endpoints:
            if "{" not in e.path and self._readable(e):
                name = e.operation or _last(e.path)
                if name and name not in out and not any(t.endpoint == e.path for t in self.source.tables.values()):
                    out.append(name)
        return out

    def names(self) -> list[str]:
        """The tables that are listed."""
        handling = self.source.schema.array_handling
        out = []
        for name in self.base_names():
            child = name in self.source.tables and self.source.tables[name].parent_table
            if handling != "explode_view" or child:
                out.append(name)
            if handling != "keep_array" and not child:
                try:
                    out += [f"{name}_{a}" for a, _ in array_fields(self.base(name).record)]
                except SpecError as error:
                    log.warning("%s", error)
        return list(dict.fromkeys(out))

    def _config(self, name: str) -> Table | None:
        if name in self.source.tables:
            return self.source.tables[name]
        for e in self.spec.endpoints:
            if "{" not in e.path and self._readable(e) and name == (e.operation or _last(e.path)):
                return Table(name, endpoint=e.path)
        return None

    def _record(self, table: Table, e: Endpoint | None, strict: bool) -> tuple[Type, str | None]:
        """The type of the table's records, and the JSON pointer to them within a response."""
        lines = self.source.http.response_format == "ndjson"
        streaming = self.source.http.response_format != "json"
        record = None if e is None else e.lines if lines else e.body
        if record is None:
            if strict:
                what = "isn't in the API description" if e is None else f"has no usable schema there; it offers {', '.join(e.offered) or 'no content type'}"
                raise SpecError(f"table {table.name}: endpoint {table.endpoint or table.name} {what}; use schema.mode = variant to read it")
            return Type("object"), table.data_path
        if table.data_path and not streaming:
            found = walk(record, pointers.parts(table.data_path))
            while found is not None and found.kind == "array" and found.items is not None:
                found = found.items
            if found is not None and found.kind == "object":
                return found, table.data_path
            log.warning("table %s: data-path %s isn't in the schema; the full response's is used", table.name, table.data_path)
        return record, table.data_path

    def base(self, name: str) -> TableSpec:
        """A base or child table."""
        if name in self._found:
            return self._found[name]
        table = self._config(name)
        if table is None:
            raise NoSuchTable(f"there is no table {name}; there are: {', '.join(self.names())}")
        e = self.endpoint(table)
        variant = self.source.schema.mode == "variant"
        record, _ = self._record(table, e, not variant)
        cols = () if variant else tuple(columns(record, self.source.schema.flatten_depth, name))
        path = table.endpoint or (e.path if e else f"/{name}")
        out = TableSpec(name, "base", path, cols, table, self.source.paging(table), record, variant)
        if table.parent_table:
            if variant:
                raise SpecError(f"table {name}: parent-child tables can't be read in variant mode")
            parent = self.base(table.parent_table)
            key = Column(table.parent_column, "string", (table.parent_column,))
            if any(c.name == key.name for c in cols):
                raise SpecError(f"table {name}: {key.name} is a column of its own")
            out = replace(out, kind="child", parent=parent, columns=(key, *cols))
        self._found[name] = out
        return out

    def table(self, name: str) -> TableSpec:
        """Any table: child tables first, then base tables, then exploded ones, the longest base name first."""
        if name in self.source.tables and self.source.tables[name].parent_table:
            return self.base(name)
        if self._config(name) is not None:
            return self.base(name)
        at = name.rfind("_")
        while at > 0:
            if self._config(name[:at]) is not None:
                base = self.base(name[:at])
                array = name[at + 1 :]
                if base.kind == "base" and array in dict(array_fields(base.record)):
                    return self.exploded(base, array)
            at = name.rfind("_", 0, at)
        raise NoSuchTable(f"there is no table {name}; there are: {', '.join(self.names())}")

    def exploded(self, base: TableSpec, array: str) -> TableSpec:
        """A row for each element of a top-level array: the other columns, then the element's."""
        if base.variant:
            log.warning("table %s_%s: exploded tables ignore variant mode", base.name, array)
            base = replace(base, variant=False, columns=tuple(columns(base.record, self.source.schema.flatten_depth, base.name)))
        kind = dict(array_fields(base.record))[array]
        if kind.kind == "object" and kind.properties:
            own = [Column(f"{array}_{c.name}", c.type, c.path) for c in columns(kind, self.source.schema.flatten_depth, f"{base.name}_{array}")]
        else:
            leaf = columns(Type("object", properties=((array, kind),)), 0)[0]
            own = [Column(array, leaf.type, ())]
        kept = tuple(c for c in base.columns if c.name != array)
        clash = {c.name for c in kept} & {c.name for c in own}
        if clash:
            raise SpecError(f"table {base.name}_{array}: {', '.join(sorted(clash))} are columns of the parent, too")
        return replace(base, name=f"{base.name}_{array}", kind="exploded", columns=(*kept, *own), array=array, element=tuple(own), parent=base)
