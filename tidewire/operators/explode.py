"""Array columns as rows: SQL over the base table, so that its filters still reach the API."""

from __future__ import annotations

from ..functions.schema import Column
from ..sources.tables import TableSpec


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(path: tuple[str, ...]) -> str:
    if not path:
        return "_e"
    steps = "".join(f"[\\'{p}\\']" for p in path)
    return f"get_json_object(_e, '${steps}')"


def typed(c: Column) -> str:
    """An element's value, converted as records are: what doesn't fit is NULL."""
    x = _text(c.path)
    if c.type == "string":
        return x
    if c.type in ("int", "bigint"):
        whole = f"CASE WHEN {x} RLIKE '^[+-]?[0-9]+$' THEN try_cast({x} AS {c.type}) WHEN try_cast({x} AS double) = floor(try_cast({x} AS double)) THEN try_cast(try_cast({x} AS double) AS {c.type}) END"
        return whole
    if c.type == "double":
        return f"CASE WHEN abs(try_cast({x} AS double)) < double('infinity') THEN try_cast({x} AS double) END"
    if c.type == "boolean":
        return f"CASE lower({x}) WHEN 'true' THEN true WHEN 'false' THEN false END"
    if c.type == "date":
        return f"CASE WHEN {x} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' THEN try_cast({x} AS date) END"
    return f"CASE WHEN {x} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ]' THEN try_cast({x} AS timestamp) END"


def view_sql(spec: TableSpec, base: str, outer: bool) -> str:
    """The query of an exploded table over its base table. outer: a row with a NULL element for an empty array."""
    own = {c.name for c in spec.element}
    parent = [quoted(c.name) for c in spec.columns if c.name not in own]
    element = [f"{typed(c)} AS {quoted(c.name)}" for c in spec.element]
    explode = "explode_outer" if outer else "explode"
    # an element that is an object stays JSON text until its fields are taken
    return f"SELECT {', '.join(parent + element)} FROM (SELECT {', '.join([*parent, ''])}{explode}(from_json({quoted(spec.array)}, 'array<string>')) AS _e FROM {base})"
