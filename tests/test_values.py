import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidewire.functions import convert, pointers, schema
from tidewire.functions.convert import NO, Counts, loads
from tidewire.streaming.times import TimeFormat, bound, iso


@pytest.mark.parametrize(
    ("kind", "json", "want"),
    [
        ("bigint", "1", 1), ("bigint", "3.0", 3), ("bigint", '"+42"', 42), ("bigint", '"4.2"', None), ("bigint", "4.2", None), ("bigint", "9223372036854775808", None), ("bigint", "true", None), ("bigint", "1e2", 100),
        ("int", "3000000000", None), ("int", '"-5"', -5), ("int", "2147483647", 2147483647),
        ("double", "1", 1.0), ("double", '"1e3"', 1000.0), ("double", "1e309", None), ("double", '"NaN"', None), ("double", "false", None),
        ("boolean", '"TRUE"', True), ("boolean", '"yes"', None), ("boolean", "1", None),
        ("date", '"2024-02-29"', dt.date(2024, 2, 29)), ("date", '"2023-02-29"', None), ("date", '"2024-1-2"', None), ("date", "5", None),
        ("string", "1e2", "1e2"), ("string", '{"a": [1, 2.50, "x"]}', '{"a":[1,2.50,"x"]}'), ("string", "true", "true"), ("string", '"é"', "é"),
    ],
)
def test_readings(kind, json, want):
    assert convert.column(kind, [loads(json)], "c").to_pylist() == [want]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2024-01-02T03:04:05Z", "2024-01-02T03:04:05Z"), ("2024-01-02 03:04:05", "2024-01-02T03:04:05Z"), ("2024-01-02T03:04:05", "2024-01-02T03:04:05Z"), ("2024-01-02T03:04:05+02:00", "2024-01-02T01:04:05Z"),
        ("2024-01-02T03:04:05.25Z", "2024-01-02T03:04:05.250Z"), ("2024-01-02T03:04Z", "2024-01-02T03:04:00Z"), ("0000-01-01T00:00:00Z", None), ("2024-13-02T03:04:05Z", None), ("2024-01-02", None), ("", None), ("1704164645", None),
    ],
)
def test_timestamps(text, want):
    at = convert.instant(text)
    assert (None if at is None else iso(at)) == want


def test_counts():
    counts = Counts()
    rows = [{"id": "42", "small": 1, "flag": "TRUE", "at": "2024-01-02 03:04:05"}, {"id": 7, "small": 3000000000, "flag": True, "at": ""}, {"id": "4.2", "small": 2, "flag": "yes", "at": "2024-01-02T03:04:05Z"}]
    for name, kind in (("id", "bigint"), ("small", "int"), ("flag", "boolean"), ("at", "timestamp")):
        convert.column(kind, [r[name] for r in rows], name, counts)
    assert sum(counts.converted.values()) == 3 and sum(counts.nulled.values()) == 4
    assert counts.first["id"] == '"4.2"'


@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text(), lambda x: st.lists(x) | st.dictionaries(st.text(), x), max_leaves=20))
def test_compact_round_trip(value):
    import json

    assert json.loads(convert.compact(value)) == value


@given(st.lists(st.integers(-(2**70), 2**70) | st.none() | st.text(max_size=5)))
def test_whole_columns_agree_with_single_values(values):
    whole = convert.column("bigint", values, "c").to_pylist()
    assert whole == [None if v is None else convert._integer(64)(v)[0] for v in values]


def test_no_is_no_reading():
    assert convert.to_boolean([]) == NO


def test_pointers():
    doc = {"a": [{"b/c": 1, "~": 2}], "": 3}
    assert pointers.get(doc, "/a/0/b~1c") == 1 and pointers.get(doc, "/a/0/~0") == 2 and pointers.get(doc, "/") == 3
    assert pointers.get(doc, "/a/1") is pointers.MISSING and pointers.get(doc, "/a/00") is pointers.MISSING
    assert pointers.records([1, 2], None) == [1, 2] and pointers.records({"x": 1}, None) == [{"x": 1}]
    assert pointers.records({"x": 1}, "/x") == [] and pointers.records({"x": [1]}, "/x") == [1] and pointers.records({}, "/x") == []
    with pytest.raises(ValueError, match="begins with"):
        pointers.get(doc, "a")


def obj(**props):
    return schema.of_spec({"type": "object", "properties": props})


def test_columns():
    t = obj(
        z={"type": "string"}, a={"type": "integer"}, i={"type": "integer", "format": "int32"}, n={"type": "number", "format": "float"}, b={"type": "boolean"}, d={"type": "string", "format": "date"}, t={"type": "string", "format": "date-time"},
        l={"type": "array", "items": {"type": "integer"}}, u={"type": "object", "properties": {"login": {"type": "string"}, "deep": {"type": "object", "properties": {"x": {"type": "object", "properties": {"y": {"type": "string"}}}}}}}, any={"oneOf": [{"type": "string"}]}, e={"type": "object"},
    )
    got = [(c.name, c.type) for c in schema.columns(t, 2)]
    assert got == [("a", "bigint"), ("any", "string"), ("b", "boolean"), ("d", "date"), ("e", "string"), ("i", "int"), ("l", "string"), ("n", "double"), ("t", "timestamp"), ("u_deep_x", "string"), ("u_login", "string"), ("z", "string")]
    assert [c.name for c in schema.columns(t, 0) if c.name.startswith("u")] == ["u"]
    assert all(f.nullable for f in schema.struct(schema.columns(t, 2)))


def test_spec_types():
    assert schema.of_spec({"type": ["string", "null"]}).kind == "string"
    assert schema.of_spec({"type": ["string", "integer"]}).kind == "variant"
    assert schema.of_spec({"anyOf": [{}]}).kind == "variant"
    assert schema.of_spec({"properties": {"a": {}}}).kind == "object"
    assert schema.of_spec({"type": "file"}).kind == "unknown"


def test_name_collision():
    from tidewire.errors import SpecError

    with pytest.raises(SpecError, match="a_b"):
        schema.columns(obj(a_b={"type": "string"}, a={"type": "object", "properties": {"b": {"type": "string"}}}), 2, "t")


def test_time_formats():
    at = dt.datetime(2024, 3, 5, 6, 7, 8, 123456, tzinfo=dt.timezone.utc)
    assert TimeFormat("yyyy-MM-dd'T'HH:mm:ss'Z'").format(at) == "2024-03-05T06:07:08Z"
    assert TimeFormat("yyyyMMdd HH''mm.SSS XXX").format(at) == "20240305 06'07.123 Z"
    assert TimeFormat("yyyy-MM-dd").step == 86400 and TimeFormat("HH:mm").step == 60
    for bad in ("EEE", "'open"):
        with pytest.raises(ValueError):
            TimeFormat(bad)
    assert iso(bound("2024-03-05")) == "2024-03-05T00:00:00Z" and iso(bound("2024-03-05 01:00:00")) == "2024-03-05T01:00:00Z" and bound("soon") is None
