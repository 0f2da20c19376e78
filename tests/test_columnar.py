"""Pages read as columns hold what the general path finds in them, value by value."""

from __future__ import annotations

import json
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewire.functions import pointers
from tidewire.functions.columnar import array, reader
from tidewire.functions.convert import Counts, column, loads
from tidewire.functions.schema import Column, Type

COLUMNS = [Column(k, t, (k,)) for k, t in (("i", "bigint"), ("n", "int"), ("s", "string"), ("d", "double"), ("b", "boolean"), ("t", "timestamp"), ("day", "date"))] + [Column("a_x", "string", ("a", "x"))]


def general(body: bytes, data_path: str | None):
    counts = Counts()
    rows = pointers.records(loads(body), data_path)
    values = {c.name: [None if (v := pointers.get(r, list(c.path))) is pointers.MISSING else v for r in rows] for c in COLUMNS}
    return {c.name: column(c.type, values[c.name], c.name, counts) for c in COLUMNS}, counts


def same(body: bytes, data_path: str | None = "/rows", cursor: str | None = None) -> bool:
    """Whether the page was read as columns; if so, they are the general path's."""
    got = reader(COLUMNS, None, data_path, cursor).read(body)
    if got is None:
        return False
    counts = Counts()
    expected, expected_counts = general(body, data_path)
    for c in COLUMNS:
        mine = array(got[0], c, counts)
        assert mine.type == expected[c.name].type and mine.equals(expected[c.name]), (c, mine, expected[c.name])
    assert counts == expected_counts
    if cursor is not None:
        found = pointers.get(loads(body), cursor)
        assert got[1] == (found if isinstance(found, str) else None)
    return True


PLAIN = [
    {"i": 1, "n": -5, "s": "é\n\"x\"", "d": 0.1, "b": True, "t": "2024-02-29T23:59:59Z", "day": "2024-02-29", "a": {"x": "y", "z": 1}, "more": [1, {"k": None}]},
    {"i": None, "t": "1999-01-01T00:00:00.123456Z", "a": None, "d": -0.0},
    {},
    {"i": -(2**63), "d": 12345678901234567890123, "s": "", "a": {}, "t": "2024-01-01T00:00:00.5Z"},
]


def test_plain_pages():
    assert same(json.dumps({"rows": PLAIN, "next": "c1"}, indent=1).encode(), cursor="/next")
    assert same(json.dumps({"rows": PLAIN, "next": None}).encode(), cursor="/next")
    assert same(json.dumps({"rows": PLAIN}).encode(), cursor="/meta/next")
    assert same(json.dumps(PLAIN, ensure_ascii=False).encode(), None)
    assert same(b'{"rows": []}') and same(b"[]", None)
    assert same(json.dumps({"deep": {"rows": PLAIN}}).encode(), "/deep/rows")


@pytest.mark.parametrize(
    "row",
    [
        {"t": "0000-01-01T00:00:00Z"}, {"t": "2024-13-01T00:00:00Z"}, {"t": "2024-01-01T24:00:00Z"}, {"t": "2024-01-01 00:00:00"}, {"t": "2024-01-01T00:00:00+02:00"}, {"t": "2024-01-01T00:00:00.1234567Z"}, {"t": ""},
        {"day": "2023-02-29"}, {"day": "0000-01-01"}, {"day": "2024-1-1"}, {"day": "2024-01-01T00:00:00Z"}, {"d": float("nan")}, {"d": float("inf")},
    ],
)
def test_values_that_need_a_closer_look(row):
    assert same(json.dumps({"rows": [*PLAIN, row]}).encode())


@pytest.mark.parametrize("row", ['{"i": "4"}', '{"i": 1.0}', '{"i": 9223372036854775808}', '{"n": 3000000000}', '{"s": 5}', '{"s": [1]}', '{"s": {}}', '{"b": "true"}', '{"d": "1.5"}', '{"d": 1e999}', '{"t": 5}', '{"a": 5}', "null", "7", '{"i": 1, "i": 2}', '{"s": "\\ud800"}'])
def test_other_forms_are_left_to_the_general_path(row):
    assert not same(f'{{"rows": [{{"i": 1}}, {row}]}}'.encode())


@pytest.mark.parametrize("body", [b"", b"{", b'{"rows": null}', b"{}", b'{"rows": {"i": 1}}', b'[{"i": 1}]', b'{"rows": []} x', b'{"rows": []}{"rows": []}', b'{"rows": []}, "page": {"rows": [{"i": 1}]', b'{"rows": [{"s": "\xff"}]}', b'{"rows": [{"zz": 01}]}', b'{"rows": [{"i": 1},]}'])
def test_bodies_that_are_no_page(body):
    assert not same(body)


def test_gives_up_after_some_pages():
    r = reader(COLUMNS, None, None, None)
    for _ in range(3):
        assert r.read(b'[{"i": "1"}]') is None
    assert r.read(b'[{"i": 1}]') is None


def test_needed_columns_and_arrays():
    body = b'[{"i": 1, "s": 5, "list": [1]}, {"i": 2}]'
    assert reader(COLUMNS, {"i"}, None, None).read(body)[0].to_pylist() == [{"i": 1}, {"i": 2}]
    assert len(reader(COLUMNS, set(), None, None).read(body)[0]) == 2
    lists = [*COLUMNS, Column("list", "string", ("list",), Type("integer"))]
    assert reader(lists, None, None, None).read(b'[{"i": 1}]') is None
    assert reader(lists, {"i"}, None, None).read(body) is not None


VALUES = st.one_of(st.none(), st.booleans(), st.integers(-(2**70), 2**70), st.floats(), st.text(max_size=5), st.sampled_from(["2024-01-01", "2024-01-01T00:00:00Z", "2024-01-01 00:00:00", "1", "-2.5", "TRUE"]), st.lists(st.integers(), max_size=2), st.fixed_dictionaries({"x": st.one_of(st.none(), st.text(max_size=3), st.integers())}))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from(["i", "n", "s", "d", "b", "t", "day", "a", "zz"]), VALUES, max_size=3), max_size=3))
def test_any_page(rows):
    same(json.dumps({"rows": rows}).encode())


def test_batches_of_a_page():
    rng = random.Random(5)
    rows = [{"i": k, "d": rng.random(), "t": f"2024-01-{k % 28 + 1:02d}T00:00:00Z"} for k in range(1000)]
    got = reader(COLUMNS, None, "/rows", None).read(json.dumps({"rows": rows}).encode())[0]
    parts = [got[k : k + 300] for k in range(0, len(got), 300)]
    for c in COLUMNS:
        assert pa.concat_arrays([array(p, c, None) for p in parts]).equals(array(got, c, None))
