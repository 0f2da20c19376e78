import math
import random

import numpy as np
import pytest

from tidewire.llm import neighbours as op


def brute(rows, every=50, k=5):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[i] = min(ok.get(i, v), v)
    out = []
    for q, a in ok.items():
        if q % every == 0:
            near = []
            for c, b in ok.items():
                if c != q and len(a) == len(b):
                    x, y = np.array(a, float), np.array(b, float)
                    near.append((-(x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())), c))
            near.sort()
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(near[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(400)]
    out += [(400 + i, list(out[7][1])) for i in range(30)] + [(450, [2 * x for x in out[0][1]]), (451, [-x for x in out[0][1]])]
    out += [(500, [0.0] * 8), (501, None), (502, []), (503, [1.0, None]), (504, [math.inf] * 8), (505, [math.nan] * 8), (None, [1.0] * 8), (550, [1.0, 2.0]), (551, [3.0, 1.0]), (600, [1.0, 2.0, 3.0]), (3, list(out[9][1]))]
    return out


def test_against_brute_force(spark, rows):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, score int, rank int").repartition(3)
    found = sorted(tuple(r) for r in op.nearest(df).collect())
    want = brute(rows)
    assert [r[:3] for r in found] == [r[:3] for r in want] and np.allclose([r[3] for r in found], [r[3] for r in want], rtol=1e-14)
    assert any(r[0] == 550 for r in found) and not any(r[0] == 600 for r in found)


@pytest.mark.parametrize("tile", [3, 64])
def test_tiles(rows, tile, monkeypatch):
    monkeypatch.setattr(op, "TILE", tile)
    ids = np.array([i for i, v in rows[:400]])
    x = np.array([v for _, v in rows[:400]])
    q = ids % 50 == 0
    got = {}
    for a, c, s in op.search_block(ids[q], x[q], ids, x):
        got.setdefault(a, []).append((-s, c))
    want = {}
    for a, _, c, s in brute(rows[:400]):
        want.setdefault(a, []).append(c)
    assert {a: [c for _, c in sorted(v)] for a, v in got.items()} == want


def test_codes_bound_the_error():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 64)) * 10.0 ** rng.integers(-30, 30, size=(300, 1))
    code, scale, norm, lost = op._codes(x)
    near = op._product(code, code) * scale[:, None] * scale
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.sqrt((unit**2).sum(axis=1, keepdims=True))
    error = norm[:, None] * lost + lost[:, None] * norm + lost[:, None] * lost + 1e-9
    assert (np.abs(unit @ unit.T - near) <= error).all() and error.max() < 0.05
    long = rng.integers(-127, 128, size=(2, 5000)).astype(np.int8)
    assert np.array_equal(op._product(long, long), long.astype(np.int64) @ long.astype(np.int64).T)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert op.nearest(df).collect() == []
    one = spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert op.nearest(one).collect() == []
