import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidewire.llm import lm as op

TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return TOKEN.findall((text or "").translate(LOWER)) + ["\n"]


def held(doc):
    return doc is None or zlib.crc32(str(doc).encode()) % 10 == 0


def brute(rows, quantised):
    """(id, held out, tokens, known, N, base, score) with exact pair counts, or as levels hold them."""
    uni, pairs, followers = Counter(), Counter(), {}
    for doc, text, *_ in rows:
        if not held(doc):
            t = tokens(text)
            uni.update(t)
            for u, w in zip(["\n"] + t, t):
                pairs[u, w] += 1
                followers.setdefault(u, set()).add(w)
    n, v = sum(uni.values()), len(uni)
    near = (lambda c: float(op.LEVELS[op.level(np.array([c]))[0]]) if c else 0.0) if quantised else float
    out = []
    for doc, text, *_ in rows:
        t = tokens(text)
        base = score = 0.0
        for u, w in zip(["\n"] + t, t):
            p = (uni[w] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            if uni[u]:
                c, f = min(near(pairs[u, w]), uni[u]), near(len(followers[u]))
                p = max(c - op.DISCOUNT, 0) / uni[u] + min(1, op.DISCOUNT * f / uni[u]) * p
            score += math.log10(min(p, 1))
        out.append((doc, held(doc), len(t), sum(uni[w] > 0 for w in t), n, base, score))
    return out


@pytest.mark.parametrize("filter_bytes", [op.FILTER_BYTES, 12_000])
def test_against_brute_force(docs, rows, filter_bytes):
    found = [tuple(r) for r in op.score(docs, filter_bytes=filter_bytes, range_pairs=4000).collect()]
    want = brute(rows, True)
    key = lambda r: (repr(r[0]), r[2], round(r[5], 6))
    found.sort(key=key)
    want.sort(key=key)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in found], [r[5] for r in want], rtol=1e-10)
    # a missing pair is taken for a present one at a small, one-sided rate
    per_token = [(a[6] - b[6]) / b[2] for a, b in zip(found, want)]
    assert min(per_token) > -1e-9 and np.average(per_token, weights=[r[2] for r in want]) < 0.08


def test_common_contexts(docs, rows):
    """With ranges this small, most contexts of the corpus and the end token are hot."""
    found = [tuple(r) for r in op.score(docs, filter_bytes=20_000, range_pairs=300).collect()]
    want = brute(rows, True)
    key = lambda r: (repr(r[0]), r[2], round(r[5], 6))
    found.sort(key=key)
    want.sort(key=key)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    # followers of hot contexts are counted exactly, those of others as levels hold them
    per_token = [(a[6] - b[6]) / b[2] for a, b in zip(found, want)]
    assert np.average(np.abs(per_token), weights=[r[2] for r in want]) < 0.08


def test_hot_context_is_dealt_out():
    """A token before 20,000 different ones, in three chunks that share some: no range has many of its pairs."""
    rng = np.random.default_rng(3)
    hot, others = op.U64(12345), np.sort(rng.integers(1 << 20, 2**63, 20_000, dtype=np.uint64)) << op.U64(1)
    bits, rows = 6, []
    for a, b in ((0, 9_000), (6_000, 15_000), (14_000, 20_000)):
        keys = np.unique(np.concatenate([others[a:b], [hot, op.END]]))
        text = np.stack([np.full(b - a, np.searchsorted(keys, hot)), np.searchsorted(keys, others[a:b])], 1).ravel()
        code = np.append(text, np.searchsorted(keys, op.END)).astype(np.uint32)
        counts = np.where(keys == hot, 24_000, 2).astype(np.int64)
        batch = pa.RecordBatch.from_pylist([{"held": [False], "size": [len(code)], "keys": keys.tobytes(), "counts": op._pack(counts), "codes": op._pack(code)}])
        for out in op._pairs(bits, 1_000)(iter([batch])):
            rows += out.to_pylist()
    names = ("part", "contexts", "runs", "pairs", "counts")
    total, found = 0, {}
    for part in {r["part"] for r in rows}:
        table = pa.Table.from_pylist([r for r in rows if r["part"] == part], pa.schema([("part", pa.int32()), *[(n, pa.binary()) for n in names[1:]]]))
        assert sum(len(x) // 5 for x in table["pairs"].to_pylist()) < 2 * 45_000 / 2**bits
        got = op._filter(table).to_pylist()[0]
        assert len(got["hot"]) <= 1
        total += sum(h["followers"] for h in got["hot"])
        found[part] = got["words"]
    assert total == 20_000
    shard = op.Filters(bits, 0, found | {2**bits - 1: found.get(2**bits - 1, b"")}, {int(hot): total})
    u = np.full(len(others), hot)
    pair = op._pair(u, others)
    to = op._route(u, pair, np.ones(len(u), bool), bits)
    seen = np.bincount(np.concatenate([np.arange(a, b) for a, b in ((0, 9_000), (6_000, 15_000), (14_000, 20_000))]))
    read = shard.count(to, pair & op.NARROW)
    assert (read >= seen).all() and (read == seen).mean() > 0.95
    assert (shard.followers(u[:3]) == 20_000).all()


def test_learns_copies(docs, rows):
    found = op.score(docs).collect()
    long = [r for r in found if r.held_out and r.n_tokens > 20 and r.n_known > 0.9 * r.n_tokens]
    assert long and sum(r.score for r in long) > sum(r.base_score for r in long)


def test_filter_counts():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2**63, 20_000, dtype=np.uint64)
    counts = np.minimum(rng.zipf(1.7, 20_000), 10**6)
    f = op.Filters(0, 0, {0: op.build_filter(keys, counts).tobytes()})
    read = f.count(keys, keys)
    exact = op.LEVELS[op.level(counts)]
    assert (read >= exact - 1e-12).all() and (read == exact).mean() > 0.95
    assert (f.count(keys, rng.integers(0, 2**63, 20_000, dtype=np.uint64)) > 0).mean() < 0.05
    small = np.arange(1, 5)
    assert np.allclose(op.LEVELS[op.level(small)][:3], [1, 2, 3]) and (np.diff(op.level(np.arange(1, 3000))) >= 0).all()


def test_no_documents(no_docs, spark):
    assert op.score(no_docs).collect() == []
    none = spark.createDataFrame([(None, "a b", None, None, None)], no_docs.schema)
    assert [tuple(r) for r in op.score(none).collect()] == [(None, True, 3, 0, 0, 0.0, 0.0)]


def test_shards_follow_the_memory():
    size = lambda **conf: op.shard_bytes(lambda k, default: conf.get(k.removeprefix("spark.").replace(".", "_"), default))
    assert size() == size(executor_memory="64g", driver_memory="64g") == op.FILTER_BYTES
    assert size(executor_cores="0", executor_memory="64g") == size(executor_cores="4", executor_memory="odd") == op.FILTER_BYTES
    assert size(executor_cores="8", executor_memory="32g", driver_memory="16g") == 256 << 20
    assert size(executor_cores="8", executor_memory="64g", driver_memory="4096m") == 256 << 20
    assert size(executor_cores="8", executor_memory="64g", driver_memory="64g") == 256 << 20
    assert size(executor_cores="8", executor_memory="64g", driver_memory="64g", driver_maxResultSize="4g") == 512 << 20
    assert size(executor_cores="8", executor_memory="64g", driver_memory="64g", driver_maxResultSize="0") == 512 << 20
    assert size(executor_cores="8", executor_memory="4g", driver_memory="64g") == op.FILTER_BYTES
