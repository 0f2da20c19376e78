import zlib
from itertools import accumulate

import pytest
from made import got
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewire.llm import sharding as op


def best(sizes, shards):
    """The smallest capacity by trying all cuts."""
    sums = [0, *accumulate(sizes)]
    table = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        table = [min([table[j]] + [max(table[i], sums[j] - sums[i]) for i in range(j)]) for j in range(len(sums))]
    return table[-1]


@settings(deadline=None, max_examples=150)
@given(st.lists(st.integers(1, 400), min_size=1, max_size=40), st.integers(1, 6), st.randoms(use_true_random=False))
def test_cuts_are_minimax(sizes, shards, rng):
    keys = sorted({"".join(rng.choices("0123", k=12)) for _ in sizes})
    sizes = dict(zip(keys, sizes))

    def nodes_of(prefixes, digits):
        by = {}
        for k in keys:
            if prefixes is None or any(k.startswith(p) for p in prefixes):
                by.setdefault(k[: max(1, digits - 3)], []).append(k)
        return [op.Node(v[0] if len(v) == 1 else k, sum(sizes[x] for x in v), len(v) == 1) for k, v in by.items()]

    alone, firsts = op.cut_groups(nodes_of, shards)
    rest = [k for k in keys if k not in alone]
    loads = [0] * (len(firsts) + 1)
    for k in rest:
        loads[sum(k >= f for f in firsts)] += sizes[k]
    assert len(alone) + len(loads) <= shards or not rest
    if rest:
        assert max(loads) == best([sizes[k] for k in rest], shards - len(alone))
    left, total = shards, sum(sizes.values())
    for k in alone:  # larger than a fair share of what the ones before left
        assert sizes[k] * left > total
        left, total = left - 1, total - sizes[k]


@pytest.mark.parametrize("shards", [24, 3, 500])
def test_rows(docs, rows, shards):
    out = op.shard(docs, shards).collect()
    want = sorted(((r[0], (len(r[1].encode()) if r[1] else 0) + 8, zlib.crc32((r[1] or "").encode())) for r in rows), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in out), key=repr) == want
    assert {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    by_text = {}
    for r in out:
        by_text.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert max(len(v) for k, v in by_text.items() if k[0]) == 1


def test_no_documents(no_docs):
    assert got(op.shard(no_docs), "doc_id") == []
