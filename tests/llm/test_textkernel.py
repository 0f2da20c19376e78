import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewire.llm import dartminhash
from tidewire.llm.textkernel import TOKEN_BYTES, WORD_BYTES, flat, shingles, words

WORD, TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = st.lists(st.none() | st.text(st.sampled_from("aZ9 .\n\té\u0085\xa0漢`{\x00\x0b"), max_size=40) | st.text(max_size=20), max_size=8)


@settings(deadline=None, max_examples=150)
@given(TEXTS, st.sampled_from([1, 7, 1 << 20]))
def test_words_are_the_pattern_s(texts, chunk):
    for kind, pattern in ((WORD_BYTES, WORD), (TOKEN_BYTES, TOKEN)):
        got, hashes = [], []
        for w in words(pa.array(texts, pa.string()), kind, chunk):
            h = w.hashes()
            for i in range(len(w.bounds) - 1):
                at = slice(w.bounds[i], w.bounds[i + 1])
                got.append([w.data[a:b].tobytes().decode() for a, b in zip(w.starts[at], w.ends[at])])
                hashes += zip(got[-1], h[at].tolist())
        assert got == [pattern.findall((t or "").translate(LOWER)) for t in texts]
        assert len(set(hashes)) == len({w for w, _ in hashes}) == len({h for _, h in hashes})


def test_slices_and_nulls():
    data, offsets = flat(pa.array(["ab", None, "cde", "f"]).slice(1, 2))
    assert data.tobytes() == b"cde" and offsets.tolist() == [0, 0, 3]
    assert flat(pa.chunked_array([["a"], ["b"]]))[0].tobytes() == b"ab" and len(flat(pa.array([], pa.string()))[1]) == 1


def test_shingles():
    h = np.arange(1, 10, dtype=np.uint64)
    s, b = shingles(h, np.array([0, 0, 2, 9]), 5)
    assert b.tolist() == [0, 0, 1, 4] and len(set(s.tolist())) == 4
    again, _ = shingles(h[2:], np.array([0, 7]), 5)
    assert again.tolist() == s[1:].tolist()


def jaccard(rng, share, n):
    both = rng.integers(0, 2**63, int(n * share), dtype=np.uint64)
    a, b = (np.concatenate([both, rng.integers(0, 2**63, n - len(both), dtype=np.uint64)]) for _ in range(2))
    return a, b, len(both) / (2 * n - len(both))


def test_dartminhash_estimates_similarity():
    rng = np.random.default_rng(3)
    for n in (1, 4, 60, 3000):
        for share in (0.0, 0.5, 0.9, 1.0):
            a, b, want = jaccard(rng, share, n)
            s = dartminhash.signatures(np.concatenate([a, b]), np.array([0, n, 2 * n]), 512)
            assert abs((s[0] == s[1]).mean() - want) < 0.11


def test_dartminhash_weights():
    rng = np.random.default_rng(4)
    e = rng.integers(0, 2**63, 200, dtype=np.uint64)
    a, b = rng.gamma(1.0, 2.0, 200) + 0.01, rng.gamma(1.0, 2.0, 200) + 0.01
    s = dartminhash.signatures(np.concatenate([e, e]), np.array([0, 200, 400]), 1024, np.concatenate([a, b]))
    assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.06


def test_dartminhash_repeats_order_and_nothing():
    e = np.array([5, 9, 7], np.uint64)
    s = dartminhash.signatures(np.array([5, 9, 7, 7, 9, 9, 5], np.uint64), np.array([0, 0, 3, 7]), 64)
    assert not s[0].any() and (s[1] == s[2]).all()
    assert (dartminhash.signatures(e[::-1].copy(), np.array([0, 3]), 64)[0] == s[1]).all()
    assert dartminhash.bands(s, 4).shape == (3, 16)
