import random
import zlib
from collections import Counter

import numpy as np
import pytest
from made import got
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewire.llm import packing as op

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(op.default_tokenizer())


def test_word_by_word_is_the_whole(tokenizer, rows):
    odd = ["", " ", "á é", "İstanbul ΑΣ ΣΑΣ Straße", "don't I'll\nwe've", "x<|endoftext|>y <|startoftext|>", "1234 ½ ²", " a\xa0b　c", "ﬁ ǆ", "a.b,c. d., e,. ,", "\x00\x01 �", "漢字かな 🙂👍🏽", "µm ªº ÀÉÎ straße... x×y ÷ a'b 'tis é' ÿÿ Ÿ a.b a1 é² don't. naïve-- <| a<| a_b _a a_ a` ﬁ. Été!!! %%% ÑANDÚ"]
    for text in odd + [r[1] for r in rows]:
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        assert np.frombuffer(op.ids_of(text, op.default_tokenizer()), "<u4").tolist() == want


def test_odd_strings(tokenizer):
    """Capital letters whose lower case ends in a mark, combining marks, old and new letters, digits, quotes, special tokens."""
    rng = random.Random(4)
    pool = [*"İıſΣςßÀéñǅŉΐ", "\u0307", "\u0301", "\u0345", "ẞ", "ﬁ", "K", "Å", "中", "ก", "\u0e31", "ﷺ", "\u1c89", "\ua7cb", "𐐀", "٣", "½", *"aZx09'\"\"..,;-_<|>", "'s", "'ll", " ", " ", "\n", "\u00a0", "\u2028", "<|endoftext|>"]
    assert op.ids_of("", op.default_tokenizer(), None) == b"" and op._WORDS[op.default_tokenizer()].by_word
    texts = ["Saat 5'te İ. Yılmaz ve Aİ, geldi.", 'İ."'] + ["".join(rng.choices(pool, k=rng.randint(1, 9))) for _ in range(100_000)]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, w in zip(texts, want) if np.frombuffer(op.ids_of(t, op.default_tokenizer(), None), "<u4").tolist() != w] == []


def test_other_tokenizers():
    """A tokenizer that doesn't treat words alone gets whole texts."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    other = tokenizers.Tokenizer.from_file(path)
    for text in ("two  words\n\n here.", "İ. <|endoftext|> x", "", None):
        want = other.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(op.ids_of(text, path, None), "<u4").tolist() == want
    assert not op._WORDS[path].by_word


@settings(deadline=None, max_examples=100)
@given(st.text(max_size=60))
def test_any_text(text):
    t = tokenizers.Tokenizer.from_file(op.default_tokenizer()) if not hasattr(test_any_text, "t") else test_any_text.t
    test_any_text.t = t
    assert np.frombuffer(op.ids_of(text, op.default_tokenizer(), None), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


@settings(deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500)))
def test_histogram_is_placed_whole(histogram):
    patterns = op.pack_histogram(histogram, 64)
    placed = Counter()
    for p in patterns:
        assert p.count > 0 and p.total == sum(n * k for n, k in p.parts) <= 64
        for n, k in p.parts:
            placed[n] += k * p.count
    assert placed == Counter(histogram)
    least = -(-sum(n * k for n, k in histogram.items()) // 64)
    assert sum(p.count for p in patterns) <= 2 * least + 1  # at most one sequence is less than half full


def test_shortest_pack_first():
    patterns = op.pack_histogram({40: 2, 50: 1, 10: 3, 4: 1}, 64)
    assert sorted((p.total, p.count) for p in patterns) == [(54, 1), (60, 1), (60, 1)] or sum(p.count for p in patterns) == 3
    assert any((40, 1) in p.parts and (10, 1) in p.parts for p in patterns)


@pytest.mark.parametrize("capacity", [2048, 16])
def test_pieces(docs, rows, tokenizer, capacity):
    out = op.pack(docs, capacity).collect()
    ids = {}
    for doc, text, *_ in rows:
        ids.setdefault(doc, []).append(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])
    pieces = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out)
    want = Counter()
    for doc, every in ids.items():
        for x in every:
            for at in range(0, len(x), capacity):
                part = x[at : at + capacity]
                want[doc, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(x)] += 1
    assert pieces == want
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in out)
    assert sorted(by_sequence) == list(range(len(by_sequence))) and len(by_sequence) <= 1.3 * total / capacity + 1


@pytest.mark.parametrize("hot", [1400, 1100])
def test_hot_length(hot):
    """A third of the pieces have one length and the others are spread evenly; or all are just over half a sequence."""
    spread = {n: 100 for n in range(1, 2049)} if hot == 1400 else {1030 + i: 10 for i in range(500)}
    histogram = spread | {hot: spread[hot] + sum(spread.values()) // 2}
    patterns, parts = op.plan(histogram)
    sequences, total = sum(p.count for p in patterns), sum(n * k for n, k in histogram.items())
    assert sum(p.total * p.count for p in patterns) == total
    assert all(p.total == sum(n * k for n, k in p.parts) <= 2048 for p in patterns)
    assert sequences <= 1.03 * total / 2048 + 1


def test_lengths_that_do_not_combine():
    """10,000 documents of 1,030 ids: under 1 % padding."""
    patterns, _ = op.plan({1030: 10_000})
    assert sum(p.total * p.count for p in patterns) == 1030 * 10_000
    assert sum(p.count for p in patterns) <= 1030 * 10_000 / 2048 / 0.99


def test_cut_again(spark, tokenizer):
    """Every id stands once, in its place, when pieces are cut again; sequences are nearly full."""
    vocabulary = "one two three four five six seven eight nine ten".split()
    texts = [" ".join(vocabulary[(i * j + j // 3) % 10] for j in range(1100 + i % 7)) for i in range(60)] + ["one two"] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = op.pack(df).collect()
    ids = [np.array(tokenizer.encode(t, add_special_tokens=False).ids + [1], "<u4") for t in texts]
    for doc, x in enumerate(ids):
        at = 0
        for r in sorted((r for r in out if r.doc_id == doc), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(x) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(x[at : at + r.length].tobytes())
            at += r.length
        assert at == len(x)
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) <= 1.05 * sum(map(len, ids)) / 2048 + 1


def test_no_documents(no_docs):
    assert got(op.pack(no_docs), "doc_id") == []
