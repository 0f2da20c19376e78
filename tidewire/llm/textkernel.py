"""Vectorised text kernels shared by the corpus operators.

They work on whole Arrow string columns as flat UTF-8 bytes: words are runs of
bytes of a class, hashed eight bytes at a time for all words of a chunk at
once. No Python object is made for a word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=U64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes of the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z is lower-cased.
WORD_BYTES = np.zeros(256, dtype=bool)
WORD_BYTES[ord("0") : ord("9") + 1] = True
WORD_BYTES[ord("a") : ord("z") + 1] = True
WORD_BYTES[128:] = True

#: Bytes of the tokens ``[^\x20\x09-\x0D]+``.
TOKEN_BYTES = np.ones(256, dtype=bool)
TOKEN_BYTES[0x20] = False
TOKEN_BYTES[0x09:0x0E] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def mix_int(x: int) -> int:
    return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], dtype=U64))[0])


@dataclass
class Words:
    """Words of the documents ``first`` to ``first + len(bounds) - 1`` of a column.

    ``bounds`` has a document's first word, and one more entry for the end.
    """

    first: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.ends)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and each row's offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = column.cast(pa.large_string())
    _, off, data = wide.buffers()
    n = len(wide)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64)[wide.offset : wide.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column, kind: np.ndarray = WORD_BYTES, chunk_bytes: int = 1 << 20) -> Iterator[Words]:
    """Words of every row, in chunks of whole rows of about chunk_bytes; a longer row is a chunk of its own."""
    raw, offsets = flat(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + chunk_bytes, "right")) - 1)
        data = LOWER[raw[offsets[lo] : offsets[hi]]]
        off = offsets[lo : hi + 1] - offsets[lo]
        inside = kind[data]
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        heads = off[:-1][off[:-1] < len(data)]
        if len(before):
            before[0] = False
        before[heads] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[:-1] = inside[1:]
        if len(after):
            after[-1] = False
        after[heads[heads > 0] - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        yield Words(lo, data, off, starts, ends, np.searchsorted(starts, off))
        lo = hi


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], eight bytes a round."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    left = ends - starts
    out = left.astype(U64) * U64(0x9E3779B97F4A7C15)
    at, todo = starts, None
    while len(at):
        block = eights[at] & _MASKS[np.minimum(left, 8)]
        if todo is None:
            out = mix(out ^ block)
        else:
            out[todo] = mix(out[todo] ^ block)
        more = left > 8
        todo = np.flatnonzero(more) if todo is None else todo[more]
        at, left = at[more] + 8, left[more] - 8
    return out


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each document, and the bounds of each document's.

    A document of fewer words, but not none, has one run of all its words.
    """
    n = np.diff(bounds)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    out_bounds = np.concatenate([[0], np.cumsum(count)])
    if not out_bounds[-1]:
        return np.zeros(0, U64), out_bounds
    first = np.repeat(bounds[:-1] - out_bounds[:-1], count) + np.arange(out_bounds[-1])
    last = np.repeat(bounds[1:], count)
    out = np.zeros(len(first), U64)
    for i in range(size):
        at = first + i
        there = at < last
        term = np.zeros(len(first), U64)
        if there.all():
            term = hashes[at]
        else:
            term[there] = hashes[at[there]]
        out = out * U64(0x9DDFEA08EB382D69) + term + U64(i + 1)
    return mix(out), out_bounds


def release() -> None:
    """Gives freed memory back to the system: workers are used again, and an executor's share is small."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not glibc


def batches_by_bytes(batches, text: str, most: int = 8 << 20):
    """Splits record batches so that none holds more than about ``most`` bytes of one string column."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        if batch.num_rows < 2 or col.nbytes <= most:
            yield batch
            continue
        offsets = flat(col)[1]
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi
    release()
