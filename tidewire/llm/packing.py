"""Packing documents into training sequences: shortest-pack-first over the length histogram.

1. One pass tokenizes every document and cuts it into pieces of at most the capacity. A piece's row holds its length
   and its rank among the pieces of that length in its input partition; the rows go to a table in the shared folder.
2. The histogram of lengths (at most ``capacity`` rows) goes to the driver, which places lengths longest first: the
   pieces of a length go to the shortest packs that they fit in, and what fits nowhere opens new packs. It moves
   counts between packing patterns, never single pieces, so the work depends on the capacity and not on the input.
   If that leaves over ``PADDING`` of the sequences empty, pieces of the emptiest packs are cut again, at multiples of
   a 256th of the capacity, to fill the others (``recut``), and the new lengths are placed instead.
3. Each pattern owns runs of ranks of its lengths. A piece finds its run by its length and rank and from it its
   sequence and its offset; the last ranks of a length are those cut again; ranks over partitions come from sums of each partition's counts.

Nulls and edge cases: a null or empty text has no ids but the end id, so it is one piece of length 1; a null id is
kept as it is; rows that repeat are packed as often as they stand there; an empty table gives no rows; a text of any
length is cut into full pieces and one rest, or the rest into several; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import importable, read_table, stage
from .textkernel import batches_by_bytes

CAPACITY = 2048
END_ID = 1
#: The share of empty sequences from which pieces are cut again.
PADDING = 0.005


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: The steps of a tokenizer before its model for which words can be looked up one by one.
_STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


class _WordIds(dict):
    """Ids of a piece of text without ASCII white space, as little-endian bytes.

    The tokenizer splits at white space and treats the parts alone, so a word's ids don't depend on its neighbours.
    Two generations of words are held, so memory is bounded and frequent words stay. ``by_word`` says whether this
    holds for the tokenizer given; if not, whole texts are encoded.
    """

    def __init__(self, path: str, most: int = 400_000):
        from tokenizers import Tokenizer

        super().__init__()
        tokenizer = Tokenizer.from_file(path)
        steps = json.loads(tokenizer.to_str())
        self.by_word = all(steps[k] == v for k, v in _STEPS.items()) and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in steps["added_tokens"])
        self.encode, self.model, self.most, self.old = tokenizer.encode, tokenizer.model.tokenize, most, {}
        self[""] = b""

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._ids(word)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
            self[""] = b""
        self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        if word[-1].isalpha():
            if word.isalpha() and max(word) <= "ÿ":
                # such letters pass every step before the model one by one: lower case, then byte by byte
                small = word.lower()
                if small != word:
                    return self[small]
                return struct.pack(f"<{len(ids := self.model(small.translate(_BYTE_LEVEL)))}I", *(t.id for t in ids))
        elif (m := _MARKED.fullmatch(word)) and _stay_letters(m[1]):
            return self[m[1]] + self[m[2]]  # the tokenizer splits letters from marks
        return self.whole(word)

    def whole(self, text: str) -> bytes:
        return struct.pack(f"<{len(ids := self.encode(text, add_special_tokens=False).ids)}I", *ids)


def _stay_letters(word: str) -> bool:
    """Whether a word is letters only after normalisation, too: some lower-case forms end in a combining mark, which
    joins the marks that follow. Letters that are newer than the database used are left to the tokenizer."""
    return all(unicodedata.ucd_3_2_0.category(c)[0] == "L" for c in unicodedata.normalize("NFC", word).lower())


#: Letters, then ASCII marks other than the apostrophe, which the tokenizer joins with what follows.
_MARKED = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")


def _byte_level() -> dict[int, str]:
    """Each Latin-1 character as the model's letters for its UTF-8 bytes: printable bytes are themselves, others follow at 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    letter = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


_BYTE_LEVEL = _byte_level()
_WORDS: dict[str, _WordIds] = {}


def ids_of(text: str | None, path: str, end_id: int | None = END_ID) -> bytes:
    """Ids of a text as unsigned 32-bit little-endian bytes, then the end id."""
    if path not in _WORDS:
        _WORDS[path] = _WordIds(path)
    known = _WORDS[path]
    if not known.by_word:
        ids = known.whole(text) if text else b""
    else:
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if text else ()
        ids = b"".join(map(known.__getitem__, words))
    return ids if end_id is None else ids + np.uint32(end_id).astype("<u4").tobytes()


def grid(capacity: int) -> int:
    """Pieces are cut again at multiples of so many ids."""
    return max(1, capacity // 256)


def _marks(piece: bytes, step: int) -> tuple[int, bytes]:
    """The CRC of a piece, and those of its beginnings of each multiple of step bytes."""
    crcs, crc = [], 0
    for at in range(0, len(piece), step):
        crc = zlib.crc32(piece[at : at + step], crc)
        crcs.append(crc)
    return crc, struct.pack(f"<{len(crcs)}I", *crcs)


def _crc_between(before: int, whole: int, n: int) -> int:
    """The CRC of the last n bytes, from the CRCs of what stands before them and of both."""
    zeros = bytes(n)
    return whole ^ zlib.crc32(zeros, before) ^ zlib.crc32(zeros)


def _cut(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        size = 4 * capacity
        for batch in batches_by_bytes(batches, "text"):
            rows: dict[str, list] = {k: [] for k in ("row", "start", "length", "ids_crc32", "doc_tokens", "nth", "marks")}
            for i, text in enumerate(batch.column("text")):
                ids = ids_of(text.as_py(), path, end_id)
                for at in range(0, len(ids), size):
                    piece = ids[at : at + size]
                    n = len(piece) // 4
                    crc, marks = (zlib.crc32(piece), None) if n == capacity else _marks(piece, 4 * grid(capacity))
                    for k, v in zip(rows, (i, at // 4, n, crc, len(ids) // 4, seen[n], marks)):
                        rows[k].append(v)
                    seen[n] += 1
            took, marks = pa.array(rows.pop("row"), pa.int64()), pa.array(rows.pop("marks"), pa.binary())
            cols = {"doc_id": batch.column("doc_id").take(took)} | {k: pa.array(v, pa.int64()) for k, v in rows.items()}
            yield pa.RecordBatch.from_pydict(cols | {"part": pa.array(np.full(len(took), part, np.int64)), "marks": marks})

    return run


@dataclass
class Pattern:
    """``count`` sequences that hold, in order, ``times`` pieces of each length."""

    total: int
    count: int
    parts: list[tuple[int, int]] = field(default_factory=list)


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Packing patterns for so many pieces of each length, longest first, each to the shortest pack it fits in."""
    open_: dict[int, list[Pattern]] = defaultdict(list)
    for length in sorted((x for x in histogram if histogram[x] > 0), reverse=True):
        left = histogram[length]
        placed: list[Pattern] = []
        totals = sorted(t for t in open_ if t + length <= capacity and open_[t])
        i = 0
        while left and i < len(totals):
            total = totals[i]
            after = totals[i + 1] if i + 1 < len(totals) else capacity
            while left and open_[total]:
                p = open_[total].pop()
                each = max(1, min((capacity - total) // length, -(-(after - total) // length), left // p.count))
                used = min(p.count, left // each)
                if used < p.count:
                    open_[total].append(Pattern(total, p.count - used, list(p.parts)))
                placed.append(Pattern(total + each * length, used, [*p.parts, (length, each)]))
                left -= used * each
            i += 1
            if left and i == len(totals):  # every pack got some; go on with those that still have room
                again = [p for p in placed if p.total + length <= capacity]
                if again:
                    placed = [p for p in placed if p.total + length > capacity]
                    for p in again:
                        open_[p.total].append(p)
                    totals, i = sorted({p.total for p in again}), 0
        if left:
            each = capacity // length
            if left // each:
                placed.append(Pattern(each * length, left // each, [(length, each)]))
            if left % each:
                placed.append(Pattern(left % each * length, 1, [(length, left % each)]))
        for p in placed:
            open_[p.total].append(p)
    return [p for t in sorted(open_, reverse=True) for p in open_[t]]


@dataclass
class Cuts:
    """``count`` pieces of a length that are cut into these."""

    length: int
    count: int
    into: list[int]


def recut(histogram: dict[int, int], patterns: list[Pattern], capacity: int = CAPACITY) -> list[Cuts]:
    """Cuts that dissolve the emptiest packs and fill others with their pieces, until little is left empty."""
    step, total = grid(capacity), sum(n * k for n, k in histogram.items())
    spare = sum(p.count for p in patterns) - total / capacity / (1 - PADDING) - 1
    queue = [[p.total, p.count, p.parts] for p in sorted(patterns, key=lambda p: p.total) if capacity - p.total >= step]
    cuts = []
    while spare > 0 and queue:
        filled, count, parts = queue[0]
        room = (capacity - filled) // step * step
        fills = sum(times * max(1, length // room) for length, times in parts)
        dissolved = max(1, min(count // (fills + 1), int(spare)))
        queue[0][1] -= dissolved
        spare -= dissolved
        for length, times in parts:
            left = dissolved * times
            while left:
                while queue and not queue[0][1]:
                    queue.pop(0)
                if not queue:
                    break
                room, count = (capacity - queue[0][0]) // step * step, queue[0][1]
                each = min(max(1, length // room), count)
                used = min(left, count // each)
                if length > room:
                    rest = length - each * room
                    cuts.append(Cuts(length, used, [room] * each + [rest] * (rest > 0)))
                    spare += used * rest / capacity
                queue[0][1] -= used * each
                left -= used
        while queue and not queue[0][1]:
            queue.pop(0)
    return cuts


def cut_lengths(histogram: dict[int, int], cuts: list[Cuts]) -> tuple[dict[int, int], dict[str, np.ndarray]]:
    """The histogram after the cuts; for each part of a cut, ordered by length and first rank, where it is and its first rank in its own length."""
    after = dict(histogram)
    for c in cuts:
        after[c.length] -= c.count
    kept, first, rows = dict(after), dict(after), []
    for c in cuts:
        at = 0
        for n in c.into:
            rows.append((c.length, first[c.length], at, n, after.get(n, 0)))
            after[n] = after.get(n, 0) + c.count
            at += n
        first[c.length] += c.count
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    assert all(first[n] == histogram[n] for n in kept)
    return after, dict(zip(("length", "first", "at", "part", "rank"), table.T.copy()))


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Pattern], dict[str, np.ndarray]]:
    """Patterns, and the parts of the pieces that are cut again."""
    patterns = pack_histogram(histogram, capacity)
    after, parts = cut_lengths(histogram, recut(histogram, patterns, capacity))
    if len(parts["at"]):
        better = pack_histogram(after, capacity)
        if sum(p.count for p in better) < sum(p.count for p in patterns):
            return better, parts
    return patterns, cut_lengths(histogram, [])[1]


def runs(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Runs of ranks, ordered by length and first rank: the n-th piece of a run goes to sequence base + n % count."""
    rows, given, base = [], defaultdict(int), 0
    for p in patterns:
        offset = 0
        for length, times in p.parts:
            rows.append((length, given[length], base, p.count, offset))
            given[length] += p.count * times
            offset += length * times
        base += p.count
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "base", "count", "offset"), table.T.copy()))


def _cut_again(batch: dict[str, np.ndarray], marks: pa.Array, parts: dict[str, np.ndarray], step: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The rows with the pieces that are cut again replaced by their parts, and for each the row it comes from."""
    keys = parts["length"] * (1 << 48) + parts["first"]
    own, which = np.unique(keys, return_index=True)
    many = np.diff(np.append(which, len(keys)))
    length, rank = batch["length"], batch["rank"]
    lowest = np.full(max(length.max(), parts["length"].max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(lowest, parts["length"], parts["first"])
    cut = rank >= lowest[length]
    group = np.searchsorted(own, length * (1 << 48) + rank, "right") - 1
    n = np.where(cut, many[group], 1)
    row = np.repeat(np.arange(len(length)), n)
    out = {k: v[row] for k, v in batch.items()}
    is_cut = cut[row]
    nth = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))[is_cut]
    part = which[group[row[is_cut]]] + nth
    at, size = parts["at"][part], parts["part"][part]
    out["rank"][is_cut] += parts["rank"][part] - parts["first"][part]
    out["start"][is_cut] += at
    out["length"][is_cut] = size
    crcs = []
    for i, lo, k, whole, all_ in zip(row[is_cut].tolist(), at.tolist(), size.tolist(), batch["ids_crc32"][row[is_cut]].tolist(), length[row[is_cut]].tolist()):
        m = np.frombuffer(marks[i].as_buffer(), "<u4")
        upto = whole if lo + k == all_ else int(m[(lo + k) // step - 1])
        crcs.append(_crc_between(int(m[lo // step - 1]) if lo else 0, upto, 4 * k))
    out["ids_crc32"][is_cut] = crcs
    return row, out


def _place(table: dict[str, np.ndarray], parts: dict[str, np.ndarray], step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # int64 can hold length * 2^48 + rank for every rank that a table can have
        keys = table["length"] * (1 << 48) + table["first"]
        for batch in batches:
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("start", "length", "ids_crc32", "doc_tokens")}
            rows["rank"] = batch.column("nth").to_numpy(zero_copy_only=False) + batch.column("before").to_numpy(zero_copy_only=False)
            doc = batch.column("doc_id")
            if len(parts["at"]) and batch.num_rows:
                row, rows = _cut_again(rows, batch.column("marks"), parts, step)
                doc = doc.take(pa.array(row))
            length, rank = rows["length"], rows.pop("rank")
            at = np.searchsorted(keys, length * (1 << 48) + rank, "right") - 1
            nth = rank - table["first"][at]
            out = {"doc_id": doc} | {c: pa.array(v) for c, v in rows.items()}
            out["sequence_id"] = pa.array(table["base"][at] + nth % table["count"][at])
            out["offset"] = pa.array(table["offset"][at] + length * (nth // table["count"][at]))
            yield pa.RecordBatch.from_pydict(out)

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one for each piece of a document."""
    importable(docs.sparkSession)
    path = tokenizer or default_tokenizer()
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    pieces = stage(docs.select("doc_id", "text").mapInArrow(_cut(path, capacity, end_id), f"doc_id {kind}, {fields}, nth bigint, part bigint, marks binary"), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = stage(counts, "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    patterns, parts = plan(histogram, capacity)
    table = runs(patterns)
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    if not len(parts["at"]):
        pieces = pieces.withColumn("marks", F.lit(None).cast("binary"))
    placed = pieces.join(starts, ["part", "length"])
    return placed.mapInArrow(_place(table, parts, grid(capacity)), f"doc_id {kind}, {fields}, sequence_id bigint, offset bigint")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
