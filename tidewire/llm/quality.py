"""Quality classifier: histogram gradient-boosted trees over statistics of the whole text.

One pass turns every text into ``FEATURES`` (no label, language, source or id goes into them) and stages them. Labels
of the training folds are joined by id; the trees are fitted on the driver to at most ``sample`` labelled rows, taken
in the order of a hash of the id (a bounded sample, as a parameter). Scoring is a second pass over the features.

Nulls and edge cases: a null text is scored as an empty one, whose statistics are all 0; a null id is in fold 0 and so
never trained on; a null label is no label; an id with several labels has the rounded mean; repeated rows are scored
each; an empty table gives no rows; without labels every score is 0.5; texts of any length are read in full; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting
from .common import fold, importable, read_table, stage
from .textkernel import TOKEN_BYTES, U64, batches_by_bytes, flat, mix, words

SAMPLE = 20_000
THRESHOLD = 0.3
FOLDS = 5

_CLASSES = ["lower", "upper", "digit", "space", "newline", "control", "lead", "tail", "stop", "comma", "bang", "bar", "mark", "quote", "bracket", "other"]
_CLASS = np.full(256, _CLASSES.index("other"), np.uint8)
for _name, _bytes in {
    "lower": range(ord("a"), ord("z") + 1), "upper": range(ord("A"), ord("Z") + 1), "digit": range(ord("0"), ord("9") + 1), "space": b" \t", "newline": b"\n", "control": [*range(9), *range(11, 32), 127],
    "tail": range(128, 192), "lead": range(192, 256), "stop": b".?;:", "comma": b",", "bang": b"!", "bar": b"|", "mark": b"#$%&*@^~=+_\\/", "quote": b"'\"`", "bracket": b"()[]{}<>",
}.items():
    _CLASS[list(_bytes)] = _CLASSES.index(_name)

FEATURES = [*(f"share_{c}" for c in _CLASSES), "log_bytes", "log_words", "word_mean", "word_sd", "word_max", "distinct_words", "top_word", "repeated_pairs", "line_mean", "repeated_lines", "last_words"]


def _distinct(doc: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each of n documents: distinct hashes, and the number of times its commonest one occurs."""
    if not len(doc):
        return np.zeros(n), np.zeros(n)
    key = np.sort((doc.astype(U64) << U64(40)) | (hashes >> U64(24)))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    run = np.diff(np.concatenate([first, [len(key)]]))
    of = (key[first] >> U64(40)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, of, run)
    return np.bincount(of, minlength=n).astype(float), top


def features(column) -> np.ndarray:
    """Rows of FEATURES of a string column."""
    raw, offsets = flat(column)
    out = np.zeros((len(offsets) - 1, len(FEATURES)), np.float32)
    for chunk in words(column, TOKEN_BYTES):
        n = len(chunk.bounds) - 1
        size = np.diff(chunk.offsets)
        one = np.maximum(size, 1).astype(float)
        doc = np.repeat(np.arange(n, dtype=np.int64), size)
        lo = offsets[chunk.first]
        kinds = np.bincount(doc * 16 + _CLASS[raw[lo : lo + len(chunk.data)]], minlength=16 * n).reshape(n, 16)
        of, h = chunk.doc_of(), chunk.hashes()
        length = (chunk.ends - chunk.starts).astype(float)
        count = np.diff(chunk.bounds).astype(float)
        some = np.maximum(count, 1)
        mean = np.bincount(of, length, minlength=n) / some
        sd = np.sqrt(np.maximum(0, np.bincount(of, length**2, minlength=n) / some - mean**2))
        longest = np.zeros(n)
        np.maximum.at(longest, of, length)
        distinct, top = _distinct(of, h, n)
        inner = np.flatnonzero(of[1:] == of[:-1])
        pairs = np.bincount(of[inner], minlength=n).astype(float)
        two, _ = _distinct(of[inner], mix(h[inner] + h[inner + 1] * U64(0x9DDFEA08EB382D69)), n)
        # a line's hash: the sum of its words' hashes, each times an odd number for its place in the line
        breaks = np.flatnonzero(chunk.data == 10)
        line = np.searchsorted(breaks, chunk.starts) + of
        heads = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (of[1:] != of[:-1])])) if len(of) else np.zeros(0, np.int64)
        lines = np.zeros(n)
        line_kinds = np.zeros(n)
        if len(heads):
            place = np.arange(len(of)) - np.repeat(heads, np.diff(np.concatenate([heads, [len(of)]])))
            sums = np.add.reduceat(mix(h + place.astype(U64) * U64(0x9E3779B97F4A7C15)), heads)
            lines = np.bincount(of[heads], minlength=n).astype(float)
            line_kinds, _ = _distinct(of[heads], mix(sums), n)
        tail = np.minimum(length[np.maximum(chunk.bounds[1:] - 1, 0)], 50) if len(length) else np.zeros(n)
        out[chunk.first : chunk.first + n] = np.column_stack(
            [kinds / one[:, None], np.log1p(size), np.log1p(count), mean, sd, longest, distinct / some, top / some, np.where(pairs > 0, 1 - two / np.maximum(pairs, 1), 0), count / np.maximum(lines, 1), np.where(lines > 0, 1 - line_kinds / np.maximum(lines, 1), 0), np.where(count > 0, tail, 0)]
        )
    return out


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_by_bytes(batches, "text"):
        x = features(batch.column("text"))
        cells = pa.array(x.reshape(-1))
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fold": batch.column("fold"), "x": pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)), cells)})


def _rows(column) -> np.ndarray:
    return np.asarray(column.flatten(), np.float32).reshape(-1, len(FEATURES))


def featurise(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, fold, x), staged."""
    importable(docs.sparkSession)
    rows = docs.select("doc_id", fold(F.col("doc_id"), FOLDS).alias("fold"), "text")
    return stage(rows.mapInArrow(_featurise, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fold bigint, x array<float>"), "features")


def _marks(labels: DataFrame) -> DataFrame:
    return labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.round(F.avg("quality")).alias("y"))


def train(found: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> boosting.Forest:
    """Trees fitted to at most ``sample`` labelled rows outside fold 0."""
    rows = found.filter("fold <> 0").join(_marks(labels), "doc_id").orderBy(F.xxhash64("doc_id")).limit(sample).select("x", "y").toArrow()
    return _fit(rows)


def train_on(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> boosting.Forest:
    """The same from texts: only those of the sample are turned into features."""
    marks = _marks(labels).filter(fold(F.col("doc_id"), FOLDS) != 0).withColumnRenamed("doc_id", "id")
    there = docs.select("doc_id")
    marks = stage(marks.join(there, marks["id"] == there["doc_id"], "left_semi").orderBy(F.xxhash64("id")).limit(sample), "sample")
    rows = docs.select("doc_id", "text").join(F.broadcast(marks), F.col("doc_id") == F.col("id"), "left_semi")
    found = featurise(rows).join(F.broadcast(marks), F.col("doc_id") == F.col("id"))
    return _fit(found.orderBy(F.xxhash64("doc_id")).select("x", "y").toArrow())


def _fit(rows: pa.Table) -> boosting.Forest:
    return boosting.fit(_rows(rows["x"].combine_chunks()) if rows.num_rows else np.zeros((0, len(FEATURES))), rows["y"].to_numpy())


def score(found: DataFrame, forest: boosting.Forest, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = forest.score(_rows(batch.column("x"))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "held_out": pa.array(batch.column("fold").to_numpy() == 0), "score": pa.array(s), "predicted": pa.array((s >= threshold).astype(np.int32))})

    return found.mapInArrow(run, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, forest: boosting.Forest, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score at least the threshold, with all their columns, in one pass."""
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, "text"):
            if batch.num_rows:
                yield batch.filter(pa.array(forest.score(features(batch.column(batch.schema.get_field_index("text")))) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = featurise(read_table(spark, sf_dir, "documents"))
    return score(found, train(found, read_table(spark, sf_dir, "labels")))
