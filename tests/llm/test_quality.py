import zlib

import numpy as np
import pyarrow as pa
import pytest
from made import got, prose

from tidewire.llm import boosting
from tidewire.llm import quality as op


def test_trees_learn_and_flatten():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = boosting.fit(x[:2000], y[:2000])
    assert ((forest.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95

    def walk(row):
        total = forest.bias
        for at in forest.roots:
            while not forest.leaf[at]:
                at = forest.left[at] + (row[forest.feature[at]] > forest.threshold[at])
            total += forest.value[at]
        return total

    assert np.allclose([walk(r) for r in x[:50]], forest.raw(x[:50]))


def test_trees_without_much_to_learn():
    assert len(boosting.fit(np.zeros((0, 3)), np.zeros(0)).roots) == 0
    assert boosting.fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (boosting.fit(np.ones((9, 3)), np.ones(9)).score(np.ones((1, 3))) > 0.8).all()
    assert np.isfinite(boosting.fit(np.ones((9, 3)), np.arange(9) % 2).score(np.full((1, 3), np.nan))).all()


def test_features_of_whole_texts():
    x = op.features(pa.array([None, "", "a", "!!! A\n\nA b b\n A", "x " * 100_000]))
    name = {n: i for i, n in enumerate(op.FEATURES)}
    assert x.shape == (5, len(op.FEATURES)) and np.isfinite(x).all() and not x[0].any() and not x[1].any()
    assert x[4, name["log_words"]] == pytest.approx(np.log1p(100_000)) and x[4, name["top_word"]] == 1
    assert x[3, name["share_bang"]] == pytest.approx(3 / 15) and x[3, name["repeated_lines"]] == 0
    assert x[3, name["distinct_words"]] == pytest.approx(3 / 6)
    alone = [op.features(pa.array([t]))[0] for t in ("a b. C", "é é")]
    assert np.array_equal(op.features(pa.array(["a b. C", "é é"])), np.array(alone))
    lines = op.features(pa.array(["same line\nsame line\nother"]))
    assert lines[0, name["repeated_lines"]] == pytest.approx(1 / 3)


@pytest.fixture(scope="module")
def labelled(spark):
    import random

    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(20, 90)) if i % 3 else prose(rng, 30).upper().replace(" ", "!! "), i) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "x", "y", len(t)) for i, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i, _, _ in rows] + [(None, 1, 0), (5, None, 0), (7, 1, 1), (9999, 0, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_rows(labelled, docs, rows, no_docs):
    texts, labels = labelled
    found = op.featurise(texts)
    forest = op.train(found, labels)
    out = op.score(found, forest).collect()
    assert {(r.doc_id, r.held_out) for r in out} == {(i, zlib.crc32(str(i).encode()) % 5 == 0) for i in range(300)}
    assert all(r.predicted == (r.score >= 0.3) == (r.doc_id % 3 > 0) for r in out if r.held_out)
    again = op.train_on(texts, labels)
    assert np.array_equal(again.threshold, forest.threshold) and np.array_equal(again.value, forest.value)
    every = op.score(op.featurise(docs), forest)
    assert sorted(map(str, (r.doc_id for r in every.collect()))) == sorted(str(r[0]) for r in rows)
    assert op.score(op.featurise(no_docs), forest).count() == 0
    assert op.train(op.featurise(no_docs), labels).score(np.zeros((1, len(op.FEATURES)))).tolist() == [0.5]


def test_keep_good(labelled, docs):
    texts, labels = labelled
    forest = op.train_on(texts, labels)
    kept = op.keep_good(texts, forest)
    assert kept.columns == texts.columns and {r.doc_id for r in kept.collect()} == {i for i in range(300) if i % 3}
    wide = op.keep_good(docs, forest)
    scores = op.score(op.featurise(docs), forest)
    assert wide.columns == docs.columns and wide.count() == scores.filter("predicted = 1").count()


def test_labels_of_the_held_out_fold_change_nothing(labelled):
    from pyspark.sql import functions as F

    texts, labels = labelled
    other = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    found = op.featurise(texts)
    assert np.array_equal(op.train(found, labels).value, op.train(found, other).value)
    assert got(op.score(found, op.train(found, labels)), "doc_id", "score") == got(op.score(found, op.train(found, other)), "doc_id", "score")
