import os

import pytest

import corpus_pipeline
from tidewire.llm import decontamination, neardup, packing, quality
from tidewire.llm.common import drop_staged, fold, shared_dir, stage
from tidewire.llm.queries import oracle_sql, queries


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, rows, benchmark_rows):
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(benchmark_rows, "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    spark.createDataFrame([(i, int(i % 2), 0) for i in range(0, 80, 3)], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    return str(folder)


def test_stages_alone_and_together(spark, tables):
    """Each stage against what its operator says of its own input; run() gives the same documents."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "near-duplicates", "decontamination", "packing"]
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.schema
    sizes = [docs.count()]
    for (name, f), check in zip(corpus_pipeline.STAGES, (_good, _single, _clean, None)):
        out = f(spark, docs, tables)
        if check is None:
            ids = {r.doc_id for r in out.collect()}
            assert ids == {r.doc_id for r in docs.collect()}
            break
        out = stage(out, "out")
        assert out.schema.names == columns.names
        check(spark, docs, out, tables)
        docs = out
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[1] < sizes[0] + 1
    whole = corpus_pipeline.run(spark, tables)
    assert sorted(str(r.doc_id) for r in whole.collect() if r.start == 0) == sorted(str(r.doc_id) for r in docs.collect())


def _keys(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def _good(spark, before, after, tables):
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    found = quality.featurise(before)
    scores = quality.score(found, quality.train(found, labels)).filter("predicted = 1")
    assert sorted(map(str, (r.doc_id for r in scores.collect()))) == sorted(str(r.doc_id) for r in after.collect())


def _single(spark, before, after, tables):
    classes = {r.class_id for r in neardup.classes(before).filter("key IS NOT NULL").collect()}
    assert {r.doc_id for r in after.filter("text IS NOT NULL").collect()} <= classes
    assert neardup.classes(after).filter("class_size > 1").count() == 0


def _clean(spark, before, after, tables):
    items = spark.read.parquet(f"{tables}/benchmark.parquet")
    bad = {r.doc_id for r in decontamination.contamination(before, items).filter("contaminated OR n_whole > 0").collect()}
    assert bad and _keys(after) == [k for k in _keys(before) if k[0] not in bad]


def test_queries(spark):
    names = sorted(queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and set(oracle_sql()) <= set(names)
    assert corpus_pipeline.ORACLE_SQL is None and packing.CAPACITY == 2048


def test_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = stage(spark.range(3), "numbers")
    assert df.count() == 3
    path = df.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    drop_staged(spark)
    assert not os.path.exists(path)


def test_folds(spark):
    import zlib

    from pyspark.sql import functions as F

    got = spark.createDataFrame([(None,), (0,), (12,), (-3,)], "doc_id long").select("doc_id", fold(F.col("doc_id"), 10).alias("f")).collect()
    assert [r.f for r in got] == [0] + [zlib.crc32(str(i).encode()) % 10 for i in (0, 12, -3)]


DATA = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries()[name](spark, DATA)
    cols = sorted(df.columns)
    want = c.execute(f"SELECT {', '.join(cols)} FROM ({oracle_sql()[name]})").fetchall()
    assert sorted(tuple(r[k] for k in cols) for r in df.collect()) == sorted(want)
