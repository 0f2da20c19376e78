import random

import pytest
from made import CLASHES, SCHEMA, corpus, prose


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHES}).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def benchmark_rows(rows):
    rng = random.Random(9)
    texts = [r[1] for r in rows]
    cut = lambda t, a, b: " ".join(t.split(" ")[a:b])
    long = max((t for t in texts if t), key=len)
    return [(1, cut(texts[66], 3, 25)), (2, cut(texts[0], 0, 12)), (3, prose(rng, 20)), (4, "two, WORDS"), (5, None), (6, ""), (7, cut(long, 29_000, 29_030)), (7, cut(long, 29_000, 29_030)), (8, cut(texts[66], 5, 22)), (None, cut(texts[0], 0, 12)), (9, "...")]


@pytest.fixture(scope="session")
def items(spark, benchmark_rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(benchmark_rows, "item_id long, text string").withColumn("phrase", F.lit("clash")).withColumn("words", F.lit(1))
