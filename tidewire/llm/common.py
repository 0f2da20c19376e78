"""What the corpus operators share: the shared folder, staged tables, row keys."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: list[str] = []
_RUN = uuid.uuid4().hex[:12]


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is read from ``spark.checkpoint.dir``. Only a local session without that setting, as in tests, gets a folder
    of its own; on a cluster a machine's own folder would lose data, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not (spark.conf.get("spark.master", None) or "local").split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="tidewire-"))
        atexit.register(shutil.rmtree, _LOCAL[0], True)
    return f"file://{_LOCAL[0]}"


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/tidewire/{_RUN}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes df below the shared folder and reads it again: the lineage ends there, and a lost executor costs no rerun."""
    spark = df.sparkSession
    path = staged_path(spark, name)
    writer = df.write
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[path] = spark
    return out


_PATHS: dict[str, SparkSession] = {}


def unstage(df: DataFrame) -> None:
    """Deletes a staged table that nothing reads any more, and lets Spark drop the shuffles that led to it."""
    spark = df.sparkSession
    files = df.inputFiles()
    path = next((p for p in _PATHS if files and p.split("://")[-1].split(":")[-1] in files[0]), None)
    if path is not None:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)
        del _PATHS[path]
    forget_shuffles(spark)


def forget_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the files of shuffles that no plan refers to any more: it does so when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_staged(spark: SparkSession) -> None:
    """Deletes every staged table of this process. Results that still read them can't be evaluated afterwards."""
    jvm = spark.sparkContext._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for path in list(_PATHS):
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
        del _PATHS[path]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text; null for null."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def row_hash(text: Column) -> Column:
    """A hash of a row's text; with the id it tells rows apart that share an id or lack one."""
    return F.xxhash64(text, F.isnull(text))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % n


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package wherever the driver found it, and keeps the batches they get small."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "6m")
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (here, env.get("PYTHONPATH", "")) if x)


#: A key is hot if it has more than one in HOT_SHARE of all rows and over HOT_LEAST; so there are fewer than HOT_SHARE.
HOT_SHARE, HOT_LEAST, SALTS = 2_000, 1_000, 32


def hot_from(total: int) -> int:
    """The rows of a key, of so many in all, from which it is hot."""
    return max(HOT_LEAST, total // HOT_SHARE) + 1


def salted_join(left: DataFrame, right: DataFrame, on: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """left joined with right, the left rows of the keys in hot dealt to many tasks, each with those keys' right rows.

    hot: rows with the column ``on``, distinct, of fewer than HOT_SHARE keys, so it is broadcast. Left rows are dealt
    by their number, which a task that runs again gives again, as its input is a staged table.
    """
    if not hot.limit(1).count():
        return left.join(right, on, how)
    keys = hot.select(F.col(on).alias("hot_key"))
    mark = lambda df: df.join(F.broadcast(keys), df[on] == F.col("hot_key"), "left")
    is_hot = F.col("hot_key").isNotNull()
    dealt = mark(left.withColumn("row_number", F.monotonically_increasing_id())).withColumn("salt", F.when(is_hot, F.pmod("row_number", F.lit(SALTS))).otherwise(0).cast("int")).drop("hot_key", "row_number")
    spread = mark(right).withColumn("salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("hot_key")
    return dealt.join(spread, [on, "salt"], how).drop("salt")
