"""What the engine needs of a Spark session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> None:
    """Turns filter pushdown into Python sources on, and lets Python workers import this package."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (here, env.get("PYTHONPATH", "")) if x)
