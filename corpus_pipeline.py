"""A training-corpus pipeline: quality classifier, near-duplicates, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; every one but the last returns rows of documents with
all their columns. Its result is written as Parquet and read again as the next one's docs.

Nulls and edge cases: a null or empty text is scored like any other and goes if its score is low; null texts are no
copies of each other and hold no passages; a null doc_id is kept; of rows that repeat one stays; an empty table of
documents gives no rows, an empty benchmark removes none; columns of any name besides doc_id and text are carried through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm import decontamination, neardup, packing, quality
from tidewire.llm.common import read_table, stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least the threshold."""
    return quality.keep_good(docs, quality.train_on(docs, read_table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of any benchmark item."""
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: No SQL: the stages aren't expressible in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after another, over documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
