"""A corpus cleaned in stages: each works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from goldkeel.llm import stages
from goldkeel.llm.common import table
from goldkeel.session import scratch_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", stages.drop_toxic),
    ("simhash_near_dedup", stages.one_of_each_group),
    ("benchmark_decontamination", stages.drop_contaminated),
    ("pii", stages.mask_personal_data),
    ("byte_bpe", stages.encode_tokens),
]

# Learned weights, alignments and merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        path = scratch_folder(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
