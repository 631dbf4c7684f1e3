"""The corpus pipeline: from raw documents to packed training bins.

Stages run in order, each on all that its predecessor kept; every result but the last
has the columns of ``documents``.

1. ``quality_rules`` drops documents that the repetition rules reject.
2. ``toxicity`` drops documents that the noisy-channel classifier calls toxic.
3. ``near_duplicates`` keeps one document of each SimHash group, the smallest id.
4. ``secrets`` masks secrets inside the texts; no document goes.
5. ``packing`` places the remaining texts in bins: one row per piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verdigrid.llm.packing import pack
from verdigrid.llm.repetition import keep_sound
from verdigrid.llm.secrets import mask_secrets
from verdigrid.llm.simhash import keep_one_each
from verdigrid.llm.toxicity import fit_toxicity, keep_civil
from verdigrid.shared import written


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_sound(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_civil(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("packing", packing),
]

#: Toxicity scores and fingerprints are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every stage but the last becomes a Parquet table."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
