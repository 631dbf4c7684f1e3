"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigrid.llm.blocks import held_out
from verdigrid.shared import written


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, rows: int) -> DataFrame:
    """doc_id, text, label (0/1), place: at most ``rows`` documents, written once.

    Held-out ids, null ids and null labels are left out. The sample is the ids with
    the smallest hashes among those in ``docs``, so it does not depend on layout, nor on
    labels of other documents. Repeated label rows of an
    id count as its largest label, repeated documents as their smallest text; a null
    text is an empty one.
    """
    present = docs.select(docs["doc_id"].cast("long").alias("doc_id")).distinct()
    ids = (
        labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[target].alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max((F.col("label") > 0).cast("int")).alias("label"))
        .join(present, "doc_id", "left_semi")
        .withColumn("place", F.xxhash64("doc_id"))
        .orderBy("place", "doc_id")
        .limit(rows)
    )
    texts = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    )
    # ``rows`` ids at most: small enough to broadcast whatever the tables hold.
    found = texts.join(F.broadcast(ids), "doc_id")
    return written(
        found.groupBy("doc_id").agg(
            F.min("text").alias("text"),
            F.first("label").alias("label"),
            F.first("place").alias("place"),
        ),
        "labelled-sample",
    )
