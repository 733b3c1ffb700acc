"""Labelled rows to learn from: a bounded sample, gathered in one task."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentmill.llm.common import held_out, texts


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """doc_id, text, label of at most `rows` labelled documents that are not held out.

    They are those with the smallest hashes of their ids among documents that are there; an id
    with several texts or labels counts once.
    """
    there = texts(docs).select("doc_id").distinct()
    usable = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label"))
    chosen = (
        usable.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label")).join(there, "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    found = texts(docs).join(F.broadcast(chosen), "doc_id")  # `rows` rows at most
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def learned(sample: DataFrame, learn: Callable[[pd.DataFrame], bytes]) -> bytes:
    """What a function makes of the whole sample, run in one task on an executor."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model": [learn(group.sort_values("doc_id", ignore_index=True))]})

    found = sample.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(run, "model binary").first()
    return bytes(found[0]) if found else learn(pd.DataFrame({"doc_id": [], "label": [], "text": []}))
