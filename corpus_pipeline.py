"""A corpus pipeline: quality, near duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept and
returns a frame, which is written as Parquet in the shared folder and read again. All
but the last return the columns of `docs`, further ones included. Missing texts count as
empty; an empty table passes through; a column whose name a stage would use is left as
it is.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentmill.llm import (
    op1_secret_scan,
    op3_quality,
    op5_decontamination,
    op6_packing,
    op10_jaccard_join,
)
from intentmill.llm.common import stored, table

QUALITY_THRESHOLD = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as good, by a model learned from the labels of `docs`."""
    model = op3_quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(op3_quality.quality(F.col("text"), model) >= QUALITY_THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more of 5-word shingles."""
    return op10_jaccard_join.one_of_each(docs, n=5, per_cent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is in benchmark windows."""
    return op5_decontamination.clean_only(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark; n_chars follows the text."""
    safe = docs.withColumn("text", op1_secret_scan.redacted(F.col("text")))
    if "n_chars" in docs.columns:
        safe = safe.withColumn(
            "n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
        )
    return safe.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return op6_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL can't express a learned score, nor the tokenizer's packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that remain of `documents` after all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
