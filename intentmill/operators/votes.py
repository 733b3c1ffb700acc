"""Agreement between several replies to one query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentmill.options import CLASSES


def vote(replies: DataFrame, allowed: tuple[str, ...] = CLASSES) -> DataFrame:
    """One label per (qid, attempt): most votes, then mean, then highest confidence,
    then the first seen. Its confidence is the mean over the winner's votes.

    The label set is closed, so each label gets its own counters in one aggregate. All
    counters are fixed-size numbers: a query with very many replies is reduced to one
    row in every map task, and there is one shuffle. Confidences are summed as whole
    millionths and the millionths of those, so the sums do not depend on row order.
    """
    label, confidence = F.col("ai_label"), F.col("ai_confidence")
    counters, standings = [], []
    for i, name in enumerate(allowed):
        mine = label == F.lit(name)
        counters += [
            F.count_if(mine).alias(f"n{i}"),
            F.sum(F.when(mine, F.col("micro")).otherwise(0)).alias(f"micro{i}"),
            F.sum(F.when(mine, F.col("pico")).otherwise(0)).alias(f"pico{i}"),
            F.max(F.when(mine, confidence)).alias(f"top{i}"),
            F.min(F.when(mine, F.col("vote"))).alias(f"first{i}"),
        ]
        n = F.col(f"n{i}")
        mean = (F.col(f"micro{i}") + F.col(f"pico{i}") / 1e6) / (n * F.lit(1e6))
        standings.append(
            F.when(
                n > 0,
                F.struct(
                    n.alias("votes"),
                    F.when(n == 1, F.col(f"top{i}")).otherwise(mean).alias("mean"),  # one vote stands as it is
                    F.col(f"top{i}").alias("top"), (-F.col(f"first{i}")).alias("first"), F.lit(name).alias("label"),
                ),
            )
        )
    micro = F.floor(confidence * F.lit(1e6))
    return (
        replies.select("qid", "attempt", "vote", "ai_label", "ai_confidence", micro.alias("micro"))
        .withColumn("pico", F.round((confidence * F.lit(1e6) - F.col("micro")) * F.lit(1e6)).cast("bigint"))
        .groupBy("qid", "attempt")
        .agg(*counters)
        .select("qid", "attempt", (F.greatest(*standings) if len(standings) > 1 else standings[0]).alias("best"))
        .select(
            "qid", "attempt", F.col("best.label").alias("ai_label"), F.col("best.mean").alias("ai_confidence"),
            F.col("best.votes").alias("votes"),
        )
    )
