"""Validation: flags, the retry rule, and row constraints."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentmill.options import ValidateOptions


def flag_names(label: Column, confidence: Column, options: ValidateOptions) -> Column:
    """Names of the weaknesses of a label, joined by commas; empty if there are none."""
    sound = F.coalesce(
        label.isin(*options.allowed) & confidence.between(0.0, 1.0), F.lit(False)
    )
    return F.concat_ws(
        ",",
        F.when(~sound, F.lit("invalid_label")),
        F.when(confidence < options.low_confidence, F.lit("low_confidence")),
        F.when(label == "abstain", F.lit("abstain")),
    )


def validate_flags(
    rows: DataFrame, options: ValidateOptions = ValidateOptions(), attempt: str = "attempt"
) -> DataFrame:
    """Add `flags`, and `needs_retry` for flagged rows with a retry left."""
    flagged = rows.withColumn(
        "flags", flag_names(F.col("ai_label"), F.col("ai_confidence"), options)
    )
    return flagged.withColumn(
        "needs_retry",
        (F.col("flags") != "")
        & (F.coalesce(F.col(attempt), F.lit(0)) < options.max_retries),
    )


def retry_fold(votes: DataFrame, options: ValidateOptions = ValidateOptions()) -> DataFrame:
    """One row per query from its attempts, without a loop.

    The first attempt that is not flagged, or that used up the retries, stands. If
    there is none yet, the latest attempt stands and the row still needs a retry.
    Labels are carried as their places in the class list, so every counter is a number
    and the aggregate is a hash aggregate; a label outside the list comes back as NULL.
    """
    classes = F.array(*[F.lit(c) for c in options.allowed])
    flagged = validate_flags(votes, options).withColumn("place", F.array_position(classes, F.col("ai_label")))
    stands = F.when(~F.col("needs_retry"), F.col("attempt"))
    folded = flagged.groupBy("qid").agg(
        F.min(stands).alias("first"),
        F.min_by("place", stands).alias("first_place"),
        F.min_by("ai_confidence", stands).alias("first_confidence"),
        F.max("attempt").alias("last"),
        F.max_by("place", "attempt").alias("last_place"),
        F.max_by("ai_confidence", "attempt").alias("last_confidence"),
    )
    settled = F.col("first").isNotNull()
    pick = lambda name: F.when(settled, F.col(f"first{name}")).otherwise(F.col(f"last{name}"))
    label, confidence = F.get(classes, (F.col("place") - 1).cast("int")), F.col("ai_confidence")
    return (
        folded.select(
            "qid", pick("_place").alias("place"), pick("_confidence").alias("ai_confidence"),
            pick("").cast("int").alias("retry_count"), (~settled).alias("needs_retry"),
        )
        .select(
            "qid", label.alias("ai_label"), "ai_confidence", flag_names(label, confidence, options).alias("flags"),
            "needs_retry", "retry_count", label.alias("final_type"),
        )
    )


@dataclass(frozen=True)
class Rule:
    """A named condition on one column; `broken` is true for rows that violate it."""

    path: str
    broken: Column
    error: Column


def required(path: str) -> Rule:
    return Rule(path, F.col(path).isNull(), F.lit("is missing"))


def one_of(path: str, values: tuple[str, ...]) -> Rule:
    return Rule(
        path, ~F.col(path).isin(*values),
        F.concat(F.col(path), F.lit(" is not one of "), F.lit(", ".join(values))),
    )


def within(path: str, low: float, high: float) -> Rule:
    return Rule(
        path, ~F.col(path).between(low, high), F.lit(f"is not between {low} and {high}")
    )


def matches(path: str, pattern: str) -> Rule:
    return Rule(path, ~F.col(path).rlike(pattern), F.lit(f"does not match {pattern}"))


def constraint_errors(
    rows: DataFrame, rules: list[Rule], row_id: str = "qid", fail_fast: bool = False
) -> DataFrame:
    """One row (row_id, path, error) per violation; NULL only breaks `required`.

    The errors of a row come in the order of their paths.
    `fail_fast` keeps all errors of the smallest bad row id.
    """
    found = F.array(
        *[
            F.when(r.broken, F.struct(F.lit(r.path).alias("path"), r.error.alias("error")))
            for r in rules
        ]
    )
    errors = (
        rows.select(F.col(row_id).alias("row_id"), F.explode(F.sort_array(found)).alias("e"))
        .where("e is not null")
        .select("row_id", "e.path", "e.error")
    )
    if fail_fast:
        first_bad = errors.agg(F.min("row_id")).scalar()
        errors = errors.where(F.col("row_id").eqNullSafe(first_bad))
    return errors
