"""Query logs and replies derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def by_remainder(number: Column, labels: list[str | None]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in labels]), number % len(labels))


GOLD = ["Navigational", "Factual", " Transactional ", "INSTRUMENTAL", "Abstain", None]


def document_log(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as a query log, every column from the one table."""
    return table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("qid"),
        F.col("text").alias("query"),
        by_remainder(F.col("n_chars"), GOLD).alias("label"),
        F.col("lang").alias("level_1"),
        F.col("source").alias("level_2"),
        F.col("lang").alias("data_split"),
        F.col("source").alias("url"),
    )


def rated_log(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a label from their rating; unrated ones have none."""
    quality, toxic = F.col("quality") == 1, F.col("toxic") == 1
    ratings = table(spark, folder, "labels").select(
        "doc_id",
        F.when(quality & ~toxic, "Factual")
        .when(quality & toxic, "Transactional")
        .when(~quality & ~toxic, "Abstain")
        .when(~quality & toxic, "Navigational")
        .alias("label"),
    )
    return (
        table(spark, folder, "documents")
        .join(ratings, "doc_id", "left")
        .select(
            F.col("doc_id").cast("string").alias("qid"),
            F.col("text").alias("query"),
            "label",
            F.col("lang").alias("data_split"),
            F.col("source").alias("url"),
        )
    )


def turn_log(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as short queries."""
    return table(spark, folder, "conversations").select(
        F.concat("conv_id", F.lit("-"), "turn").alias("qid"), F.col("text").alias("query")
    )


def example_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items as JSON lines of few-shot examples."""
    kinds = ["Navigational", "factual ", "Transactional", "instrumental", "abstain"]
    return table(spark, folder, "benchmark").select(
        F.to_json(
            F.struct(
                F.col("text").alias("query"),
                by_remainder(F.col("item_id"), kinds).alias("type"),
            )
        ).alias("value")
    )


def _with_confidence(df: DataFrame) -> DataFrame:
    """Add `cs`: `m` thousandths as text, up to 1.199."""
    return df.withColumn(
        "cs", F.concat(F.expr("m div 1000"), F.lit("."), F.lpad(F.col("m") % 1000, 3, "0"))
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the numbers that replies are made of, `m` and `cs`."""
    m = F.round(F.col("value") * 100).cast("bigint") % 1200
    return _with_confidence(
        table(spark, folder, "events").select(
            "event_id", "user_id", "event_type", "props", m.alias("m")
        )
    )


def _reply_text() -> Column:
    kind, cs = F.col("event_type"), F.col("cs")

    def text(before: str, after: str) -> Column:
        return F.concat(F.lit(before), cs, F.lit(after))

    return (
        F.when(kind == "click", text('Sure: {"type": "nav", "confidence": ', "}"))
        .when(kind == "view", text('{"type": "Informational", "confidence": ', "}"))
        .when(kind == "purchase", text('{"type": "purchase", "confidence": "', '"}'))
        .when(kind == "signup", text('{"type": "how-to", "confidence": ', "} ok"))
        .otherwise(F.lit("no object here"))
    )


def replies(spark: SparkSession, folder: str) -> DataFrame:
    """Many replies per user: (qid, attempt, vote, raw)."""
    return events(spark, folder).select(
        F.col("user_id").cast("string").alias("qid"),
        (F.col("event_id") % 2).cast("int").alias("attempt"),
        F.col("event_id").alias("vote"),
        _reply_text().alias("raw"),
    )


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """Each event as a query with one reply and its user's label."""
    return events(spark, folder).select(
        F.col("event_id").cast("string").alias("qid"),
        F.concat("event_type", F.lit(" "), "props").alias("query"),
        by_remainder(F.col("user_id"), GOLD).alias("human_label_gold"),
        _reply_text().alias("raw"),
    )


def user_log(spark: SparkSession, folder: str) -> DataFrame:
    """Users as queries, with their label."""
    users = table(spark, folder, "events").select("user_id").distinct()
    return users.select(
        F.col("user_id").cast("string").alias("qid"),
        F.concat(F.lit("user "), "user_id").alias("query"),
        by_remainder(F.col("user_id"), GOLD).alias("human_label_gold"),
    )


def judge_text() -> Column:
    """A judge's reply made of the columns of `events`."""
    m = F.col("m")
    labels = ["navigational", "factual", "transactional", "instrumental", "Abstain", "other"]
    return F.concat(
        F.lit('{"judge_label": "'),
        by_remainder(m, labels),
        F.lit('", "decision": "'),
        by_remainder(m, ["Correct", "incorrect", "maybe"]),
        F.lit('", "confidence": '),
        F.when(m % 7 == 0, F.lit('"high"')).otherwise(F.col("cs")),
        F.lit(', "rationale": "'),
        F.repeat(F.lit("x"), (m % 200).cast("int")),
        F.lit('"}'),
    )


def judge_replies(spark: SparkSession, folder: str) -> DataFrame:
    """One judge reply per event: (qid, raw)."""
    return events(spark, folder).select(
        F.col("event_id").cast("string").alias("qid"), judge_text().alias("raw")
    )


def user_judge_replies(spark: SparkSession, folder: str) -> DataFrame:
    """One judge reply per user, made of their first event."""
    first = events(spark, folder).groupBy("user_id").agg(F.min_by("m", "event_id").alias("m"))
    return _with_confidence(first).select(
        F.col("user_id").cast("string").alias("qid"), judge_text().alias("raw")
    )
