"""Reading model and judge replies.

A reply is accepted only if the text is exactly one JSON object. Spark's reader
stops after the first value and ignores what follows, so the object is placed
inside an array inside a wrapper that ends with a marker field: any stray bracket,
second object or trailing text then breaks the wrapper or loses the marker.

The parsed object is a column of its own before its fields are looked at, so that
each reply is parsed once however many expressions use it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentmill.functions.text import canonical_label, resolve_type, strip

_JSON_OPTIONS = {"allowSingleQuotes": "false"}
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# Spark keeps the quotes it reads JSON's unquoted NaN and Infinity with
_NOT_FINITE = r'(?i)^"?[+-]?(inf|infinity|nan)"?$'

RATIONALE_CHARS = 120
UNREADABLE = "unreadable reply"


def json_block(raw: Column) -> Column:
    """The span from the first `{` to the last `}`, or NULL if there is none."""
    block = F.regexp_extract(raw, r"(?s)\{.*\}", 0)
    return F.nullif(block, F.lit(""))


def with_object(df: DataFrame, text: Column, fields: str, name: str) -> DataFrame:
    """Add `text` as a struct of `fields`, NULL unless it is one JSON object."""
    wrapped = F.from_json(
        F.concat(F.lit('{"reply":['), text, F.lit('],"end":1}')),
        f"reply array<struct<{fields}>>, end int",
        _JSON_OPTIONS,
    )
    whole = (F.col("_wrapped.end") == 1) & (F.size("_wrapped.reply") == 1)
    return (
        df.withColumn("_wrapped", wrapped)
        .withColumn(name, F.when(whole, F.get("_wrapped.reply", F.lit(0))))
        .drop("_wrapped")
    )


def to_number(text: Column) -> Column:
    """Stripped text as a double the way Python's float() reads it, else NULL."""
    return (
        F.when(text.rlike(_NUMBER), text.try_cast("double"))
        # NaN clamps to the upper end, like positive infinity
        .when(text.rlike('(?i)^"?-inf'), F.lit(float("-inf")))
        .when(text.rlike(_NOT_FINITE), F.lit(float("inf")))
    )


def clamp(number: Column) -> Column:
    """Into [0, 1]; NULL is 0."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(number, F.lit(0.0))))


def parse_replies(replies: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """Replace `raw` by `ai_label` and `ai_confidence`; failures abstain with 0."""
    keys = [c for c in replies.columns if c != "raw"]
    return (
        with_object(
            replies, json_block(F.col("raw")), "type string, confidence string", "_reply"
        )
        .select(
            *keys,
            canonical_label(F.col("_reply.type")).alias("_type"),
            strip(F.col("_reply.confidence")).alias("_confidence"),
        )
        .select(
            *keys,
            resolve_type(F.col("_type"), allowed).alias("ai_label"),
            clamp(to_number(F.col("_confidence"))).alias("ai_confidence"),
        )
    )


def parse_judgements(
    replies: DataFrame, allowed: tuple[str, ...], audit: bool = False
) -> DataFrame:
    """Replace `raw` by `[judge_label,] judge_decision, judge_confidence, judge_rationale`.

    The whole text must be one JSON object and the confidence, if present, must be
    a number; otherwise the row is incorrect with confidence 0.
    """
    keys = [c for c in replies.columns if c != "raw"]
    fields = "decision string, confidence string, rationale string, judge_label string"
    text = F.when(F.col("raw").rlike(r"(?s)^[ \t\n\r]*\{.*\}[ \t\n\r]*$"), F.col("raw"))
    # an explicit null is not a number, a missing field is 0
    is_null = F.map_contains_key(
        F.from_json("raw", "map<string,string>", _JSON_OPTIONS), "confidence"
    )
    confidence = F.when(F.col("_bare").isNotNull(), to_number(F.col("_bare"))).when(
        F.col("_reply").isNotNull() & ~is_null, F.lit(0.0)
    )
    readable = F.col("_confidence").isNotNull()
    own_label = [
        F.when(readable & F.col("_label").isin(*allowed), F.col("_label"))
        .otherwise(F.lit("abstain"))
        .alias("judge_label")
    ]
    return (
        with_object(replies, text, fields, "_reply")
        .withColumns(
            {
                "_bare": strip(F.col("_reply.confidence")),
                "_decision": canonical_label(F.col("_reply.decision")),
                "_label": canonical_label(F.col("_reply.judge_label")),
            }
        )
        .withColumn("_confidence", confidence)
        .select(
            *keys,
            *(own_label if audit else []),
            F.when(readable & (F.col("_decision") == "correct"), F.lit("correct"))
            .otherwise(F.lit("incorrect"))
            .alias("judge_decision"),
            clamp(F.col("_confidence")).alias("judge_confidence"),
            F.when(
                readable,
                F.substring(
                    F.coalesce(F.col("_reply.rationale"), F.lit("")), 1, RATIONALE_CHARS
                ),
            )
            .otherwise(F.lit(UNREADABLE))
            .alias("judge_rationale"),
        )
    )
