"""Prompts as table columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentmill.functions.text import canonical_label
from intentmill.functions.text import strip
from intentmill.operators.sampling import rank_hash
from intentmill.options import CLASSES

MAX_EXAMPLES = 8
EXAMPLE_SEED = 42

DEFINITIONS = (
    "- navigational: wants to reach a known site, page or app\n"
    "- factual: wants a fact, a meaning or an explanation\n"
    "- transactional: wants to obtain something, such as a purchase, sign-up or download\n"
    "- instrumental: wants to know how to carry something out\n"
    "- abstain: too little or too unclear to tell"
)
_ANSWER = 'Answer with one JSON object: {"type": <label>, "confidence": <number from 0 to 1>}'

SYSTEM_ZEROSHOT = (
    f"You label search queries by intent.\n{DEFINITIONS}\n{_ANSWER}"
)
SYSTEM_FEWSHOT = (
    "You label search queries by intent. Follow the labelled examples; where they do "
    f"not help, use these definitions.\n{DEFINITIONS}\n{_ANSWER}"
)
ASK_ZEROSHOT = "Pick one label for this query: " + ", ".join(CLASSES) + ".\n"
ASK_FEWSHOT = "Now label this query.\n"

JUDGE_SYSTEM = {
    "compare_to_human": (
        "You check intent labels of search queries. Say whether the model's label is "
        "right, given the human label."
    ),
    "audit": (
        "You check intent labels of search queries. Label the query yourself, then say "
        "whether the model's label agrees with yours."
    ),
}
JUDGE_ANSWER = {
    "compare_to_human": (
        'Answer with one JSON object: {"decision": "correct" or "incorrect", '
        '"confidence": <number from 0 to 1>, "rationale": <at most 120 characters>}'
    ),
    "audit": (
        'Answer with one JSON object: {"judge_label": <label>, "decision": "correct" or '
        '"incorrect", "confidence": <number from 0 to 1>, '
        '"rationale": <at most 120 characters>}'
    ),
}


def _quoted(query: Column) -> Column:
    return F.concat(F.lit('Query: "'), F.coalesce(query, F.lit("")), F.lit('"'))


def pick_examples(pool: DataFrame, k: int = MAX_EXAMPLES, seed: int = EXAMPLE_SEED) -> DataFrame:
    """The same k examples every time, with their place in the prompt."""
    digest = rank_hash(seed, "query")
    return (
        pool.select("query", "type", digest.alias("rank"))
        .orderBy("rank", "query", "type")
        .limit(k)
    )


def example_block(shots: DataFrame) -> DataFrame:
    """One row holding the example lines in order; blank examples are left out."""
    query, label = strip(F.col("query")), F.lower(strip(F.col("type")))
    line = F.concat(F.lit('"'), query, F.lit('" -> '), label)
    lines = (
        shots.where((query != "") & (label != ""))
        .select(F.struct("rank", "query", "type", line.alias("line")).alias("e"))
        .agg(F.array_sort(F.collect_list("e")).alias("e"))
    )
    return lines.select(F.array_join(F.col("e.line"), "\n").alias("block"))


def zeroshot_prompts(queries: DataFrame) -> DataFrame:
    return queries.withColumns(
        {
            "system_prompt": F.lit(SYSTEM_ZEROSHOT),
            "prompt": F.concat(F.lit(ASK_ZEROSHOT), _quoted(F.col("query"))),
        }
    )


def fewshot_prompts(queries: DataFrame, shots: DataFrame) -> DataFrame:
    """Every query with the same examples before it.

    The examples are one value, so they enter as a scalar subquery: no join.
    """
    block = example_block(shots).scalar()
    head = F.when(block != "", F.concat(block, F.lit("\n\n"))).otherwise(F.lit(""))
    return queries.withColumns(
        {
            "system_prompt": F.lit(SYSTEM_FEWSHOT),
            "prompt": F.concat(head, F.lit(ASK_FEWSHOT), _quoted(F.col("query"))),
        }
    )


def annotation_prompts(
    queries: DataFrame, mode: str = "zeroshot", pool: DataFrame | None = None
) -> DataFrame:
    """Few-shot prompts only if asked for and there is an example to show."""
    if (mode or "zeroshot").lower() == "fewshot" and pool is not None:
        shots = pick_examples(pool)
        if not shots.isEmpty():
            return fewshot_prompts(queries, shots)
    return zeroshot_prompts(queries)


def judge_prompts(
    rows: DataFrame, mode: str = "compare_to_human", ai_column: str = "ai_label",
    human_column: str = "human_label_gold",
) -> DataFrame:
    """The judge's question about each row, labels in their canonical form."""

    def shown(name: str) -> Column:
        known = canonical_label(F.col(name)) if name in rows.columns else F.lit(None).cast("string")
        return F.coalesce(known, F.lit(""))

    labels = [F.lit("\nModel label: "), shown(ai_column)]
    if mode == "compare_to_human":
        labels = [F.lit("\nHuman label: "), shown(human_column), *labels]
    return rows.withColumns(
        {
            "system_prompt": F.lit(JUDGE_SYSTEM[mode]),
            "prompt": F.concat(
                F.lit(DEFINITIONS + "\n"), _quoted(F.col("query")), *labels,
                F.lit("\n" + JUDGE_ANSWER[mode]),
            ),
        }
    )
