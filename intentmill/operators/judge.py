"""A second model's verdict on the labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentmill.functions.replies import parse_judgements
from intentmill.functions.text import canonical_label
from intentmill.operators.metrics import any_label, drop_missing_gold, pick_ai_column
from intentmill.operators.sampling import random_sample
from intentmill.options import CLASSES, EvalOptions
from intentmill.sources.results import in_plan, save_step

def judge_sample(rows: DataFrame, options: EvalOptions = EvalOptions()) -> DataFrame:
    """The rows to be judged: a plain sample of those that are evaluated."""
    if options.drop_missing_gold:
        rows = drop_missing_gold(rows, options.human_column)
    return random_sample(rows, options.judge_sample_size, options.judge_seed)


def sample_to_judge(rows: DataFrame, options: EvalOptions = EvalOptions()) -> DataFrame:
    """`judge_sample`, but no rows if labels are compared and no row has a human one."""
    human = options.human_column
    if options.judge_mode != "compare_to_human":
        return judge_sample(rows, options)
    if human not in rows.columns:
        return rows.limit(0)
    if options.drop_missing_gold:  # what is left has a label: nothing more to ask
        known = rows.where(F.col(human).isNotNull())
        return random_sample(known, options.judge_sample_size, options.judge_seed)
    return judge_sample(rows, options).where(any_label(rows, human))


def judge_rows(
    rows: DataFrame, replies: DataFrame, options: EvalOptions = EvalOptions(),
    sample: DataFrame | None = None,
) -> DataFrame:
    """The sampled rows with the judge's parsed replies (qid, raw), one reply per row.

    A row without a reply counts as a failed call. Comparing with human labels needs
    some: without them no row is judged. `sample` is the stored `sample_to_judge`, if
    the caller has drawn it; else a sample of limited size is drawn and stored here.
    """
    audit = options.judge_mode != "compare_to_human"
    human, ai = options.human_column, pick_ai_column(rows, options.ai_columns)
    if sample is None:
        wanted = [c for c in ("qid", "query", human, ai) if c in rows.columns]
        sample = sample_to_judge(rows.select(*wanted), options)
        if options.judge_sample_size is not None:
            sample = save_step(sample)
    columns = [F.col("qid"), canonical_label(F.col(ai)).alias("ai_label")]
    if not audit:
        label = canonical_label(F.col(human)) if human in sample.columns else F.lit(None).cast("string")
        columns.insert(1, label.alias("human_label_gold"))
    if "query" in rows.columns:
        columns.insert(1, F.coalesce(F.col("query"), F.lit("")).alias("query"))
    base = sample.select(*columns)

    if options.judge_sample_size is not None:  # a few of many replies; the plan knows the sample's size
        replies = replies.join(base.select("qid"), "qid", "left_semi")
    answered = base.join(replies.select("qid", "raw"), "qid", "left").select(
        *base.columns, F.coalesce("raw", F.lit("")).alias("raw")
    )
    return parse_judgements(answered, options.allowed, audit)


def both_tallies(
    rows: DataFrame, replies: DataFrame, options: EvalOptions = EvalOptions()
) -> DataFrame:
    """Label pairs and verdicts of one read, for `measures`, if every row may be judged.

    Rows meet the judge's replies (qid, raw), one reply per row, once; each reply is parsed
    once, and one aggregate counts what both tallies need. It has at most a few hundred rows,
    so which of them the judge was asked for (see `sample_to_judge`) is settled on it: whether
    any row has a human label needs no look at the table.
    """
    audit, human = options.judge_mode != "compare_to_human", options.human_column
    gold = F.col(human) if human in rows.columns else F.lit(None).cast("string")
    base = rows.select(
        "qid", gold.isNotNull().alias("has_gold"), canonical_label(gold).alias("y"),
        canonical_label(F.col(pick_ai_column(rows, options.ai_columns))).alias("p"),
    )
    answered = base.join(replies.select("qid", "raw"), "qid", "left").select(
        "has_gold", "y", "p", F.coalesce("raw", F.lit("")).alias("raw")
    )
    judged = parse_judgements(answered, options.allowed, audit)
    known = lambda label: F.when(label.isin(*options.allowed), label)
    counts = judged.groupBy(
        "has_gold", known(F.col("y")).alias("y"), known(F.col("p")).alias("p"),
        F.col("y").eqNullSafe(F.col("p")).alias("same"),
        known(F.col("judge_label") if audit else F.lit(None).cast("string")).alias("judge_y"),
        (F.col("judge_decision") == "correct").alias("approved"),
    ).agg(F.count(F.lit(1)).alias("n"))

    any_gold = F.max("has_gold").over(W.partitionBy(F.lit(0)))
    if options.drop_missing_gold:
        asked = F.col("has_gold") | ~any_gold if audit else F.col("has_gold")
    else:
        asked = F.lit(True) if audit else any_gold
    no = F.lit(False)
    pair = F.struct(
        no.alias("verdict"), (F.col("has_gold") if options.drop_missing_gold else F.lit(True)).alias("kept"),
        "has_gold", "y", "p", "same", "n",
    )
    verdict = F.struct(
        F.lit(True).alias("verdict"), no.alias("kept"), no.alias("has_gold"), F.col("judge_y").alias("y"),
        "p", F.col("approved").alias("same"), "n",
    )
    both = F.array(pair, F.when(F.col("asked"), verdict))
    return (
        counts.withColumn("asked", asked).select(F.explode(both).alias("c")).where("c is not null").select("c.*")
    )


def judge_score(judged_tally: DataFrame, allowed: tuple[str, ...] = CLASSES) -> DataFrame:
    """Share of correct verdicts per model label, and over all of them (`ALL`).

    Labels outside the class list are left out; a class nobody judged has a NULL score.
    """
    shares = (
        "stack(2, p, n, if(same, n, 0L), "
        "'ALL', if(p is null, 0L, n), if(same and p is not null, n, 0L)) "
        "as (class, judged, approved)"
    )
    sums = (
        judged_tally.selectExpr(shares)
        .groupBy("class")
        .agg(F.sum("judged").alias("judged"), F.sum("approved").alias("approved"))
    )
    names = in_plan(
        judged_tally.sparkSession, [{"class": c} for c in (*allowed, "ALL")], {"class": "string"}
    )
    return (
        names.join(sums, "class", "left").na.fill(0, ["judged", "approved"])
        .selectExpr("class", "judged", "approved", "approved / nullif(judged, 0) judge_score")
    )
