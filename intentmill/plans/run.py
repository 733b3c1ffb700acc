"""The four steps as one run: load, annotate, validate, evaluate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intentmill.functions.replies import parse_replies
from intentmill.operators.annotate import (
    ask_in_commits,
    pending_requests,
    with_provenance,
)
from intentmill.operators.checks import Rule, constraint_errors, flag_names, retry_fold
from intentmill.operators.judge import both_tallies, judge_rows, sample_to_judge
from intentmill.operators.metrics import (
    judge_tally,
    label_tally,
    measures,
    metrics_table,
    pick_ai_column,
    summary,
)
from intentmill.operators.prepare import load_queries
from intentmill.operators.prompts import annotation_prompts, judge_prompts
from intentmill.operators.votes import vote
from intentmill.options import AnnotateOptions, EvalOptions, LoadOptions, ValidateOptions
from intentmill.sources.results import Steps, input_state, write_summary, write_tsv
from intentmill.sources.tables import check_not_empty, read_query_log


def label_from_replies(
    queries: DataFrame,
    replies: DataFrame,
    annotate: AnnotateOptions = AnnotateOptions(),
    validate: ValidateOptions = ValidateOptions(),
) -> DataFrame:
    """Label queries from stored replies (qid, attempt, vote, raw), retries included.

    Replies are voted on before they meet the queries, so the join sees one row per
    query. Queries without a reply keep a NULL label and are still pending.
    """
    votes = vote(parse_replies(replies, annotate.allowed), annotate.allowed)
    return label_from_votes(queries, votes, annotate, validate)


def label_from_votes(
    queries: DataFrame, votes: DataFrame, annotate: AnnotateOptions, validate: ValidateOptions
) -> DataFrame:
    """As `label_from_replies`, from one voted label per query and attempt."""
    labelled = queries.join(retry_fold(votes, validate), "qid", "left")
    return with_provenance(labelled, annotate)


def abstain_unanswered(
    labelled: DataFrame, validate: ValidateOptions = ValidateOptions()
) -> DataFrame:
    """Give queries that never got a reply the label of a failed call."""
    missing = F.col("ai_label").isNull()
    flags = flag_names(F.lit("abstain"), F.lit(0.0), validate)
    return labelled.withColumns(
        {
            "ai_label": F.coalesce("ai_label", F.lit("abstain")),
            "ai_confidence": F.coalesce("ai_confidence", F.lit(0.0)),
            "final_type": F.coalesce("final_type", F.lit("abstain")),
            "flags": F.when(missing, flags).otherwise(F.col("flags")),
            "needs_retry": F.when(missing, F.lit(False)).otherwise(F.col("needs_retry")),
            "retry_count": F.coalesce("retry_count", F.lit(0)),
        }
    )


def evaluate(
    labelled: DataFrame,
    judge_replies: DataFrame | None = None,
    options: EvalOptions = EvalOptions(),
) -> tuple[DataFrame, DataFrame | None]:
    """The one-row measures, and the judged rows if the judge is on."""
    judged = None
    if options.judge_on:
        if judge_replies is None:
            raise ValueError("the judge is on but has no replies")
        judged = judge_rows(labelled, judge_replies, options)
        if options.judge_sample_size is None:  # every row meets its reply, so one read serves both
            return measures(both_tallies(labelled, judge_replies, options), None, options), judged
    tally = label_tally(labelled, options)
    marks = None if judged is None else judge_tally(judged, options.allowed)
    return measures(tally, marks, options), judged


@dataclass(frozen=True)
class RunResult:
    """Result tables, the number of loaded rows, and what the run was made with."""

    annotations: DataFrame
    metrics: DataFrame
    summary: DataFrame
    n_records: int
    info: dict


def run(
    spark: SparkSession,
    path: str,
    out: str,
    ask: Callable[[str, str], str],
    ask_judge: Callable[[str, str], str] | None = None,
    examples: DataFrame | None = None,
    load: LoadOptions = LoadOptions(),
    annotate: AnnotateOptions = AnnotateOptions(),
    validate: ValidateOptions = ValidateOptions(),
    score: EvalOptions = EvalOptions(),
    rules: list[Rule] | None = None,
) -> RunResult:
    """A whole run from a query-log file to result files under `out`.

    `ask` answers one prompt of the annotator, `ask_judge` one of the judge. Loaded rows
    that break one of the `rules` are listed, not dropped. Every step's table is stored
    before the next step reads it. If the judge is to compare with human labels and there
    are none, it is not asked.

    A run that died goes on, when it is started again with equal input, options and output folder, after
    its last stored step; prompts whose replies were committed are not asked again. What `ask`
    itself does is not seen: name another model in the options, or another folder.
    """
    if score.judge_on and ask_judge is None:
        raise ValueError("the judge is on but cannot be asked")
    steps = Steps(spark, out, input_state(spark, path), asdict(load))
    loaded = check_not_empty(
        steps.table("loaded", lambda: load_queries(read_query_log(spark, path, load.multiline), load))
    )

    if rules:
        steps.table("errors", lambda: constraint_errors(loaded, rules), [(r.path, str(r.broken), str(r.error)) for r in rules])

    votes = None
    labelled = loaded
    tallied = [asdict(annotate), asdict(validate), _state(examples)]
    for attempt in range(validate.max_retries + 1):
        waiting = (
            loaded.select("qid", F.lit(0).alias("attempt"), "query")
            if attempt == 0
            else pending_requests(labelled)
        )
        asked = steps.table(f"requests-{attempt}", lambda: _requests(waiting, annotate, examples), *tallied)
        n = steps.counts[f"requests-{attempt}"]["n_records"]
        if attempt and not n:
            break
        replies = ask_in_commits(steps, f"replies-{attempt}", asked, n, ask, options=annotate)
        new = steps.table(
            f"votes-{attempt}", lambda: vote(parse_replies(replies, annotate.allowed), annotate.allowed)
        )
        votes = new if votes is None else votes.unionByName(new)
        labelled = steps.table(
            f"labelled-{attempt}", lambda: label_from_votes(loaded, votes, annotate, validate)
        )
    last = labelled
    labelled = steps.table(
        "validated", lambda: last, labelled=F.col("ai_label").isNotNull(),
        flagged=F.col("flags") != "", retried=F.col("retry_count") > 0,
    )

    judged = None
    if score.judge_on:
        sample = steps.table("judge-asked", lambda: sample_to_judge(labelled, score), asdict(score))
        questions = judge_prompts(
            sample, score.judge_mode, pick_ai_column(labelled, score.ai_columns), score.human_column,
        ).select("qid", "system_prompt", "prompt")
        verdicts = ask_in_commits(
            steps, "judge-replies", questions, steps.counts["judge-asked"]["n_records"], ask_judge, 1, "", annotate
        )
        judged = steps.table("judged", lambda: judge_rows(labelled, verdicts, score, sample))
    marks = None if judged is None else judge_tally(judged, score.allowed)
    measured = steps.table("measured", lambda: measures(label_tally(labelled, score), marks, score), asdict(score))
    metrics, overall = metrics_table(measured), summary(measured)
    if judged is not None:
        write_tsv(judged, f"{out}/judge_sample.tsv")
    write_tsv(metrics.coalesce(1), f"{out}/metrics_by_class.tsv")
    write_summary(overall, f"{out}/summary.json")
    n_records = steps.counts["loaded"]["n_records"]
    unanswered = [c["unanswered"] for name, c in steps.counts.items() if name.startswith("replies-")]
    info = {
        "input": path, "output": out, "split": load.split, "n_records": n_records, "spark": spark.version,
        "judged": 0 if judged is None else steps.counts["judged"]["n_records"],
        **{key: steps.counts["validated"][key] for key in ("labelled", "flagged", "retried")},
        "unanswered": sum(unanswered),
        "load": asdict(load), "annotate": asdict(annotate), "validate": asdict(validate), "score": asdict(score),
    }
    return RunResult(
        labelled.select("qid", "query", "ai_label", "ai_confidence"), metrics, overall, n_records, info
    )


def _state(examples: DataFrame | None) -> list:
    """What tells one table of few-shot examples from another: rows, and the sum of their hashes."""
    if examples is None:
        return []
    hashes = F.sum(F.xxhash64(*examples.columns).cast("decimal(20,0)"))
    return [str(v) for v in examples.agg(F.count(F.lit(1)), hashes).first()]


def _requests(
    waiting: DataFrame, annotate: AnnotateOptions, examples: DataFrame | None
) -> DataFrame:
    """One prompt per waiting row and vote."""
    votes = F.expr(f"explode(sequence(0L, {max(annotate.votes, 1) - 1}L))")
    prompts = annotation_prompts(waiting, annotate.mode, examples).drop("query")
    return prompts.withColumn("vote", votes)
