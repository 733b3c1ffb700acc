"""The registered queries: each operator over the given tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentmill.functions.replies import parse_judgements, parse_replies
from intentmill.functions.text import canonical_label, normalize_type
from intentmill.operators import annotate, checks, judge, metrics, prepare, prompts, sampling
from intentmill.operators.votes import vote
from intentmill.options import (
    CLASSES, AnnotateOptions, EvalOptions, LoadOptions, ValidateOptions,
)
from intentmill.plans import inputs, run
from intentmill.sources.results import save_step
from intentmill.sources.tables import parse_examples

_EVERY_ROW = EvalOptions(use_judge=True, judge_sample_size=None)
_AUDIT = replace(_EVERY_ROW, judge_mode="audit")


def _digest(text: Column, name: str) -> list[Column]:
    """A long text as its digest and its length."""
    return [F.md5(text).alias(f"{name}_md5"), F.length(text).alias(f"{name}_chars")]


def _labelled_events(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled events; where the reply holds no object the label is missing."""
    parsed = parse_replies(inputs.event_log(spark, folder), CLASSES)
    return parsed.withColumn(
        "ai_label", F.when(~F.col("query").startswith("error"), F.col("ai_label"))
    )


def _votes(spark: SparkSession, folder: str) -> DataFrame:
    return vote(parse_replies(inputs.replies(spark, folder), CLASSES))


def _measured(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.measures(metrics.label_tally(_labelled_events(spark, folder)))


# --- load ---


def load_clean(spark: SparkSession, folder: str) -> DataFrame:
    loaded = prepare.load_queries(inputs.document_log(spark, folder), LoadOptions(split="all"))
    return loaded.select(
        "qid", *_digest(F.col("query"), "query"), "human_label_coarse", "human_label_fine",
        "human_label_gold", "human_label", "data_split", "url",
    )


def split_filter(spark: SparkSession, folder: str) -> DataFrame:
    log = inputs.document_log(spark, folder)
    return prepare.filter_split(log, "EN").select("qid", "data_split", "url")


def random_sample(spark: SparkSession, folder: str) -> DataFrame:
    log = inputs.document_log(spark, folder)
    return sampling.random_sample(log, 200).select("qid", *_digest(F.col("query"), "query"))


def balanced_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The sample is drawn from whole rows; counting reads their ids and labels alone."""
    picked = sampling.sample_queries(inputs.rated_log(spark, folder), 200)
    return picked.select("qid", "label", *_digest(F.col("query"), "query"))


def drop_null_gold(spark: SparkSession, folder: str) -> DataFrame:
    log = prepare.rename_labels(inputs.rated_log(spark, folder))
    return metrics.drop_missing_gold(log).select("qid", "human_label_gold")


# --- annotate ---


def label_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.event_log(spark, folder).select(
        "qid",
        canonical_label(F.col("human_label_gold")).alias("human_label"),
        normalize_type(F.get_json_object(
            F.regexp_extract("raw", r"\{.*\}", 0), "$.type"), CLASSES).alias("ai_label"),
    )


def parse_reply(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_replies(inputs.event_log(spark, folder), CLASSES)
    return parsed.select("qid", "ai_label", "ai_confidence")


def vote_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _votes(spark, folder)


def fewshot_pool(spark: SparkSession, folder: str) -> DataFrame:
    pool = parse_examples(inputs.example_lines(spark, folder))
    return prompts.pick_examples(pool).select("query", "type")


def prompt_zeroshot(spark: SparkSession, folder: str) -> DataFrame:
    asked = prompts.zeroshot_prompts(inputs.turn_log(spark, folder))
    return asked.select(
        "qid", *_digest(F.col("prompt"), "prompt"), *_digest(F.col("system_prompt"), "system")
    )


def prompt_fewshot(spark: SparkSession, folder: str) -> DataFrame:
    shots = prompts.pick_examples(parse_examples(inputs.example_lines(spark, folder)))
    asked = prompts.fewshot_prompts(inputs.turn_log(spark, folder), shots)
    return asked.select("qid", *_digest(F.col("prompt"), "prompt"))


def replay_join(spark: SparkSession, folder: str) -> DataFrame:
    joined = annotate.replay_join(
        inputs.user_log(spark, folder), inputs.replies(spark, folder)
    )
    return parse_replies(joined, CLASSES).select(
        "qid", "query", "attempt", "vote", "ai_label", "ai_confidence"
    )


def rule_annotate(spark: SparkSession, folder: str) -> DataFrame:
    return annotate.rule_annotate(inputs.document_log(spark, folder)).select(
        "qid", "ai_label", "ai_confidence"
    )


def model_replies(spark: SparkSession, folder: str) -> DataFrame:
    labels = CLASSES

    def stand_in(system: str, prompt: str) -> str:
        """Answers by the length of the prompt: a label, a failure, or no object."""
        turn = len(prompt) % 7
        if turn == 5:
            raise TimeoutError
        if turn == 6:
            return "cannot say"
        return f'{{"type": "{labels[turn]}", "confidence": 0.{turn}5}}'

    asked = prompts.zeroshot_prompts(inputs.turn_log(spark, folder)).drop("query")
    return parse_replies(annotate.ask_model(asked, stand_in), CLASSES)


# --- validate ---


def validate_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Labels and confidences as they stand in the replies, so that all flags occur."""
    text = F.regexp_extract("raw", r"\{.*\}", 0)
    rows = inputs.event_log(spark, folder).select(
        "qid",
        F.lit(0).alias("attempt"),
        F.when(F.col("query").startswith("view"), "factual")
        .when(F.col("query").startswith("signup"), "abstain")
        .otherwise(F.get_json_object(text, "$.type"))
        .alias("ai_label"),
        F.get_json_object(text, "$.confidence").cast("double").alias("ai_confidence"),
    )
    return checks.validate_flags(rows).drop("attempt")


def retry_fold(spark: SparkSession, folder: str) -> DataFrame:
    return checks.retry_fold(_votes(spark, folder))


def pending_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without a reply, or with weak ones and a retry left."""
    folded = checks.retry_fold(_votes(spark, folder), ValidateOptions(max_retries=2))
    log = inputs.document_log(spark, folder).select("qid", "query")
    waiting = annotate.pending_requests(log.join(folded, "qid", "left"))
    return prompts.zeroshot_prompts(waiting).select(
        "qid", "attempt", *_digest(F.col("prompt"), "prompt")
    )


def merge_labels(spark: SparkSession, folder: str) -> DataFrame:
    """First attempts, with the second attempts merged into the rows that wait for one."""
    votes = _votes(spark, folder)
    first = checks.validate_flags(votes.where("attempt = 0")).select(
        "qid", "ai_label", "ai_confidence", "needs_retry", F.lit(0).alias("retry_count")
    )
    first = annotate.with_provenance(first, AnnotateOptions(model_name="first"))
    second = AnnotateOptions(model_name="second", prompt_version="v2")
    return annotate.merge_labels(first, votes.where("attempt = 1"), second).select(
        "qid", "ai_label", "ai_confidence", "needs_retry", "retry_count", "model_name",
        "prompt_version",
    )


def _broken_rules(spark: SparkSession, folder: str, fail_fast: bool) -> DataFrame:
    rows = inputs.events(spark, folder).select(
        F.col("event_id").alias("qid"),
        canonical_label(inputs.by_remainder(F.col("user_id"), inputs.GOLD)).alias("label"),
        F.col("cs").cast("double").alias("ai_confidence"),
        "props",
    )
    rules = [
        checks.required("label"),
        checks.one_of("label", CLASSES[:4]),
        checks.within("ai_confidence", 0.0, 1.0),
        checks.matches("props", "[1-9]"),
    ]
    return checks.constraint_errors(rows, rules, fail_fast=fail_fast)


def constraint_errors(spark: SparkSession, folder: str) -> DataFrame:
    return _broken_rules(spark, folder, fail_fast=False)


def constraint_errors_first(spark: SparkSession, folder: str) -> DataFrame:
    return _broken_rules(spark, folder, fail_fast=True)


# --- evaluate ---


def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion(metrics.label_tally(_labelled_events(spark, folder)))


def prf_by_class(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.by_class(
        _measured(spark, folder), "precision", "recall", "f1", "support"
    )


def kappa_overall(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.summary(_measured(spark, folder)).select("cohen_kappa")


def kappa_by_class(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.by_class(_measured(spark, folder), "cohen_kappa")


def prediction_counts(spark: SparkSession, folder: str) -> DataFrame:
    unlabelled = _labelled_events(spark, folder).drop("human_label_gold")
    measured = metrics.measures(metrics.label_tally(unlabelled))
    return metrics.by_class(measured, "support")


def metrics_table(spark: SparkSession, folder: str) -> DataFrame:
    measured, _ = run.evaluate(
        _labelled_events(spark, folder), inputs.judge_replies(spark, folder), _EVERY_ROW
    )
    return metrics.metrics_table(measured)


def summary(spark: SparkSession, folder: str) -> DataFrame:
    measured, _ = run.evaluate(
        _labelled_events(spark, folder), inputs.judge_replies(spark, folder), _AUDIT
    )
    return metrics.summary(measured)


# --- judge ---


def judge_sample(spark: SparkSession, folder: str) -> DataFrame:
    return judge.judge_sample(_labelled_events(spark, folder)).select(
        "qid", "human_label_gold", "ai_label"
    )


def judge_prompt(spark: SparkSession, folder: str) -> DataFrame:
    rows = _labelled_events(spark, folder)
    compare = prompts.judge_prompts(rows, "compare_to_human")
    both = prompts.judge_prompts(
        compare.withColumnRenamed("prompt", "compare").drop("system_prompt"), "audit"
    )
    return both.select(
        "qid", *_digest(F.col("compare"), "compare"), *_digest(F.col("prompt"), "audit")
    )


def _judgements(spark: SparkSession, folder: str, audit: bool) -> DataFrame:
    return parse_judgements(inputs.judge_replies(spark, folder), CLASSES, audit)


def judge_parse(spark: SparkSession, folder: str) -> DataFrame:
    return _judgements(spark, folder, audit=False)


def audit_parse(spark: SparkSession, folder: str) -> DataFrame:
    return _judgements(spark, folder, audit=True)


def judge_rows(spark: SparkSession, folder: str) -> DataFrame:
    return judge.judge_rows(
        _labelled_events(spark, folder), inputs.judge_replies(spark, folder),
        EvalOptions(use_judge=True),
    )


def judge_score(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge.judge_rows(
        _labelled_events(spark, folder), inputs.judge_replies(spark, folder), _EVERY_ROW
    )
    return judge.judge_score(metrics.judge_tally(judged))


def audit_kappa(spark: SparkSession, folder: str) -> DataFrame:
    measured, _ = run.evaluate(
        _labelled_events(spark, folder), inputs.judge_replies(spark, folder), _AUDIT
    )
    return metrics.summary(measured).select("ai_judge_kappa", "judge_score")


# --- whole runs ---


def _replayed(spark: SparkSession, folder: str) -> DataFrame:
    """Documents loaded, labelled from stored replies with retries, and stored whole."""
    log = prepare.load_queries(inputs.rated_log(spark, folder), LoadOptions(split="all"))
    labelled = run.abstain_unanswered(
        run.label_from_replies(log, inputs.replies(spark, folder))
    )
    return save_step(labelled)


def replay_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled table of the run from stored replies, cleaned texts as digests."""
    return _replayed(spark, folder).select(
        "qid", *_digest(F.col("query"), "query"), "human_label_gold", "data_split", "url", "ai_label",
        "ai_confidence", "flags", "needs_retry", "retry_count", "final_type", "model_name", "provider",
        "prompt_version", "taxonomy_version",
    )


def replay_run(spark: SparkSession, folder: str) -> DataFrame:
    """Load documents, label them from stored replies with retries, judge, measure."""
    labelled = _replayed(spark, folder)
    measured, _ = run.evaluate(
        labelled, inputs.user_judge_replies(spark, folder), EvalOptions(use_judge=True)
    )
    return metrics.metrics_table(measured)


def rule_run(spark: SparkSession, folder: str) -> DataFrame:
    """Load documents, label them by cue words, measure; `rule_flags` shows their flags."""
    log = prepare.load_queries(inputs.document_log(spark, folder), LoadOptions(split="all"))
    labelled = annotate.rule_annotate(log, cleaned=True)
    return metrics.metrics_table(metrics.measures(metrics.label_tally(labelled)))


def rule_flags(spark: SparkSession, folder: str) -> DataFrame:
    """How many documents labelled by cue words have which flags, and their characters."""
    log = prepare.load_queries(inputs.document_log(spark, folder), LoadOptions(split="all"))
    labelled = annotate.rule_annotate(log, cleaned=True).withColumn("attempt", F.lit(0))
    return checks.validate_flags(labelled).groupBy("ai_label", "flags", "needs_retry").agg(
        F.count("*").alias("n"), F.sum(F.length("query")).cast("bigint").alias("query_chars")
    )


QUERIES = {
    "load_clean": load_clean,
    "split_filter": split_filter,
    "random_sample": random_sample,
    "balanced_sample": balanced_sample,
    "drop_null_gold": drop_null_gold,
    "label_normalize": label_normalize,
    "parse_reply": parse_reply,
    "vote": vote_labels,
    "fewshot_pool": fewshot_pool,
    "prompt_zeroshot": prompt_zeroshot,
    "prompt_fewshot": prompt_fewshot,
    "replay_join": replay_join,
    "rule_annotate": rule_annotate,
    "model_replies": model_replies,
    "validate_flags": validate_flags,
    "retry_fold": retry_fold,
    "pending_requests": pending_requests,
    "merge_labels": merge_labels,
    "constraint_errors": constraint_errors,
    "constraint_errors_first": constraint_errors_first,
    "confusion": confusion,
    "prf_by_class": prf_by_class,
    "kappa_overall": kappa_overall,
    "kappa_by_class": kappa_by_class,
    "prediction_counts": prediction_counts,
    "metrics_table": metrics_table,
    "summary": summary,
    "judge_sample": judge_sample,
    "judge_prompt": judge_prompt,
    "judge_parse": judge_parse,
    "audit_parse": audit_parse,
    "judge_rows": judge_rows,
    "judge_score": judge_score,
    "audit_kappa": audit_kappa,
    "replay_run": replay_run,
    "replay_labels": replay_labels,
    "rule_run": rule_run,
    "rule_flags": rule_flags,
}
