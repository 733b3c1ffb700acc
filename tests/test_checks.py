from pyspark.sql import functions as F

from intentmill.operators.annotate import merge_labels, needs_annotation, pending_requests
from intentmill.operators.checks import (
    constraint_errors, matches, one_of, required, retry_fold, validate_flags, within,
)
from intentmill.options import ValidateOptions

VOTES = "qid string, attempt int, ai_label string, ai_confidence double"


def test_flags(rows):
    cases = {
        ("factual", 0.6): "", ("factual", 0.59): "low_confidence", ("abstain", 0.9): "abstain",
        ("abstain", 0.4): "low_confidence,abstain", ("nav", 0.9): "invalid_label",
        (None, 0.9): "invalid_label", ("factual", None): "invalid_label",
        ("factual", 1.5): "invalid_label", ("nav", 0.1): "invalid_label,low_confidence",
    }
    df = rows([("q", 0, *c) for c in cases], VOTES)
    got = {(r.ai_label, r.ai_confidence): r for r in validate_flags(df).collect()}
    assert {k: r.flags for k, r in got.items()} == cases
    assert all(r.needs_retry == bool(r.flags) for r in got.values())
    last = validate_flags(df.withColumn("attempt", F.lit(1))).where("needs_retry")
    assert last.isEmpty()


def test_retry_fold(rows):
    df = rows(
        [("good", 0, "factual", 0.9), ("good", 1, "navigational", 0.9),
         ("mended", 0, "factual", 0.1), ("mended", 1, "navigational", 0.9),
         ("weak", 0, "factual", 0.1), ("weak", 1, "abstain", 0.2),
         ("waiting", 0, "abstain", 0.9), ("late", 2, "abstain", 0.9)],
        VOTES,
    )
    got = {r.qid: tuple(r)[1:] for r in retry_fold(df).collect()}
    assert got == {
        "good": ("factual", 0.9, "", False, 0, "factual"),
        "mended": ("navigational", 0.9, "", False, 1, "navigational"),
        "weak": ("abstain", 0.2, "low_confidence,abstain", False, 1, "abstain"),
        "waiting": ("abstain", 0.9, "abstain", True, 0, "abstain"),
        "late": ("abstain", 0.9, "abstain", False, 2, "abstain"),
    }
    patient = retry_fold(df, ValidateOptions(max_retries=3)).where("qid = 'weak'").first()
    assert patient.needs_retry and patient.retry_count == 1


def test_pending_and_merge(rows):
    state = rows(
        [("done", "x", "factual", 0.9, False, 0), ("weak", "y", "abstain", 0.2, True, 0),
         ("new", "z", None, None, None, None)],
        "qid string, query string, ai_label string, ai_confidence double, "
        "needs_retry boolean, retry_count int",
    )
    assert {tuple(r) for r in pending_requests(state).collect()} == {
        ("weak", 1, "y"), ("new", 0, "z")}
    labels = rows([("done", "abstain", 0.1), ("weak", "factual", 0.8), ("new", "factual", 0.7)],
                  "qid string, ai_label string, ai_confidence double")
    got = {r.qid: (r.ai_label, r.ai_confidence, r.needs_retry, r.retry_count)
           for r in merge_labels(state, labels).collect()}
    assert got == {"done": ("factual", 0.9, False, 0), "weak": ("factual", 0.8, False, 1),
                   "new": ("factual", 0.7, False, None)}
    first = merge_labels(state.select("qid", "query"), labels.where("qid <> 'new'"))
    assert first.where(needs_annotation(first)).select("qid").collect()[0].qid == "new"


def test_constraint_errors(rows):
    df = rows([(1, "a", 0.5, "ok"), (2, None, 1.5, "ok"), (3, "z", None, " ")],
              "id int, label string, confidence double, query string")
    rules = [required("label"), one_of("label", ("a", "b")), within("confidence", 0.0, 1.0),
             matches("query", r"\S")]
    got = {tuple(r)[:2] for r in constraint_errors(df, rules, "id").collect()}
    assert got == {(2, "label"), (2, "confidence"), (3, "label"), (3, "query")}
    first = constraint_errors(df, rules, "id", fail_fast=True).collect()
    assert {tuple(r)[:2] for r in first} == {(2, "label"), (2, "confidence")}
    assert constraint_errors(df.where("id = 1"), rules, "id", fail_fast=True).isEmpty()
