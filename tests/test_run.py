import json

import pytest

from intentmill.operators.annotate import ask_in_commits
from intentmill.operators.checks import matches
from intentmill.options import AnnotateOptions, EvalOptions, LoadOptions
from intentmill.plans.run import abstain_unanswered, label_from_replies, run
from intentmill.sources.results import Steps, save_step, write_tsv


def test_whole_run(spark, tmp_path):
    words = {"navigational": "go", "factual": "ask", "transactional": "get", "instrumental": "do",
             "abstain": "hm"}
    data = [(f"{label}{i}", f"{word} {i}", label.upper(), "train")
            for label, word in words.items() for i in range(6)]
    write_tsv(spark.createDataFrame(data, "qid string, query string, label string, data_split string"),
              str(tmp_path / "log.tsv"))
    calls = str(tmp_path / "calls")

    def ask(system, prompt):
        query = prompt.split('Query: "')[1]
        with open(calls, "a") as f:
            f.write(query + "\n")
        again = open(calls).read().count(query + "\n") > 2
        label = next(l for l, w in words.items() if query.startswith(w))
        # "ask" queries are unsure until they are asked again
        sure = 0.3 if label == "factual" and not again else 0.9
        return json.dumps({"type": label, "confidence": sure})

    def judge(system, prompt):
        return '{"decision": "correct", "confidence": 1}'

    out = str(tmp_path / "out")
    result = run(
        spark, str(tmp_path / "log.tsv"), out, ask, judge,
        load=LoadOptions(split="train", sample_size=20),
        annotate=AnnotateOptions(votes=2),
        score=EvalOptions(use_judge=True, judge_sample_size=7),
        rules=[matches("query", "^[a-z]+ [0-4]$")],
    )
    assert result.n_records == 20
    labelled = spark.read.parquet(f"{out}/validated")
    assert labelled.count() == 20 and labelled.where("needs_retry").isEmpty()
    errors = spark.read.parquet(f"{out}/errors")
    assert errors.count() == labelled.where("query like '% 5'").count()
    retried = {r.qid for r in labelled.where("retry_count = 1").collect()}
    assert {q.rstrip("0123456789") for q in retried} == {"factual", "abstain"}
    assert labelled.where("ai_label <> human_label and flags <> 'abstain'").where(
        "lower(human_label) <> ai_label").isEmpty()
    assert spark.read.parquet(f"{out}/replies-0").count() == 40
    assert spark.read.parquet(f"{out}/replies-1").count() == 16
    total = result.summary.first()
    assert total.accuracy == 1.0 and total.judge_score == 1.0
    assert spark.read.csv(f"{out}/judge_sample.tsv", sep="\t", header=True).count() == 7
    metrics = spark.read.csv(f"{out}/metrics_by_class.tsv", sep="\t", header=True)
    assert {r["class"]: r.support for r in metrics.collect()} == {
        **{c: "4" for c in words}, "ALL": "20"}
    overall = json.loads(spark.read.text(f"{out}/summary.json").first()[0])["overall"]
    assert list(overall) == ["accuracy", "macro_precision", "macro_recall", "macro_f1",
                             "cohen_kappa", "judge_score", "ai_judge_kappa",
                             "has_human_labels", "judge_mode"]
    assert overall["ai_judge_kappa"] is None
    assert result.info["n_records"] == 20 and result.info["judged"] == 7
    assert result.info["split"] == "train" and result.info["annotate"]["votes"] == 2
    assert result.annotations.columns == ["qid", "query", "ai_label", "ai_confidence"]


def test_labels_from_stored_replies(rows):
    queries = rows([("1", "a"), ("2", "b"), ("3", "c")], "qid string, query string")
    weak, good = '{"type": "nav", "confidence": 0.2}', '{"type": "info", "confidence": 0.8}'
    replies = rows(
        [("1", 0, 0, weak), ("1", 0, 1, good), ("1", 0, 2, good), ("2", 0, 0, weak),
         ("9", 0, 0, good)],
        "qid string, attempt int, vote bigint, raw string")
    labelled = label_from_replies(queries, replies, AnnotateOptions(model_name="m"))
    got = {r.qid: r for r in labelled.collect()}
    assert set(got) == {"1", "2", "3"} and got["3"].ai_label is None
    assert (got["1"].ai_label, got["1"].ai_confidence, got["1"].needs_retry) == ("factual", 0.8, False)
    assert (got["2"].flags, got["2"].needs_retry, got["2"].model_name) == ("low_confidence", True, "m")
    closed = {r.qid: r for r in abstain_unanswered(labelled).collect()}
    assert closed["2"] == got["2"]
    assert tuple(closed["3"])[2:8] == ("abstain", 0.0, "low_confidence,abstain", False, 0, "abstain")


def _unlabelled(spark, tmp_path):
    write_tsv(spark.createDataFrame([(str(i), f"q {i}") for i in range(5)], "qid string, query string"),
              str(tmp_path / "log.tsv"))
    return str(tmp_path / "log.tsv"), str(tmp_path / "out"), str(tmp_path / "asked")


def test_the_judge_is_not_asked_without_human_labels(spark, tmp_path):
    log, out, asked = _unlabelled(spark, tmp_path)

    def judge(system, prompt):
        open(asked, "a").write("x")
        return "{}"

    result = run(spark, log, out, lambda s, p: '{"type": "nav", "confidence": 1}', judge,
                 load=LoadOptions(split="all"), score=EvalOptions(use_judge=True))
    assert not (tmp_path / "asked").exists() and result.info["judged"] == 0


def test_a_missing_judge_is_told_before_anything_runs(spark, tmp_path):
    log, out, _ = _unlabelled(spark, tmp_path)
    with pytest.raises(ValueError):
        run(spark, log, out, lambda s, p: "{}", score=EvalOptions(use_judge=True))
    assert not (tmp_path / "out").exists()


def _called(path):
    """Every call left a line."""
    return open(path).read().split() if path.exists() else []


def test_a_run_that_died_goes_on(spark, tmp_path, monkeypatch):
    import intentmill.plans.run as plan

    log, out, _ = _unlabelled(spark, tmp_path)
    calls = tmp_path / "calls"
    at = str(calls)

    def ask(system, prompt):
        with open(at, "a") as f:
            f.write(prompt.split('q ')[-1][0] + "\n")
        return '{"type": "nav", "confidence": 0.9}' if "q 3" not in prompt else '{"type": "nav", "confidence": 0.1}'

    voting = plan.vote
    monkeypatch.setattr(plan, "vote", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(spark, log, out, ask, load=LoadOptions(split="all"))
    assert sorted(_called(calls)) == list("01234")
    monkeypatch.setattr(plan, "vote", voting)
    result = run(spark, log, out, ask, load=LoadOptions(split="all"))
    assert sorted(_called(calls)) == list("012334")       # only the weak one again, as a retry
    again = run(spark, log, out, ask, load=LoadOptions(split="all"))
    assert sorted(_called(calls)) == list("012334")
    assert sorted(again.annotations.collect()) == sorted(result.annotations.collect())
    assert again.info == result.info
    run(spark, log, out, ask, load=LoadOptions(split="all"), annotate=AnnotateOptions(model_name="other"))
    assert len(_called(calls)) == 12


def test_replies_are_committed_in_parts(spark, tmp_path):
    """A worker that dies costs the calls of its own part."""
    asked = spark.range(40).selectExpr("cast(id as string) qid", "0L vote", "'s' system_prompt", "cast(id as string) prompt")
    asked = save_step(asked)
    calls, dead = str(tmp_path / "calls"), str(tmp_path / "dead")
    options = AnnotateOptions(slice_rows=3, commit_rows=10, parallel=1)

    def ask(system, prompt):
        import os
        with open(calls, "a") as f:
            f.write(prompt + "\n")
        if prompt == "17" and not os.path.exists(dead):
            open(dead, "w").close()
            os._exit(1)
        return "to " + prompt

    def replies():
        steps = Steps(spark, str(tmp_path / "out"))
        return ask_in_commits(steps, "replies", asked, 40, ask, options=options), steps

    with pytest.raises(Exception):
        replies()
    before = len(_called(tmp_path / "calls"))
    found, steps = replies()
    assert {r.qid: r.raw for r in found.collect()} == {str(i): f"to {i}" for i in range(40)}
    assert found.count() == 40 and len(steps.counts) == 4
    assert before < 40
    part = asked.selectExpr("pmod(xxhash64(qid, vote), 4) part").groupBy("part").count().collect()
    assert len(_called(tmp_path / "calls")) - 40 <= max(r["count"] for r in part)


def test_counters_are_those_of_the_tables(spark, tmp_path):
    log, out, _ = _unlabelled(spark, tmp_path)

    def ask(system, prompt):
        if "q 1" in prompt:
            raise ValueError
        return '{"type": "nav", "confidence": 0.9}'

    info = run(spark, log, out, ask, load=LoadOptions(split="all")).info
    table = spark.read.parquet(f"{out}/validated")
    assert info["labelled"] == table.where("ai_label is not null").count() == 5
    assert info["flagged"] == table.where("flags <> ''").count() == 1
    assert info["retried"] == table.where("retry_count > 0").count() == 1
    assert info["unanswered"] == 2 and info["judged"] == 0
