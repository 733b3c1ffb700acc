from pyspark.sql import functions as F

from intentmill.functions.replies import parse_replies
from intentmill.operators.annotate import (
    FAILED_REPLY, ask_model, merge_labels, replay_join, rule_annotate,
)
from intentmill.operators.prompts import (
    annotation_prompts, example_block, judge_prompts, pick_examples,
)
from intentmill.options import CLASSES, AnnotateOptions
from intentmill.sources.tables import read_examples


def test_rules(rows):
    cases = {
        "Facebook LOGIN": ("navigational", 0.9), "www.example.com": ("navigational", 0.9),
        "buy shoes": ("transactional", 0.9), "How-to knit": ("instrumental", 0.9),
        "what is love": ("factual", 0.9), "how to buy": ("transactional", 0.7),
        "what when who": ("factual", 0.9), "buyer useful whatever": ("abstain", 0.4),
        "": ("abstain", 0.4), None: ("abstain", 0.4),
    }
    got = rule_annotate(rows([(q,) for q in cases], "query string")).collect()
    assert {r.query: (r.ai_label, r.ai_confidence) for r in got} == cases


def test_replay_join(rows):
    joined = replay_join(rows([("1", "a"), ("2", "b")], "qid string, query string"),
                         rows([("1", "x"), ("1", "y"), ("3", "z")], "qid string, raw string"))
    assert sorted((r.qid, r.query, r.raw) for r in joined.collect()) == [
        ("1", "a", "x"), ("1", "a", "y")]
    assert parse_replies(joined, CLASSES).columns == ["qid", "query", "ai_label", "ai_confidence"]


def test_model_is_tried_twice(rows, tmp_path):
    log = str(tmp_path / "calls")

    def ask(system, prompt):
        with open(log, "a") as calls:
            calls.write(prompt + "\n")
        if prompt == "never" or open(log).read().split().count(prompt) == 1 and prompt == "second":
            raise RuntimeError
        return None if prompt == "empty" else "answer to " + prompt

    asked = rows([(p, "s", p) for p in ("first", "second", "never", "empty")],
                 "qid string, system_prompt string, prompt string").coalesce(1)
    got = {r.qid: r.raw for r in ask_model(asked, ask).collect()}
    assert got == {"first": "answer to first", "second": "answer to second",
                   "never": FAILED_REPLY, "empty": ""}
    assert sorted(open(log).read().split()) == [
        "empty", "first", "never", "never", "second", "second"]


def test_examples_in_prompts(rows, spark):
    pool = rows([(f"q{i}", "factual") for i in range(20)] + [("q20", " ")],
                "query string, type string")
    shots = pick_examples(pool)
    assert shots.count() == 8
    assert shots.collect() == pick_examples(pool.repartition(5)).collect()
    queries = rows([("1", "hello"), ("2", None)], "qid string, query string")
    few = {r.qid: r.prompt for r in annotation_prompts(queries, "FewShot", pool).collect()}
    head, body = few["1"].split("\n\n")
    assert head == example_block(shots).first().block
    assert len(head.splitlines()) in (7, 8)
    assert body.endswith('Query: "hello"') and few["2"].endswith('Query: ""')
    zero = annotation_prompts(queries).first().prompt
    # few-shot without a usable example falls back
    for empty in (None, read_examples(spark, None)):
        assert annotation_prompts(queries, "fewshot", empty).first().prompt == zero


def test_blank_examples_are_dropped_after_the_pick(rows):
    pool = rows([("a", " "), ("b", "factual")], "query string, type string")
    assert example_block(pick_examples(pool)).first().block == '"b" -> factual'


def test_judge_prompts(rows):
    df = rows([("1", "hello", "Factual", None)],
              "qid string, query string, human_label_gold string, ai_label string")
    compare = judge_prompts(df).first().prompt
    audit = judge_prompts(df.drop("human_label_gold"), "audit").first().prompt
    assert "Human label: factual" in compare and "judge_label" not in compare
    assert "Human label" not in audit and "judge_label" in audit
    assert judge_prompts(df).where(F.col("prompt").isNull()).isEmpty()


def test_requests_are_dealt_to_many_tasks(spark):
    asked = spark.range(300).coalesce(1).selectExpr("cast(id as string) qid", "0L vote", "'s' system_prompt", "'p' prompt")
    replies = ask_model(asked, lambda system, prompt: "x", parallel=7)
    assert replies.rdd.getNumPartitions() == 7 and replies.count() == 300


def test_merged_rows_get_new_provenance(rows):
    old = rows([("1", "a", True, "m1"), ("2", "b", False, "m1")], "qid string, ai_label string, needs_retry boolean, model_name string")
    new = rows([("1", "c", 0.5), ("2", "c", 0.5)], "qid string, ai_label string, ai_confidence double")
    merged = merge_labels(old, new, AnnotateOptions(model_name="m2", provider="p2"))
    assert {r.qid: (r.ai_label, r.model_name, r.provider) for r in merged.collect()} == {
        "1": ("c", "m2", "p2"), "2": ("b", "m1", None)}


def test_calls_wait_side_by_side(rows, tmp_path):
    asked = rows([(str(i), "s", f"p{i}") for i in range(24)], "qid string, system_prompt string, prompt string")
    places = str(tmp_path / "calls")

    def ask(system, prompt):
        import os, time
        with open(f"{places}-{prompt}-{time.time_ns()}", "w"):
            time.sleep(0.2)
        if prompt == "p5":
            raise ValueError
        return prompt[::-1]

    import time
    ask_model(asked.limit(1), ask, parallel=1).collect()
    took = []
    for n in (1, 12):
        start = time.perf_counter()
        found = {r.qid: r.raw for r in ask_model(asked, ask, parallel=1, concurrency=n).collect()}
        took.append(time.perf_counter() - start)
        assert found == {str(i): FAILED_REPLY if i == 5 else f"p{i}"[::-1] for i in range(24)}
    assert took[1] < took[0] / 3
    assert sum("-p5-" in x.name for x in tmp_path.iterdir()) == 4
