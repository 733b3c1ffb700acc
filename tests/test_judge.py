from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from intentmill.functions.replies import UNREADABLE
from intentmill.operators.judge import both_tallies, judge_rows, judge_sample, judge_score
from intentmill.operators.metrics import judge_tally, label_tally, measures
from intentmill.options import CLASSES, EvalOptions
from intentmill.operators.prompts import judge_prompts
from intentmill.plans.queries import QUERIES
from intentmill.plans.run import evaluate

SCHEMA = "qid string, query string, human_label_gold string, ai_label string"
ROWS = [("1", "a", " Factual", "factual"), ("2", "b", "Abstain", "Factual"),
        ("3", None, "Abstain", "odd"), ("4", "d", None, "abstain")]
REPLIES = [
    ("1", '{"decision": "correct", "confidence": 0.9, "judge_label": "factual"}'),
    ("2", '{"decision": "incorrect", "confidence": 0.8, "judge_label": "abstain"}'),
    ("4", '{"decision": "correct", "judge_label": "abstain"}'),
    ("9", '{"decision": "correct"}'),
]
ON = EvalOptions(use_judge=True)
AUDIT = replace(ON, judge_mode="audit")


@pytest.fixture
def labelled(rows):
    return rows(ROWS, SCHEMA)


@pytest.fixture
def replies(rows):
    return rows(REPLIES, "qid string, raw string")


def test_compare_rows(labelled, replies):
    judged = judge_rows(labelled, replies, ON)
    assert judged.columns == ["qid", "query", "human_label_gold", "ai_label", "judge_decision",
                              "judge_confidence", "judge_rationale"]
    got = {r.qid: tuple(r)[1:] for r in judged.collect()}
    assert got == {
        "1": ("a", "factual", "factual", "correct", 0.9, ""),
        "2": ("b", "abstain", "factual", "incorrect", 0.8, ""),
        "3": ("", "abstain", "odd", "incorrect", 0.0, UNREADABLE),
    }


def test_audit_rows_need_no_human_label(labelled, replies):
    judged = judge_rows(labelled.drop("human_label_gold"), replies, AUDIT)
    assert "human_label_gold" not in judged.columns
    assert {r.qid: r.judge_label for r in judged.collect()} == {
        "1": "factual", "2": "abstain", "3": "abstain", "4": "abstain"}


def test_comparing_without_human_labels_judges_nothing(labelled, replies):
    none = labelled.withColumn("human_label_gold", F.lit(None).cast("string"))
    for df in (labelled.drop("human_label_gold"), none):
        for options in (ON, replace(ON, drop_missing_gold=False)):
            assert judge_rows(df, replies, options).isEmpty()
        measured, _ = evaluate(df, replies, ON)
        total = measured.where("class = 'ALL'").first()
        assert total.judge_score is None and total.judge_mode == "compare_to_human"


def test_scores(labelled, replies):
    judged = judge_rows(labelled, replies, ON)
    got = {r["class"]: (r.judged, r.approved, r.judge_score)
           for r in judge_score(judge_tally(judged)).collect()}
    unjudged = {c: (0, 0, None) for c in CLASSES if c != "factual"}
    assert got == {"factual": (2, 1, 0.5), "ALL": (2, 1, 0.5)} | unjudged


def test_audit_kappa_stands_in_for_the_human_one(labelled, replies):
    measured, judged = evaluate(labelled.drop("human_label_gold"), replies, AUDIT)
    total = measured.where("class = 'ALL'").first()
    # in the list on both sides: (factual, factual), (abstain, factual), (abstain, abstain)
    assert total.ai_judge_kappa == pytest.approx(0.4)
    assert total.cohen_kappa is None and total.judge_score == pytest.approx(2 / 3)
    from intentmill.operators.metrics import metrics_table
    table = {r["class"]: r for r in metrics_table(measured).collect()}
    assert table["ALL"].cohen_kappa == total.ai_judge_kappa


def test_gate(labelled, replies):
    assert evaluate(labelled, None, EvalOptions())[1] is None
    assert EvalOptions(judge_enabled=True).judge_on
    assert not EvalOptions(judge_enabled=True, use_judge=False).judge_on
    with pytest.raises(ValueError):
        evaluate(labelled, None, ON)


def test_sample_size(spark):
    df = spark.range(900).selectExpr("cast(id as string) qid", "'x' human_label_gold")
    assert judge_sample(df).count() == 500
    assert judge_sample(df, replace(ON, judge_sample_size=None)).count() == 900


def test_prompts_show_canonical_labels(rows):
    row = judge_prompts(rows([("1", "a", " Trans ", "FACTUAL ")], SCHEMA)).first()
    assert "Human label: trans\n" in row.prompt and "Model label: factual\n" in row.prompt


@pytest.mark.parametrize("mode", ["compare_to_human", "audit"])
@pytest.mark.parametrize("drop", [True, False])
@pytest.mark.parametrize("gold", ["some", "none", "absent"])
def test_one_read_gives_both_tallies(spark, mode, drop, gold):
    labels = "array('navigational', 'FACTUAL', 'odd', null, 'abstain')"
    rows = spark.range(400).selectExpr(
        "cast(id as string) qid", f"get({labels}, cast(id * 7 % 5 as int)) ai_label",
        f"get({labels}, cast(id % 5 as int)) human_label_gold")
    if gold == "none":
        rows = rows.withColumn("human_label_gold", F.lit(None).cast("string"))
    if gold == "absent":
        rows = rows.drop("human_label_gold")
    replies = spark.range(0, 400, 3).selectExpr(
        "cast(id as string) qid",
        """concat('{"decision": "', if(id % 2 = 0, 'correct', 'incorrect'),
        '", "judge_label": "', if(id % 4 = 0, 'factual', 'odd'), '", "confidence": 0.5}') raw""")
    options = EvalOptions(use_judge=True, judge_mode=mode, drop_missing_gold=drop, judge_sample_size=None)
    marks = judge_tally(judge_rows(rows, replies, options), options.allowed)
    apart = measures(label_tally(rows, options), marks, options)
    once = measures(both_tallies(rows, replies, options), None, options)
    assert sorted(map(str, once.collect())) == sorted(map(str, apart.collect()))


def test_each_table_is_read_once(spark):
    folder = "/root/testdata/sf0.001"
    for name in ("metrics_table", "audit_kappa"):
        text = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert text.count("FileScan parquet") == 2  # the labelled rows and the replies
