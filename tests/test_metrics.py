"""Metrics against a plain Python computation, and the stored 20-row runs."""

import itertools
from dataclasses import replace
from random import Random

import pytest

from intentmill.operators.metrics import (
    by_class, confusion, drop_missing_gold, judge_tally, label_tally, measures, metrics_table,
    pick_ai_column, summary,
)
from intentmill.options import CLASSES, EvalOptions

SCHEMA = "qid string, human_label_gold string, ai_label string"
EXACT = pytest.approx


def measured(df, options=EvalOptions(), judged=None):
    m = measures(label_tally(df, options), judged, options)
    table = {r["class"]: r for r in metrics_table(m).collect()}
    return table, summary(m).first()


def kappa(table):
    n = sum(table.values())
    if not n:
        return 0.0
    names = {a for pair in table for a in pair}
    agree = sum(table.get((a, a), 0) for a in names) / n
    chance = sum(
        sum(v for (y, _), v in table.items() if y == a) * sum(v for (_, p), v in table.items() if p == a)
        for a in names
    ) / (n * n)
    return (agree - chance) / (1 - chance) if 1 - chance else 0.0


def tabulate(pairs):
    table = {}
    for pair in pairs:
        table[pair] = table.get(pair, 0) + 1
    return table


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_python(rows, seed):
    random = Random(seed)
    human = [c.capitalize() for c in CLASSES] + [" FACTUAL\t", "other", None]
    ai = [*CLASSES, "Factual ", "other", "else", None]
    data = [(str(i), random.choice(human), random.choice(ai)) for i in range(400)]
    table, total = measured(rows(data, SCHEMA))
    canon = [(y.strip().lower(), p and p.strip().lower()) for _, y, p in data if y is not None]
    inside = [(y, p) for y, p in canon if y in CLASSES and p in CLASSES]
    for c in CLASSES:
        hit = sum(y == p == c for y, p in inside)
        said, true = sum(p == c for _, p in inside), sum(y == c for y, _ in inside)
        precision, recall = hit / said, hit / true
        assert table[c].precision == EXACT(precision, abs=1e-12)
        assert table[c].recall == EXACT(recall, abs=1e-12)
        assert table[c].f1 == EXACT(2 * precision * recall / (precision + recall), abs=1e-12)
        assert table[c].support == true
        assert table[c].cohen_kappa == EXACT(
            kappa(tabulate((y == c, p == c) for y, p in canon)), abs=1e-12)
        assert table[c].judge_score is None
    assert table["ALL"].support == len(canon)
    assert total.cohen_kappa == table["ALL"].cohen_kappa == EXACT(kappa(tabulate(inside)), abs=1e-12)
    assert total.accuracy == EXACT(sum(y == p for y, p in canon) / len(canon))
    for name in ("precision", "recall", "f1"):
        mean = sum(table[c][name] for c in CLASSES) / 5
        assert table["ALL"][name] == total[f"macro_{name}"] == EXACT(mean, abs=1e-12)
    cells = {(r.y, r.p): r.n for r in confusion(label_tally(rows(data, SCHEMA))).collect()}
    assert cells == {k: tabulate(inside).get(k, 0) for k in itertools.product(CLASSES, CLASSES)}


def test_no_human_labels(rows):
    data = [("1", None, "factual"), ("2", None, "Factual"), ("3", None, "odd")]
    for df in (rows(data, SCHEMA), rows(data, SCHEMA).drop("human_label_gold")):
        table, total = measured(df)
        assert table["factual"].support == 2 and table["abstain"].support == 0
        assert table["ALL"].support == 3 and not total.has_human_labels
        assert (total.accuracy, total.cohen_kappa, table["factual"].precision) == (None, None, None)
        assert df.count() == drop_missing_gold(df).count() == 3


def test_keeping_rows_without_gold(rows):
    df = rows([("1", "Factual", "factual"), ("2", None, "factual"), ("3", None, None)], SCHEMA)
    assert drop_missing_gold(df).count() == 1
    table, total = measured(df, EvalOptions(drop_missing_gold=False))
    assert table["ALL"].support == 3 and table["factual"].support == 1
    # a missing label on both sides counts as agreement, as equal texts do
    assert total.accuracy == EXACT(2 / 3)


def test_one_class_only_and_equal_labels(rows):
    same = rows([(str(i), "factual", "factual") for i in range(3)], SCHEMA)
    assert measured(same)[1].cohen_kappa == 0.0
    two = rows([("1", "factual", "factual"), ("2", "abstain", "abstain")], SCHEMA)
    assert measured(two)[1].cohen_kappa == 1.0


def test_empty_table(rows):
    table, total = measured(rows([], SCHEMA))
    assert table["ALL"].support == 0 and total.accuracy is None and len(table) == 6


def test_switches(rows):
    df = rows([("1", "factual", "factual"), ("2", "abstain", "factual")], SCHEMA)
    table, total = measured(df, EvalOptions(use_prf=False))
    assert table["factual"].precision is None and table["factual"].support is None
    assert total.accuracy is None and total.cohen_kappa is not None
    table, total = measured(df, EvalOptions(use_kappa=False))
    assert table["factual"].cohen_kappa is None and total.cohen_kappa is None


def test_kappa_of_counts_beyond_64_bit_squares(spark):
    n = 10**11
    tally = spark.createDataFrame(
        [(True, "factual", "factual", True, n), (True, "abstain", "abstain", True, n),
         (True, "factual", "abstain", False, n)],
        "has_gold boolean, y string, p string, same boolean, n bigint")
    small = tally.withColumn("n", tally.n / n)
    for a, b in zip(*(by_class(measures(t), "cohen_kappa").collect()
                      for t in (tally, small.selectExpr("has_gold", "y", "p", "same", "bigint(n) n")))):
        assert a.cohen_kappa == EXACT(b.cohen_kappa, abs=1e-12)


def test_pick_ai_column(rows):
    df = rows([], SCHEMA)
    assert pick_ai_column(df, ("final_type", "ai_label")) == "ai_label"
    with pytest.raises(ValueError):
        pick_ai_column(df, ("final_type",))


# Two stored 20-row runs. qid, gold, then label and verdict of each run.
RUNS = """
4533021 Abstain factual incorrect factual incorrect
2723526 Transactional transactional correct transactional correct
12574555 Navigational factual incorrect factual correct
5084090 Abstain abstain correct navigational incorrect
7435435 Instrumental abstain incorrect abstain incorrect
4781397 Factual factual correct factual correct
9155903 Instrumental instrumental correct instrumental correct
2230093 Abstain factual incorrect factual incorrect
4444111 Transactional navigational incorrect navigational incorrect
4975497 Transactional transactional correct transactional correct
7374364 Navigational navigational correct navigational correct
8490676 Abstain factual incorrect factual incorrect
7830987 Instrumental factual incorrect factual incorrect
12383687 Transactional transactional correct transactional correct
4081222 Factual factual correct navigational incorrect
12057483 Navigational navigational correct navigational correct
6662399 Factual factual correct factual correct
11751170 Instrumental instrumental correct instrumental correct
10963690 Navigational navigational correct navigational correct
8319821 Factual factual correct factual correct
"""
# Precision, recall, f1, support, judge score, kappa of each run
EXPECTED = {
    0: {
        "navigational": (0.75, 0.75, 0.75, 4, 0.75, 0.6874999999999999),
        "factual": (0.4444444444444444, 1.0, 0.6153846153846153, 4, 0.4444444444444444, 0.4680851063829787),
        "transactional": (1.0, 0.75, 0.8571428571428571, 4, 1.0, 0.8275862068965515),
        "instrumental": (1.0, 0.5, 0.6666666666666666, 4, 1.0, 0.6153846153846153),
        "abstain": (0.5, 0.25, 0.3333333333333333, 4, 0.5, 0.23076923076923064),
        "ALL": (0.7388888888888889, 0.65, 0.6445054945054945, 20, 0.65, 0.5625),
    },
    1: {
        "navigational": (0.5, 0.75, 0.6, 4, 0.5, 0.47368421052631604),
        "factual": (0.375, 0.75, 0.5, 4, 0.5, 0.318181818181818),
        "transactional": (1.0, 0.75, 0.8571428571428571, 4, 1.0, 0.8275862068965515),
        "instrumental": (1.0, 0.5, 0.6666666666666666, 4, 1.0, 0.6153846153846153),
        "abstain": (0.0, 0.0, 0.0, 4, 0.0, -0.08695652173913052),
        "ALL": (0.575, 0.55, 0.5247619047619048, 20, 0.6, 0.4375),
    },
}
ACCURACY = {0: 0.65, 1: 0.55}


@pytest.mark.parametrize("run", [0, 1])
def test_stored_runs(rows, run):
    lines = [line.split() for line in RUNS.strip().splitlines()]
    df = rows([(w[0], w[1], w[2 + 2 * run], w[3 + 2 * run]) for w in lines],
              SCHEMA + ", judge_decision string")
    options = replace(EvalOptions(), use_judge=True)
    table, total = measured(df, options, judge_tally(df))
    for name, values in EXPECTED[run].items():
        assert tuple(table[name])[1:] == EXACT(values, abs=1e-12)
    assert total.accuracy == ACCURACY[run] and total.judge_mode == "compare_to_human"
