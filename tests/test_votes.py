from collections import defaultdict
from random import Random

import pytest

from intentmill.operators.votes import vote
from intentmill.options import CLASSES

SCHEMA = "qid string, attempt int, vote bigint, ai_label string, ai_confidence double"


def brute_force(votes):
    """Count, then mean, then highest confidence, then first seen."""
    by_label = defaultdict(list)
    for label, confidence in votes:
        by_label[label].append(confidence)
    mean = {l: round(sum(c) / len(c), 12) for l, c in by_label.items()}
    best = max(by_label, key=lambda l: (len(by_label[l]), mean[l], max(by_label[l])))
    return best, mean[best]


def test_against_brute_force(rows):
    random = Random(3)
    groups = {
        (f"q{i}", i % 2): [
            (random.choice(CLASSES), random.choice([0.0, 0.25, 0.5, 0.9, 1 / 3, 1.0]))
            for _ in range(random.randint(1, 9))
        ]
        for i in range(300)
    }
    data = [(*k, i, *v) for k, votes in groups.items() for i, v in enumerate(votes)]
    random.shuffle(data)
    for r in vote(rows(data, SCHEMA)).collect():
        label, confidence = brute_force(groups[r.qid, r.attempt])
        assert r.ai_label == label
        assert r.ai_confidence == pytest.approx(confidence, abs=1e-12)


def test_full_tie_goes_to_the_first_vote(rows):
    data = [("q", 0, 5, "factual", 0.5), ("q", 0, 4, "abstain", 0.5), ("q", 0, 9, "abstain", 0.1),
            ("q", 0, 8, "factual", 0.1)]
    (r,) = vote(rows(data, SCHEMA)).collect()
    assert (r.ai_label, r.ai_confidence, r.votes) == ("abstain", 0.3, 2)


def test_one_vote_stands(rows):
    (r,) = vote(rows([("q", 0, 0, "factual", 0.85)], SCHEMA)).collect()
    assert (r.ai_label, r.ai_confidence) == ("factual", 0.85)


def test_hot_query_sums_exactly(spark):
    df = spark.range(200_000).selectExpr(
        "'q' qid", "0 attempt", "id vote", "'factual' ai_label", "0.1D ai_confidence")
    assert vote(df).first().ai_confidence == 0.1


def test_a_single_vote_stands_as_it_is(rows):
    df = rows([("1", 0, 0, "factual", 0.5999999999999999), ("2", 0, 0, "factual", 0.123456789012345)],
              "qid string, attempt int, vote long, ai_label string, ai_confidence double")
    assert {r.qid: r.ai_confidence for r in vote(df).collect()} == {"1": 0.5999999999999999, "2": 0.123456789012345}


def test_any_label_list(rows):
    df = rows([("1", 0, 0, "it's", 0.5), ("1", 0, 1, "it's", 0.7)],
              "qid string, attempt int, vote long, ai_label string, ai_confidence double")
    for allowed in (("it's",), ("it's", 'a "b" \\')):
        assert tuple(vote(df, allowed).first()) == ("1", 0, "it's", 0.6, 2)
