import pytest

from intentmill.functions.replies import UNREADABLE, parse_judgements, parse_replies
from intentmill.options import CLASSES

# reply -> (label, confidence)
ANNOTATOR = {
    '{"type": "nav", "confidence": 0.25}': ("navigational", 0.25),
    'Sure:\n{"type": "FACTUAL",\n "confidence": "0.5"}\nbye': ("factual", 0.5),
    '{"type": "factual"} x {"a": 1}': ("abstain", 0.0),
    '{"type": "factual"}, {"type": "nav"}': ("abstain", 0.0),
    '[{"type": "factual"}] and [{"type": "nav"}]': ("abstain", 0.0),
    '{"type": "factual"}} {"x": 1}': ("abstain", 0.0),
    '[{"type": "factual", "confidence": 0.5}]': ("factual", 0.5),
    "{'type': 'factual'}": ("abstain", 0.0),
    '{"type": "factual", "confidence": 0.5,}': ("abstain", 0.0),
    '{"type": "factual", "type": "nav", "confidence": 1}': ("navigational", 1.0),
    '{"type": "factual", "confidence": NaN}': ("factual", 1.0),
    '{"type": "factual", "confidence": "nan"}': ("factual", 1.0),
    '{"type": "factual", "confidence": Infinity}': ("factual", 1.0),
    '{"type": "factual", "confidence": -Infinity}': ("factual", 0.0),
    '{"type": "factual", "confidence": "-inf"}': ("factual", 0.0),
    '{"type": "factual", "confidence": 1e400}': ("factual", 1.0),
    '{"type": "factual", "confidence": -3}': ("factual", 0.0),
    '{"type": "factual", "confidence": 7}': ("factual", 1.0),
    '{"type": "factual", "confidence": " 5e-1 "}': ("factual", 0.5),
    '{"type": "factual", "confidence": "0.5d"}': ("factual", 0.0),
    '{"type": "factual", "confidence": "high"}': ("factual", 0.0),
    '{"type": "factual", "confidence": null}': ("factual", 0.0),
    '{"type": "factual", "confidence": {"a": 1}}': ("factual", 0.0),
    '{"type": "factual", "extra": {"b": [1, {}]}}': ("factual", 0.0),
    '{"type": 5, "confidence": 0.5}': ("abstain", 0.5),
    '{"type": ["nav"], "confidence": 0.5}': ("abstain", 0.5),
    '{"type": null, "confidence": 0.5}': ("abstain", 0.5),
    "{}": ("abstain", 0.0),
    "no object": ("abstain", 0.0),
    "": ("abstain", 0.0),
    None: ("abstain", 0.0),
}

# reply -> (decision, confidence, rationale, judge label)
BAD = ("incorrect", 0.0, UNREADABLE, "abstain")
JUDGE = {
    '{"judge_label": " Factual", "decision": "Correct ", "confidence": 0.5, "rationale": "r"}':
        ("correct", 0.5, "r", "factual"),
    ' \n{"decision": "correct"}\t': ("correct", 0.0, "", "abstain"),
    '{"decision": "maybe", "confidence": 2}': ("incorrect", 1.0, "", "abstain"),
    '{"decision": "correct", "confidence": "0.7", "judge_label": "nav"}':
        ("correct", 0.7, "", "abstain"),
    '{"decision": "correct", "rationale": "' + "é" * 200 + '"}':
        ("correct", 0.0, "é" * 120, "abstain"),
    '{"decision": "correct", "confidence": "high"}': BAD,
    '{"decision": "correct", "confidence": null}': BAD,
    'Sure: {"decision": "correct"}': BAD,
    '{"decision": "correct"} ok': BAD,
    '{"decision": "correct"}]': BAD,
    '[{"decision": "correct"}]': BAD,
    '"correct"': BAD,
    "": BAD,
    None: BAD,
}


def test_annotator_replies(rows):
    df = parse_replies(rows([(i, r) for i, r in enumerate(ANNOTATOR)], "i int, raw string"), CLASSES)
    got = {r.i: (r.ai_label, r.ai_confidence) for r in df.collect()}
    assert [got[i] for i in range(len(ANNOTATOR))] == list(ANNOTATOR.values())


@pytest.mark.parametrize("audit", [False, True])
def test_judge_replies(rows, audit):
    frame = rows([(i, r) for i, r in enumerate(JUDGE)], "i int, raw string")
    got = {r.i: r for r in parse_judgements(frame, CLASSES, audit).collect()}
    for i, (decision, confidence, rationale, label) in enumerate(JUDGE.values()):
        r = got[i]
        assert (r.judge_decision, r.judge_confidence, r.judge_rationale) == (
            decision, confidence, rationale)
        assert not audit or r.judge_label == label
