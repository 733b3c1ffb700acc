"""Operators that learn: held-out accuracy, gradients, automata."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from intentmill.llm import op3_quality, op8_toxicity
from intentmill.llm.common import held_out
from intentmill.llm.learning import labelled_sample
from intentmill.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


@pytest.mark.parametrize(
    "query, label, least", [("op3_attention_quality", "quality", 0.98), ("op8_levenshtein_toxicity", "toxic", 0.97)]
)
def test_held_out_accuracy(spark, query, label, least):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = QUERIES[query](spark, FOLDER).where("held_out").join(labels, "doc_id")
    right, rows = found.agg(F.avg((F.col("predicted") == F.col(label)).cast("double")), F.count("*")).first()
    assert rows > 500 and right >= least


def test_gradients_are_the_slopes():
    draw = np.random.default_rng(0)
    model = op3_quality.AttentionModel(width=5, depth=3)
    passages, starts, truth = draw.normal(size=(7, op3_quality.N_FEATURES)), np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = model.forward(passages, starts)["score"]
        return -np.mean(truth * np.log(p) + (1 - truth) * np.log(1 - p))

    slopes = model.gradients(model.forward(passages, starts), starts, truth)
    for name, weight in model.weights.items():
        at = tuple(0 for _ in weight.shape)
        weight[at] += 1e-6
        high = loss()
        weight[at] -= 2e-6
        low = loss()
        weight[at] += 1e-6
        assert slopes[name][at] == pytest.approx((high - low) / 2e-6, abs=1e-6)


def near(a, b):
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    return any(a[:i] + (a[i + 1 :] if len(a) == len(b) else a[i:]) == b[:i] + b[i + 1 :] for i in range(len(b)))


def test_automaton_and_trie_find_one_edit():
    terms = {"clown": 1.0, "clone": 2.0, "stupid": 3.0, "scums": 4.0}
    lexicon = op8_toxicity.Lexicon(terms, {})
    for word in ("clwn", "clowns", "clonn", "stupld", "xclown", "cloqwn", "cllown", "stoopid", "umsc", "scum", "down", "clow"):
        best = max([w for t, w in terms.items() if near(word, t)], default=0.0)
        hit = lexicon._look(word)
        assert (hit[0] if hit else 0.0) == best, word


def test_quoted_and_misspelled_hits():
    lexicon = op8_toxicity.Lexicon({"idiot": 2.0}, {"stup": 1.0})
    n, hits = lexicon.hits('He said "what an idiot you are" and left. IDIOTT! stupendous')
    assert n == 11
    assert [(w, wrong, quoted) for _, w, wrong, quoted in hits] == [(2.0, False, True), (2.0, True, False), (1.0, False, False)]


def test_odd_rows_get_scores(spark, docs):
    labels = spark.createDataFrame(
        [(i, i % 2, i % 2) for i in range(40)] + [(3, 0, 0), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int"
    )
    table = docs([(i, "bad!! words## here" if i % 2 else "some good words here") for i in range(40)] + [(50, None), (51, ""), (None, "x"), (1, "y"), (52, "long " * 50_000)])
    for op in (op3_quality, op8_toxicity):
        for given in (labels, labels.limit(0)):
            rows = op.classify(table, given).collect()
            assert len(rows) == 45 and all(0 <= r["score"] <= 1 for r in rows)
        assert op.classify(table.limit(0), labels).count() == 0


def test_rows_with_a_shared_beginning_are_learned_from(spark, docs):
    banner = "This text is shared under the same license as all others here. "
    texts = {i: f"{banner} page{i} " + ("you grobnik" if i % 2 else "you friend") for i in range(100)}
    labels = spark.createDataFrame([(i, 1, i % 2) for i in texts], "doc_id long, quality int, toxic int")
    lexicon, _ = op8_toxicity.train(docs(texts), labels)
    assert "grobnik" in lexicon.words
    rows = op8_toxicity.classify(docs(texts), labels).where("held_out").collect()
    assert rows and all(r["predicted"] == r["doc_id"] % 2 for r in rows)


def test_copies_count_once():
    copies = op8_toxicity.pd.DataFrame({"text": ["You grobnik", "you  GROBNIK"] * 9 + ["you grobnik two"], "label": [1] * 18 + [1]})
    assert len(op8_toxicity._distinct(copies)) == 2


def test_what_is_held_out(spark):
    rows = spark.range(100).select("id", held_out(F.col("id")).alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


@pytest.mark.parametrize("rows", [10, 4000])
def test_labels_of_other_documents_use_up_nothing(spark, docs, rows):
    table = docs([(500 * i, f"text {i}") for i in range(40)])
    labels = spark.range(20_000).selectExpr("id doc_id", "cast(id % 2 as int) quality")
    usable = [500 * i for i in range(40) if zlib.crc32(str(500 * i).encode()) % 5]
    found = {r["doc_id"] for r in labelled_sample(table, labels, "quality", rows).collect()}
    assert len(found) == min(rows, len(usable)) and found <= set(usable)
