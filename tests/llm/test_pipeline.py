"""The pipeline's stages against plain versions, and the shapes of plans."""

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from intentmill.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("score", F.lit("own")), []
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, FOLDER).cache()
        out.append((name, docs, found))
        docs = found
    return {name: (given, found) for name, given, found in out}


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_and_rows_stay(steps):
    for name, (given, found) in steps.items():
        if name != "packing":
            assert found.columns == given.columns and found.count() > 0
            assert {r[0] for r in found.select("score").distinct().collect()} == {"own"}


def test_rejected_documents_go(spark, steps):
    given, found = steps["quality"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = set(texts(found))
    wrong = sum((i in kept) != bool(labels[i]) for i in texts(given) if i in labels)
    assert wrong <= 3


def test_one_of_each_group_stays(steps):
    given, found = steps["near_duplicates"]
    assert set(texts(found)) == groups(texts(given), 5, 80)


def groups(docs, n, per_cent):
    """The smallest id of each group linked by n-word shingles, by comparing all pairs."""
    cut = {d: brute.VISIBLE.findall((t or "").translate(brute.LOW)) for d, t in docs.items()}
    sets = {d: {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set() for d, w in cut.items()}
    parent = {d: d for d in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in docs:
        for b in docs:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= per_cent * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {root(d) for d in docs}


def test_near_copies_of_five_words_go(docs, prose):
    given = dict(prose)
    for i in range(0, 60, 3):  # scattered edits: about 0.80 to 0.84 on five words, under 0.9 on three
        w = (prose[i] or "").split(" ")
        for k in range(20, len(w), 50):
            w[k] = "edited"
        given[1000 + i] = " ".join(w)
    expected = groups(given, 5, 80)
    assert expected < groups(given, 3, 90)
    assert set(texts(corpus_pipeline.near_duplicates(None, docs(given), ""))) == expected


def test_contaminated_documents_go(spark, steps):
    given, found = steps["decontamination"]
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    expected = brute.contamination(texts(given), items)
    assert set(texts(found)) == {i for i, x in expected.items() if not x[4]}


def test_secrets_go_and_clean_texts_stay(steps):
    given, found = steps["secrets"]
    before, after = texts(given), texts(found)
    assert set(before) == set(after)
    for i, text in before.items():
        assert after[i] == text if not brute.secrets(text) else not brute.secrets(after[i])


def test_all_that_is_left_is_packed(spark, steps):
    given, found = steps["packing"]
    packed = found.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("of")).collect()
    assert {r["doc_id"] for r in packed} == set(texts(given)) and all(r["n"] == r["of"] for r in packed)


def test_whole_run(spark):
    assert QUERIES["pipeline"](spark, FOLDER).count() > 0


@pytest.mark.parametrize("query", ["op2_closed_syncmers", "op5_winnowing"])
def test_native_plans_hold_no_python(spark, query):
    plan = QUERIES[query](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
