import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from intentmill.operators import sampling
from intentmill.operators.sampling import balanced_sample, random_sample, sample_queries


def digest(seed, qid):
    return hashlib.md5(f"{seed}:{qid}".encode()).hexdigest()


def smallest(qids, k, seed=42):
    return sorted(qids, key=lambda q: digest(seed, q))[:k]


def brute_force(pairs, k, seed=42):
    """The balanced sample of (qid, label) pairs with unique ids."""
    named = [(q, l.strip().lower()) for q, l in pairs if l is not None]
    names = sorted({l for _, l in named})
    base, extra = divmod(k, len(names))
    taken = set()
    for i, name in enumerate(names):
        taken |= set(smallest([q for q, l in named if l == name], base + (i < extra), seed))
    others = [q for q, _ in pairs if q not in taken]
    return taken | set(smallest(others, k - len(taken), f"{seed}:topup"))


@pytest.fixture(scope="module")
def log(spark):
    label = ("case when id % 100 < 70 then ' A ' when id % 100 < 90 then 'b' "
             "when id % 1000 = 99 then 'C' end label")
    return spark.range(6000).selectExpr("cast(id as string) qid", label)


@pytest.fixture(scope="module")
def pairs(log):
    return [tuple(r) for r in log.collect()]


def ids(df):
    return sorted(r.qid for r in df.collect())


@pytest.mark.parametrize("k", [0, 1, 40, 3000, 5999, 6000, 9000])
def test_random_sample(log, pairs, k):
    assert ids(random_sample(log, k)) == sorted(smallest([q for q, _ in pairs], k))


@pytest.mark.parametrize("k", [1, 2, 19, 100, 5900, 6000])
def test_balanced_sample(log, pairs, k):
    got = ids(balanced_sample(log, k))
    assert len(got) == len(set(got)) == k
    assert k == 6000 or set(got) == brute_force(pairs, k)


def test_quotas(rows):
    df = rows([(f"{c}{i}", c) for c in "abc" for i in range(50)], "qid string, label string")
    taken = Counter(r.label for r in balanced_sample(df, 32).collect())
    assert taken == {"a": 11, "b": 11, "c": 10}


def test_same_rows_on_any_partitioning(log):
    once = ids(balanced_sample(log.coalesce(1), 500))
    assert ids(balanced_sample(log.repartition(8), 500)) == once
    assert ids(balanced_sample(log, 500, seed=7)) != once


def test_switch(log):
    assert sample_queries(log, None) is log and sample_queries(log, 0) is log
    assert ids(sample_queries(log.drop("label"), 9)) == ids(random_sample(log, 9))
    assert ids(sample_queries(log, 9)) == ids(balanced_sample(log, 9))
    unlabelled = log.withColumn("label", F.lit(None).cast("string"))
    assert ids(sample_queries(unlabelled, 9)) == ids(random_sample(log, 9))


@pytest.fixture(scope="module")
def hot(spark, log):
    """A third of the rows are identical, and another part shares their id."""
    plain = log.select("qid", F.lit("x").alias("label"), F.lit(None).cast("string").alias("query"))
    copies = spark.range(4000).selectExpr("'7' qid", "'x' label", "'same' query")
    shared = spark.range(1000).selectExpr("'7' qid", "'x' label", "concat('q', id) query")
    return plain.unionByName(copies).unionByName(shared)


@pytest.mark.parametrize("over", [0, 1, 2, 700, 4800, 5001, 5002])
def test_hot_id_and_copies(hot, pairs, over):
    before = sorted((q for q, _ in pairs), key=lambda q: digest(42, q)).index("7")
    for sample in (random_sample(hot, before + over), balanced_sample(hot, before + over)):
        got = Counter(r.qid for r in sample.collect())
        assert sum(got.values()) == before + over
        assert got["7"] == min(over, 5001)


def test_hot_copies_of_a_class_are_topped_up_whole(hot):
    split = hot.withColumn("label", F.when(F.col("query") == "same", "y").otherwise("x"))
    for k in (900, 9000, 10_500):
        got = Counter(r.label for r in balanced_sample(split, k).collect())
        assert sum(got.values()) == k and got["y"] == min(k // 2, 4000)


def test_buckets_too_full_for_one_round(log, pairs, monkeypatch):
    monkeypatch.setattr(sampling, "_FINER", 1)
    assert set(ids(random_sample(log, 3000))) == set(smallest([q for q, _ in pairs], 3000))
    assert set(ids(balanced_sample(log, 1000))) == brute_force(pairs, 1000)


def jobs(spark, action):
    spark.sparkContext.setJobGroup("counted", "")
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    out = action()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before)


def test_a_plain_sample_is_planned_in_four_jobs(spark, log):
    sample, n = jobs(spark, lambda: random_sample(log, 700))
    assert n <= 4
    assert sample.count() == 700


def test_sketched_again_while_much_is_left(spark, monkeypatch):
    """Small sketches and a low limit, so that bounds are wide, sketched again, and sometimes missed."""
    monkeypatch.setattr(sampling, "_DETAIL", 16)
    monkeypatch.setattr(sampling, "_EXACT", 50)
    wide = spark.range(60_000).selectExpr("cast(id as string) qid")
    order = smallest([str(i) for i in range(60_000)], 60_000)
    for k in (1, 333, 30_000, 59_999):
        assert set(ids(random_sample(wide, k))) == set(order[:k])


@pytest.mark.parametrize("over", [1, 2500, 5001])
def test_hot_id_under_small_sketches(hot, pairs, over, monkeypatch):
    monkeypatch.setattr(sampling, "_DETAIL", 16)
    monkeypatch.setattr(sampling, "_EXACT", 50)
    before = sorted((q for q, _ in pairs), key=lambda q: digest(42, q)).index("7")
    got = Counter(r.qid for r in random_sample(hot, before + over).collect())
    assert sum(got.values()) == before + over and got["7"] == min(over, 5001)


def test_many_classes(spark, hot):
    split = hot.withColumn("label", F.when(F.col("query") == "same", "y").otherwise("x"))
    got = Counter(r.label for r in balanced_sample(split, 900).collect())
    assert got == {"x": 450, "y": 450}
    own = spark.range(300).selectExpr("cast(id as string) qid", "cast(id as string) label")
    assert ids(balanced_sample(own, 7)) == sorted(sorted(str(i) for i in range(300))[:7])
    # 900 classes of 20 rows, and one of nine tenths of all rows
    wide = spark.range(180_000).selectExpr("cast(id as string) qid", "if(id % 10 = 0, concat('c', id % 9000), 'hot') label")
    taken = Counter(r.label for r in balanced_sample(wide, 9010).collect())
    assert len(taken) == 901 and set(taken.values()) == {10}


def test_empty_population(log):
    assert balanced_sample(log.limit(0), 5).count() == 0 and random_sample(log.limit(0), 5).count() == 0
