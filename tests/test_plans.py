"""Plans that must keep their shape as the data grows."""

import re

import pytest

from intentmill.operators import annotate, metrics, sampling
from intentmill.operators.votes import vote
from intentmill.plans import inputs
from intentmill.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "model_replies"])
def test_no_python_and_no_pair_joins(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", text)


def test_metrics_read_only_label_columns(spark):
    spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr(
        "cast(doc_id as string) qid", "text query", "lang ai_label", "lang human_label_gold"
    ).createOrReplaceTempView("labelled")
    text = plan(metrics.measures(metrics.label_tally(spark.table("labelled"))))
    assert re.findall(r"ReadSchema: (\S+)", text) == ["struct<lang:string>"]


def test_random_sample_is_one_filter(spark):
    log = inputs.document_log(spark, FOLDER)
    text = plan(sampling.random_sample(log, 50))
    assert "Exchange" not in text and "Sort" not in text and text.count("FileScan") == 1


def test_topped_up_sample_is_one_scan(spark):
    log = inputs.document_log(spark, FOLDER)
    text = plan(sampling.balanced_sample(log.withColumn("label", log.url), 190))
    assert text.count("documents.parquet") == 1 and "BroadcastHashJoin" in text and "Sort" not in text


def test_vote_is_one_shuffle_with_map_side_reduction(spark):
    replies = inputs.event_log(spark, FOLDER).selectExpr(
        "qid", "0 attempt", "bigint(qid) vote", "'factual' ai_label", "0.5D ai_confidence")
    text = plan(vote(replies))
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2
    assert "SortAggregate" not in text


def test_retries_are_folded_by_hash(spark):
    text = plan(QUERIES["retry_fold"](spark, FOLDER))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_split_filter_reaches_the_scan(spark):
    text = plan(QUERIES["split_filter"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(lang)]" in text and "text" not in text


def test_hot_replies_are_split_in_the_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        queries = spark.range(4000).selectExpr("cast(id as string) qid", "uuid() query")
        # a third of the replies belong to one query
        replies = spark.range(60_000, numPartitions=8).selectExpr(
            "cast(if(id % 3 = 0, 7, id % 4000) as string) qid", "id vote", "uuid() raw")
        joined = annotate.replay_join(queries, replies)
        assert len(joined.collect()) == 60_000
        assert "skew=true" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
