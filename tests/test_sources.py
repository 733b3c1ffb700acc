import csv
import json
import random

import pytest

from intentmill.operators.prepare import keep_columns, load_queries
from intentmill.options import LoadOptions
from intentmill.sources.results import (
    counted, drop_steps, save_step, shared_folder, write_summary, write_tsv,
)
from intentmill.sources.records import lines_of, spans_lines
from intentmill.sources.tables import check_not_empty, read_examples, read_query_log

LOG = (
    "qid\tquery\tlabel\tlevel_1\tdata_split\textra\n"
    '1\t"He said ""hi"", ok"\tFactual\tInformational\tTRAIN\tx\n'
    "2\tNA\tAbstain\tInformational\ttrain\tx\n"
    "3\tnull\t\tInformational\ttest\tx\n"
    "4\t\tFactual\tInformational\ttrain\tx\n"
    "5\t!!!\tFactual\tInformational\ttrain\tx\n"
    "6\t42\tFactual\tInformational\t\tx\n"
)


@pytest.fixture
def log(tmp_path):
    path = tmp_path / "log.tsv"
    path.write_text(LOG, encoding="utf8")
    return str(path)


def test_read_tsv(spark, log):
    got = {r.qid: r.query for r in read_query_log(spark, log).collect()}
    assert got == {"1": 'He said "hi", ok', "2": "NA", "3": "null", "4": None, "5": "!!!", "6": "42"}


def test_load(spark, log):
    loaded = load_queries(read_query_log(spark, log), LoadOptions(split="Train"))
    assert loaded.columns == ["qid", "query", "human_label_gold", "human_label_coarse",
                              "data_split", "human_label"]
    got = {r.qid: (r.query, r.human_label) for r in loaded.collect()}
    assert got == {"1": ("he said hi ok", "Factual"), "2": ("na", "Abstain"), "5": ("", "Factual")}
    everything = load_queries(read_query_log(spark, log), LoadOptions(split="ALL", drop_missing=False))
    assert everything.count() == 6


def test_kept_columns_decide_filter_and_balance(spark, log):
    df = read_query_log(spark, log)
    assert keep_columns(df, ("query", "qid", "nope")).columns == ["query", "qid"]
    no_split = LoadOptions(split="train", keep_columns=("qid", "query"), sample_size=3)
    assert load_queries(df, no_split).count() == 3


def test_sample_sees_raw_rows_of_the_split(spark, log):
    loaded = load_queries(read_query_log(spark, log), LoadOptions(split="train", sample_size=2))
    assert {r.human_label for r in loaded.collect()} == {"Factual", "Abstain"}


def test_headerless(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text("11\tfirst, query\n12\tsecond\n", encoding="utf8")
    assert {tuple(r) for r in read_query_log(spark, str(path)).collect()} == {
        ("11", "first, query"), ("12", "second")}


def test_other_formats(spark, tmp_path):
    csv = tmp_path / "log.csv"
    csv.write_text('query,qid\n"a, b",1\n', encoding="utf8")
    assert read_query_log(spark, str(csv)).first().query == "a, b"
    spark.createDataFrame([("1", "q")], "qid string, query string").write.parquet(
        str(tmp_path / "log.parquet"))
    assert read_query_log(spark, str(tmp_path / "log.parquet")).count() == 1
    spark.range(1).write.parquet(str(tmp_path / "bad.parquet"))
    with pytest.raises(ValueError, match="qid"):
        read_query_log(spark, str(tmp_path / "bad.parquet"))
    with pytest.raises(ValueError, match="xlsx"):
        read_query_log(spark, "log.xlsx")


def test_empty_input(spark):
    with pytest.raises(ValueError):
        check_not_empty(spark.range(0))
    assert check_not_empty(spark.range(1)).count() == 1


def test_examples(spark, tmp_path):
    path = tmp_path / "shots.jsonl"
    path.write_text(
        '{"query": " buy shoes ", "type": " Transactional"}\n\n{"query": "x"}\nnot json\n'
        '{"query": "", "type": "factual"}\n{"query": "a"} {"type": "b"}\n',
        encoding="utf8")
    assert [tuple(r) for r in read_examples(spark, str(path)).collect()] == [
        ("buy shoes", "transactional")]
    assert read_examples(spark, str(tmp_path / "none.jsonl")).isEmpty()
    assert read_examples(spark, None).isEmpty()


def test_tsv_round_trip(spark, tmp_path):
    data = [("1", 'say "hi"'), ("2", ""), ("3", "a,b"), ("4", None)]
    df = spark.createDataFrame(data, "qid string, query string")
    write_tsv(df, str(tmp_path / "out.tsv"))
    got = read_query_log(spark, str(tmp_path / "out.tsv"))
    # as in any such file, an empty text reads back as a missing one
    assert {tuple(r) for r in got.collect()} == {(q, t or None) for q, t in data}


def test_summary_keeps_nulls(spark, tmp_path):
    row = spark.createDataFrame([(0.5, None, True)], "accuracy double, judge double, human boolean")
    write_summary(row, str(tmp_path / "summary.json"))
    (part,) = (tmp_path / "summary.json").glob("part-*")
    assert json.loads(part.read_text()) == {
        "overall": {"accuracy": 0.5, "judge": None, "human": True}}


def test_steps_and_counters(spark):
    df, counter = counted(spark.range(7), "seven")
    stored = save_step(df)
    assert counter.get["n_records"] == 7 and stored.count() == 7
    assert all(shared_folder(spark) in path for path in stored.inputFiles())


def test_line_breaks_in_records(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text('qid,query\n1,"two\nlines"\n2,one\n')
    assert {r.qid: r.query for r in read_query_log(spark, str(path)).collect()} == {"1": "two\nlines", "2": "one"}


ODD_TEXTS = ["a\nb", "\n", "tab\there", 'say "hi"', '"', '""', 'x "\n" y', "two\r\nlines", "\r", 'a\n"b"\n\n"c', "plain", "a,b", '32" tv', None,
             "qid\tquery", "é\n日本", "back\\slash\n", " lead", "trail ", "\n\n\n", '"\n"\n"']


def test_texts_come_back_as_they_were(spark, tmp_path):
    data = {(str(i), t) for i, t in enumerate(ODD_TEXTS)}
    write_tsv(spark.createDataFrame(sorted(data, key=str), "qid string, query string").repartition(3), str(tmp_path / "out.tsv"))
    assert {tuple(r) for r in read_query_log(spark, str(tmp_path / "out.tsv")).collect()} == data


@pytest.mark.parametrize("split", [7, 64, 500])
def test_one_file_in_many_pieces(spark, tmp_path, split):
    draw = random.Random(split)
    rows = [(str(i), draw.choice([x for x in ODD_TEXTS if x]) * draw.randint(1, 4)) for i in range(80 if split > 7 else 12)]
    path = tmp_path / "log.tsv"
    with path.open("w", newline="") as file:
        out = csv.writer(file, delimiter="\t", lineterminator="\n")
        out.writerows([("qid", "query"), *rows])
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        assert lines_of(spark, str(path)).rdd.getNumPartitions() > 7
        assert sorted(tuple(r) for r in read_query_log(spark, str(path)).collect()) == sorted(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_quotes_inside_plain_texts_open_nothing(spark, tmp_path):
    path = tmp_path / "log.tsv"
    path.write_text('qid\tquery\n1\t32" tv\n2\tplain\n3\t5" and 6"\n4\tit"s\n')
    assert not spans_lines(spark, str(path), "\t")
    assert read_query_log(spark, str(path)).count() == 4


def test_steps_can_be_dropped(spark):
    step = save_step(spark.range(3))
    assert step.count() == 3
    drop_steps(spark)
    with pytest.raises(Exception):
        step.count()
