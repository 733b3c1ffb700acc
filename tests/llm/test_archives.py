"""WARC archives: round trips, rolled files, commits, and the bytes of the files."""

import gzip
import hashlib
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from intentmill.llm import op13_warc
from intentmill.llm.oracle import ARCHIVE
from intentmill.llm.queries import QUERIES

LONG, WIDE = "x" * 2000, "é" * 700
PAGES = [
    (1, "http://a.example/ ü\n?q=1", None, "k"), (2, "u", LONG, "k"), (3, "u", LONG, "k"), (3, "u", LONG, "k"),
    (None, None, LONG, "k"), (5, "u", "short", "k"), (6, "u", "short", "k"), (None, "u", WIDE, "k"), (None, "v", WIDE, "k"),
    (7, "u", "", "k"), (8, "u", "\r\n\r\nWARC/1.1\r\n" * 90, "k"), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 90, "k"), (10, "u", "w" * 3_000_000, "k"),
    *[(100 + i, "u", "y" * 1000, "k") for i in range(40)], *[(i, "u", f"text {i} " * (i % 300), "k") for i in range(200, 500)],
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string, digest string").withColumn("shard", F.lit("x"))


def expected():
    last = {}
    for i, _, html, _ in PAGES:
        data = (html or "").encode()
        if len(data) >= 1000 and i is not None:
            last[data] = max(last.get(data, i), i)
    out = []
    for i, _, html, _ in PAGES:
        data = (html or "").encode()
        to = last.get(data) if last.get(data) != i else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.mark.parametrize("range_bytes, roll_bytes", [(1 << 25, 1 << 30), (20_000, 2_000), (1, 1)])
def test_round_trip(spark, pages, tmp_path, range_bytes, roll_bytes):
    path = f"file://{tmp_path}/a"
    manifest = op13_warc.write_archives(pages, path, range_bytes, roll_bytes, most_ranges=60)
    found = op13_warc.read_archives(spark, path).collect()
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[f] for f in fields) for r in found), key=str) == expected()
    texts = {(i, (t or "").encode()) for i, _, t, _ in PAGES}
    assert all((r["page_id"], bytes(r["payload"])) in texts for r in found if r["record_type"] == "response")
    assert {r["uri"] for r in found if r["page_id"] == 1} == {"http://a.example/%20%C3%BC%0A?q=1"}
    ids = {r["record_id"]: r for r in found}
    assert all(op13_warc.record_id(r["refers_to"], r["payload_digest"]) in ids for r in found if r["refers_to"])
    rows = manifest.collect()
    assert sorted(os.listdir(f"{tmp_path}/a")) == sorted(["_manifest", *(r["name"] for r in rows)])
    for r in rows:
        data = open(f"{tmp_path}/a/{r['name']}", "rb").read()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (r["bytes"], r["sha256"])
        assert r["records"] == 1 or r["bytes"] <= roll_bytes
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def test_ids_rise_from_file_to_file(spark, pages, tmp_path):
    rows = op13_warc.write_archives(pages.where("page_id >= 100"), f"file://{tmp_path}/a", 30_000, 2_000).orderBy("shard", "roll").collect()
    ends = [x for r in rows for x in (r["first_id"], r["last_id"])]
    assert len({r["shard"] for r in rows}) > 3 and ends == sorted(ends)


def test_same_bytes_on_any_partitioning(spark, pages, tmp_path):
    hashes = []
    for n in (1, 7):
        manifest = op13_warc.write_archives(pages.repartition(n), f"file://{tmp_path}/{n}", 20_000, 5_000)
        hashes.append(sorted((r["name"], r["sha256"]) for r in manifest.collect()))
    assert hashes[0] == hashes[1]


def test_a_hot_id_is_dealt_out(spark, tmp_path):
    hot = spark.range(600).select(F.lit(None).cast("long").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("t" * 500), "id").alias("html"))
    cold = spark.range(1200).select("id", F.lit("u").alias("url"), F.concat(F.lit("c" * 500), "id").alias("html"))
    manifest = op13_warc.write_archives(hot.union(cold), f"file://{tmp_path}/a", range_bytes=100_000)
    assert manifest.groupBy("shard").agg(F.sum("records").alias("n")).agg(F.max("n")).first()[0] < 250
    assert op13_warc.read_archives(spark, f"file://{tmp_path}/a").count() == 1800


def test_empty_table_and_second_writer(spark, pages, tmp_path):
    path = f"file://{tmp_path}/a"
    assert op13_warc.write_archives(pages.limit(0), path).count() == 0
    assert op13_warc.read_archives(spark, path).count() == 0
    with pytest.raises(FileExistsError):
        op13_warc.write_archives(pages, path)


def test_naming_may_be_repeated_and_damage_is_found(spark, pages, tmp_path):
    path = f"file://{tmp_path}/a"
    first = op13_warc.write_archives(pages.where("page_id = 2"), path).first()
    os.rename(tmp_path / "a/_manifest", tmp_path / "a/other")
    again = spark.createDataFrame([(0, 0, "_temporary/gone", first["name"], 1, first["bytes"], first["sha256"], 2, 2)], op13_warc.MANIFEST)
    assert op13_warc._commit(spark, again, path).count() == 1
    file = tmp_path / "a" / first["name"]
    info, page = gzip.decompress(file.read_bytes()).split(b"WARC/1.1\r\nWARC-Type: response")
    page = b"WARC/1.1\r\nWARC-Type: response" + page
    for damaged in ([info, page.replace(b"xxxx", b"xxyx", 1)], [info, page[:-9]], [info + page]):
        file.write_bytes(b"".join(map(gzip.compress, damaged)))
        with pytest.raises(Exception, match="does not match its digest|not one whole record"):
            op13_warc.read_archives(spark, path).collect()


def test_query_against_sql(spark, pages, tmp_path):
    pages.coalesce(1).write.parquet(f"{tmp_path}/in/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/in/pages.parquet/*.parquet'")
    found = QUERIES["op13_warc_archive"](spark, f"{tmp_path}/in")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(con.execute(ARCHIVE).fetchall(), key=str) == expected()
