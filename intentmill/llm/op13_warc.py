"""WARC archives: range-sorted records, files rolled by compressed size, a manifest at the end.

Writing. A slim table of ids, sizes and payload digests tells which records repeat a payload
of at least `least_bytes`: that with the largest id is the response, the others revisit it. Records
are cut into ranges of the id of about equal bytes and sorted inside; ranges depend on the
rows alone, so the same rows give the same files, byte for byte, whatever the cluster. An
id that holds more than a range is dealt out further by digest. Each task streams its
records into gzip members, one a record, and begins a new file when the next member would
pass `roll_bytes`. Headers, record ids and digests are made anew from the rows.

Committing. Tasks write under temporary names nobody else uses, and report them; a report
counts only if Spark commits the task that made it, so a lost executor leaves nothing but a
stray file. Then the reported files get their names, which may be repeated safely, and the
manifest takes its place by one rename. An archive without a manifest is not there.

Reading. Files of the manifest are read as streams, one record in memory at a time. Block and
payload digests are checked; a mismatch raises.

A NULL html is an empty payload, a NULL url `about:blank`. A NULL id sorts first and is never a
response others point at, unless a payload has no other. Rows equal in id and payload are
written each, with the same record id: as responses if their id is the largest, else as
revisits. An empty table gives a manifest of no files. Columns beside page_id, url and html
are left behind, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyarrow import fs as afs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentmill.llm.common import stored

RECORD_OVERHEAD = 600  # bytes of headers, about
NO_ID = -(1 << 63)
MANIFEST = "shard int, roll int, temporary string, name string, records long, bytes long, sha256 string, first_id long, last_id long"
RECORDS = (
    "name string, offset long, record_type string, record_id string, uri string, page_id long, refers_to long, "
    "payload_digest string, payload_bytes long, payload binary"
)
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- one record ---


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id}:{digest}'.encode()).hexdigest())}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _safe_uri(url: str | None) -> str:
    """The url with blanks, control and non-ASCII characters percent-encoded."""
    raw = (url or "about:blank").encode()
    return "".join(chr(b) if 0x21 <= b <= 0x7E else f"%{b:02X}" for b in raw)


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """A response record, or, with `refers_to`, a revisit record without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date), ("WARC-Target-URI", _safe_uri(url)), ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Block-Digest", _sha1(block)), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
    ]
    if page_id is not None:
        fields.append(("WARC-Page-Id", str(page_id)))
    if revisit:
        fields += [
            ("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(refers_to, digest)),
            ("WARC-Refers-To-Page-Id", str(refers_to)),
        ]
    return _record(fields, block)


def _info(name: str, date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    return _record(
        [
            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, hashlib.sha1(name.encode()).hexdigest())),
            ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
            ("WARC-Block-Digest", _sha1(block)),
        ],
        block,
    )


# --- writing ---


def _place(path: str) -> tuple[afs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    found, inside = afs.FileSystem.from_uri(path)
    return found, inside


class _Files:
    """Writes the records of one task, a file after another; `done` holds their manifest rows."""

    def __init__(self, path: str, roll_bytes: int, date: str):
        self.fs, self.root = _place(path)
        self.roll_bytes, self.date = roll_bytes, date
        self.shard, self.roll, self.out, self.done = None, 0, None, []

    def _open(self) -> None:
        name = f"part-{self.shard:06d}-{self.roll:04d}.warc.gz"
        folder = f"{self.root}/_temporary"
        self.fs.create_dir(folder, recursive=True)
        temporary = f"_temporary/{uuid.uuid4().hex}"
        self.out, self.hash = self.fs.open_output_stream(f"{self.root}/{temporary}", compression=None), hashlib.sha256()
        self.row = [self.shard, self.roll, temporary, name, 0, 0, None, None, None]
        self._write(zlib.compress(_info(name, self.date), 6, 31))

    def _write(self, member: bytes) -> None:
        self.out.write(member)
        self.hash.update(member)
        self.row[5] += len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.row[6] = self.hash.hexdigest()
            self.done.append(self.row)
            self.out, self.roll = None, self.roll + 1

    def add(self, shard: int, page_id: int | None, record: bytes) -> None:
        member = zlib.compress(record, 6, 31)
        if shard != self.shard:
            self.close()
            self.shard, self.roll = shard, 0
        elif self.out is not None and self.row[4] and self.row[5] + len(member) > self.roll_bytes:
            self.close()
        if self.out is None:
            self._open()
        self._write(member)
        self.row[4] += 1
        if page_id is not None:
            self.row[7] = page_id if self.row[7] is None else self.row[7]
            self.row[8] = page_id


def _manifest_batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in MANIFEST.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _writer(path: str, roll_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, mark = _Files(path, roll_bytes, date), (None, None, None)
        for batch in batches:
            for i in range(batch.num_rows):  # one payload at a time
                shard, kind, page_id, url, payload, digest, refers_to = (batch.column(k)[i].as_py() for k in range(7))
                if kind == 0:  # a mark comes before the records it is about
                    mark = (page_id, digest, refers_to)
                    continue
                to = mark[2] if mark[:2] == (page_id, digest) else None
                files.add(shard, page_id, page_record(page_id, url, payload, digest, to, date))
            if files.done:
                yield _manifest_batch(files.done)
                files.done = []
        files.close()
        if files.done:
            yield _manifest_batch(files.done)

    return write


def _shards(slim: DataFrame, range_bytes: int, most_ranges: int, sample: int) -> tuple[list[int], list[int]]:
    """First ids of the ranges, and into how many shards each range is dealt by digest.

    Cuts are weighted quantiles of the ids with the smallest hashes, `sample` a range; an id that
    alone holds more than a range is one of its own. The lists are no longer than a few `most_ranges`.
    """
    by_id = slim.groupBy("key").agg(F.sum(F.col("bytes") + RECORD_OVERHEAD).alias("bytes"))
    total = by_id.agg(F.sum("bytes")).first()[0] or 0
    ranges = max(1, min(most_ranges, math.ceil(total / range_bytes)))
    goal = max(1, total // ranges)
    hot = {r["key"]: math.ceil(r["bytes"] / goal) for r in by_id.where(F.col("bytes") > goal).collect()}  # fewer than `ranges`
    drawn = by_id.where(F.col("bytes") <= goal).orderBy(F.xxhash64("key"), "key").limit(sample * ranges).collect()
    drawn = sorted((r["key"], r["bytes"]) for r in drawn)
    seen, weight, cuts = 0, sum(b for _, b in drawn), {}
    for key, b in drawn:
        if seen * ranges // weight != (seen + b) * ranges // weight < ranges:
            cuts[key] = 1
        seen += b
    for key, parts in hot.items():
        cuts[key] = parts
        if key + 1 not in hot:
            cuts.setdefault(key + 1, 1)
    cuts.setdefault(NO_ID, 1)
    firsts = sorted(cuts)
    return firsts, [cuts[k] for k in firsts]


def _range_of(key: Column, firsts: list[int]) -> Column:
    """The last place of `firsts` that is not above the key, by binary search."""
    steps, found = [1 << k for k in reversed(range(len(firsts).bit_length()))], F.array(*[F.lit(x) for x in firsts])
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: at + F.when(F.coalesce(F.get(found, at + step) <= key, F.lit(False)), step).otherwise(0),
    )


def write_archives(
    pages: DataFrame, path: str, range_bytes: int = 32 << 20, roll_bytes: int = 1 << 30, least_bytes: int = 1000,
    date: str = "1970-01-01T00:00:00Z", most_ranges: int = 4096, sample: int = 50,
) -> DataFrame:
    """Write the archive of `pages` (page_id, url, html) under `path`; its manifest.

    `date` stands in every record, as pages have none.
    """
    spark = pages.sparkSession
    if _exists(spark, f"{path}/_manifest"):
        raise FileExistsError(f"{path} holds a committed archive")
    page_id = pages["page_id"].cast("long")
    records = pages.select(
        page_id.alias("page_id"), F.coalesce(page_id, F.lit(NO_ID)).alias("key"), pages["url"].alias("url"),
        F.encode(F.coalesce(pages["html"], F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    slim = stored(records.select("page_id", "key", "digest", F.octet_length("payload").cast("long").alias("bytes")), "slim")
    firsts, parts = _shards(slim, range_bytes, most_ranges, sample)
    starts = list(accumulate(parts, initial=0))[:-1]
    at = _range_of(F.col("key"), firsts)
    numbers = lambda values: F.array(*[F.lit(v) for v in values])
    shard = (
        F.get(numbers(starts), F.col("at")) + F.pmod(F.xxhash64("digest"), F.get(numbers(parts), F.col("at")))
    ).cast("int")

    again = (
        slim.where(F.col("bytes") >= least_bytes).groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").drop("n")
    )
    # a payload that very many pages share is dealt out by page
    spread = again.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    marks = (
        slim.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(16)).cast("int")).join(spread, ["digest", "salt"])
        .where("page_id is null or page_id <> refers_to").select("page_id", "key", "digest", "refers_to").distinct()
    )
    columns = ["shard", "kind", "page_id", "url", "payload", "digest", "refers_to"]
    rows = records.select("*", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("refers_to")).unionByName(
        marks.withColumns({"kind": F.lit(0), "url": F.lit(None).cast("string"), "payload": F.lit(None).cast("binary")})
    )
    dealt = rows.withColumn("at", at).withColumn("shard", shard).repartitionById(sum(parts), F.col("shard"))
    ordered = dealt.sortWithinPartitions("shard", "key", "digest", "kind", "url").select(*columns)
    written = stored(ordered.mapInArrow(_writer(path, roll_bytes, date), MANIFEST), "written")
    return _commit(spark, written, path)


# --- committing ---


def _hadoop(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _exists(spark: SparkSession, path: str) -> bool:
    files, place = _hadoop(spark, path)
    return files.exists(place)


def _commit(spark: SparkSession, written: DataFrame, path: str) -> DataFrame:
    """Give the reported files their names, then put the manifest in its place."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _place(path)
        for batch in batches:
            for row in batch.to_pylist():
                old, new = f"{root}/{row['temporary']}", f"{root}/{row['name']}"
                if files.get_file_info(old).type != afs.FileType.NotFound:
                    files.move(old, new)
                elif files.get_file_info(new).size != row["bytes"]:  # else an earlier try has named it
                    raise FileNotFoundError(new)
            yield batch

    kept = written.mapInArrow(name, MANIFEST).drop("temporary")
    kept.write.mode("overwrite").parquet(f"{path}/_manifest.tmp")
    files, old = _hadoop(spark, f"{path}/_manifest.tmp")
    if not files.rename(old, _hadoop(spark, f"{path}/_manifest")[1]):
        raise RuntimeError(f"{path} was committed by another writer")
    files.delete(_hadoop(spark, f"{path}/_temporary")[1], True)
    return spark.read.schema(kept.schema).parquet(f"{path}/_manifest")


# --- reading ---


class _Stream:
    """Decompressed bytes of a gzip file of members, with the place of the member being read."""

    def __init__(self, source, chunk: int = 1 << 18):
        self.source, self.chunk = source, chunk
        self.raw, self.raw_at = b"", 0  # compressed bytes ahead, and their place in the file
        self.inflate = None

    def member(self) -> tuple[int, bytes] | None:
        """The next member's place and content; None at the end."""
        if not self.raw:
            self.raw = self.source.read(self.chunk)
            if not self.raw:
                return None
        start, inflate, parts = self.raw_at, zlib.decompressobj(31), []
        while True:
            given = len(self.raw)
            parts.append(inflate.decompress(self.raw))
            if inflate.eof:
                self.raw_at += given - len(inflate.unused_data)
                self.raw = inflate.unused_data
                return start, b"".join(parts)
            self.raw_at += given
            self.raw = self.source.read(self.chunk)
            if not self.raw:
                raise EOFError("the archive ends inside a record")


def _headers(data: bytes) -> tuple[str, dict[str, str], bytes]:
    head, rest = data.split(b"\r\n\r\n", 1)
    first, *lines = head.decode().split("\r\n")
    return first, dict(x.split(": ", 1) for x in lines), rest


def read_records(source, name: str, payloads: bool = True) -> Iterator[tuple]:
    """Rows of RECORDS of one archive file; raises if a digest does not match."""
    stream = _Stream(source)
    while (found := stream.member()) is not None:
        place, data = found
        _, fields, rest = _headers(data)
        length = int(fields["Content-Length"])
        block = rest[:length]
        if rest[length:] != b"\r\n\r\n":
            raise ValueError(f"{name}: there is not one whole record at {place}")
        if _sha1(block) != fields["WARC-Block-Digest"]:
            raise ValueError(f"{name}: the block at {place} does not match its digest")
        kind = fields["WARC-Type"]
        if kind == "warcinfo":
            continue
        _, http, payload = _headers(block)
        label = fields["WARC-Payload-Digest"]
        if kind == "response" and _sha1(payload) != label:
            raise ValueError(f"{name}: the payload at {place} does not match its digest")
        number = lambda field: int(fields[field]) if field in fields else None
        yield (
            name, place, kind, fields["WARC-Record-ID"], fields["WARC-Target-URI"], number("WARC-Page-Id"),
            number("WARC-Refers-To-Page-Id"), base64.b32decode(label.removeprefix("sha1:")).hex(),
            len(payload) if kind == "response" else int(http["Content-Length"]),
            payload if payloads and kind == "response" else None,
        )


def read_archives(spark: SparkSession, path: str, payloads: bool = True, most_tasks: int = 10_000) -> DataFrame:
    """The records of a committed archive; `payload` is NULL for revisits, or if not asked for."""
    manifest = spark.read.parquet(f"{path}/_manifest")
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 3, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _place(path)
        for given in batches:
            for name in given.column("name").to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as source:
                    for row in read_records(source, name, payloads):
                        rows.append(row)
                        held += len(row[9] or b"") + 200
                        if held > 1 << 22:
                            yield batch(rows)
                            rows, held = [], 0
                yield batch(rows)

    tasks = max(1, min(most_tasks, manifest.count()))
    return manifest.select("name").repartition(tasks).mapInArrow(read, RECORDS)
