"""Reading, storing and small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intentmill.sources.results import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Id and text alone, a NULL text as an empty one; any further columns are left behind."""
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text")
    )


#: Whether shuffle files go when the query that wrote them has ended, and not when the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that go to Python at once; texts of 10,000 rows are held several times, in Python and outside the JVM's heap.
_BATCH, _BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: its plan is cut, lost executors cost nothing, its shuffle files go."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = {key: spark.conf.get(key) for key in (_CLEANUP, _BATCH)}
    rows = int(before[_BATCH])
    spark.conf.set(_CLEANUP, "true")
    spark.conf.set(_BATCH, str(min(rows, _BATCH_ROWS) if rows > 0 else _BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    found = spark.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def discard(*frames: DataFrame) -> None:
    """Delete the tables of stored frames that nothing reads any more."""
    for frame in frames:
        place = frame.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(frame.stored_at)
        place.getFileSystem(frame.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


class Among:
    """Tells of 64-bit hashes whether they may be in the only column of `keys`: always if they are, seldom if not.

    A bitmap of some `bits_each` bits a key, 2^`most_bits` at most, goes to the tasks, so rows that
    have no partner need no shuffle.
    """

    def __init__(self, keys: DataFrame, bits_each: int = 16, most_bits: int = 27):
        name = keys.columns[0]
        self.last = (1 << min(most_bits, max(10, (keys.count() * bits_each).bit_length()))) - 1
        at = F.shiftright(F.col(name).bitwiseAND(F.lit(self.last)), 6).alias("at")
        bit = F.expr(f"shiftleft(1L, cast({name} & 63 as int))").alias("bit")
        found = keys.select(at, bit).groupBy("at").agg(F.bit_or("bit").alias("set")).toArrow()
        self.bitmap = np.zeros((self.last + 1) >> 6, np.int64)
        self.bitmap[found["at"].to_numpy()] = found["set"].to_numpy()

    def __call__(self, key: np.ndarray) -> np.ndarray:
        at = key & self.last
        return (self.bitmap[at >> 6] >> (at & 63)) & 1 == 1

    def column(self, key: Column) -> Column:
        @F.pandas_udf("boolean")
        def known(key: pd.Series) -> pd.Series:
            return pd.Series(self(key.to_numpy()))

        return known(key)


def give_back() -> None:
    """Memory that this Python process no longer uses, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim is not None:
        trim(0)


def trimmed(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`work` on batches; at its end the Python process, which stays for other tasks, gives free memory back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in frame.columns}
    while name in taken:
        name = f"_{name}"
    return name


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of its id as text, modulo 5, is 0.

    A missing id has no such number; the row counts as held out.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def with_least(rows: DataFrame, least: DataFrame, salts: int = 16) -> DataFrame:
    """Rows (a, b) with their node's `m` from (a, m); a node of very many rows is split by b."""
    spread = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("salt", F.pmod(F.hash("b"), F.lit(salts))).join(spread, ["a", "salt"])


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """Connected components of an edge table (a, b): each node with its smallest reachable node.

    Alternating stars: each node points its larger neighbours, then its other
    neighbours, at the smallest one it knows. A round is a shuffle of the edges and is
    stored; the loop ends when a round changes nothing. Nothing but two numbers per
    round reaches the driver.
    """
    def state() -> tuple:
        return tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    seen = state()
    for _ in range(rounds):
        both = now.select("a", "b").union(now.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            with_least(both.where("b > a"), least)
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        ordered = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        low = ordered.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            with_least(ordered, low).select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b")))
        )
        before, now = now, stored(small.where("a <> b").distinct(), "edges")
        discard(before)
        before, seen = seen, state()
        if seen == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
