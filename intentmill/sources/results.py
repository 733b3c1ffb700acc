"""Writing result tables, step tables and run counters."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str) -> None:
    """A folder of tab-separated files with a header; `read_query_log` gives every text back as it was.

    Texts are quoted, so tabs, quotes and line breaks stay; as in any such file, an empty text
    reads back as a missing one.
    """
    df.write.mode("overwrite").options(
        sep="\t", header=True, quote='"', escape='"', quoteAll=True, emptyValue="", nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """One JSON object with every field under `overall`, NULLs kept."""
    nested = F.struct(F.struct(*[F.col(c) for c in summary.columns]).alias("overall"))
    summary.select(
        F.to_json(nested, {"ignoreNullFields": "false"}).alias("value")
    ).coalesce(1).write.mode("overwrite").text(path)


_RUN = f"steps-{uuid.uuid4().hex}"  # the folder of this process's steps


def shared_folder(spark: SparkSession) -> str:
    """A folder all executors see: under spark.checkpoint.dir, if it is unset under the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{_RUN}"


def drop_steps(spark: SparkSession) -> None:
    """Remove the steps this process stored without a path of their own.

    Frames made from them can't be read any more, so this is for the end of a job.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def save_step(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a step's table and read it back; without a path, under the shared folder.

    Later steps then start from the stored rows: the plan is cut, a lost executor
    costs no recomputation, and a model is not asked twice for the same reply.
    """
    spark = df.sparkSession
    path = path or f"{shared_folder(spark)}/step-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_plan(spark: SparkSession, rows: list[dict], kinds: dict[str, str]) -> DataFrame:
    """A small table as part of the plan, where the optimizer knows its size."""
    arrow = {"string": pa.string(), "boolean": pa.bool_(), "bigint": pa.int64()}
    schema = pa.schema([(name, arrow[kind]) for name, kind in kinds.items()])
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=schema))


def counted(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """The frame with a row counter, and further ones of conditions, that fill during its first action."""
    counter = Observation(name)
    further = [F.count_if(condition).alias(key) for key, condition in counters.items()]
    return df.observe(counter, F.count(F.lit(1)).alias("n_records"), *further), counter


def input_state(spark: SparkSession, path: str) -> list:
    """What tells one state of an input file or folder from another: size, files, time of change."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = fs.getContentSummary(where)
    return [path, size.getLength(), size.getFileCount(), fs.getFileStatus(where).getModificationTime()]


class Steps:
    """The step tables of a run under one folder, from which a run that died goes on.

    Each step, once written, gets a commit mark: a digest of its own options and of all
    steps before it, and the counters observed while it was written. A step whose mark has
    the expected digest is read, not made. The first one made anew makes all later ones
    anew, since a model may answer differently. A mark is removed before its table is.
    """

    def __init__(self, spark: SparkSession, out: str, *made_from: object):
        self.spark, self.out = spark, out
        self.counts: dict[str, dict[str, int]] = {}
        self._digest = self._next("", made_from)
        self._going_on = True
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._path = lambda name: path(f"{out}/_marks/{name.replace('/', '.')}.json")
        self._fs = path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _next(self, name: str, options: tuple) -> str:
        before = getattr(self, "_digest", "")
        text = json.dumps([before, name, options], sort_keys=True, default=str)
        return hashlib.sha256(text.encode()).hexdigest()

    def _mark(self, name: str) -> dict | None:
        if not self._fs.exists(self._path(name)):
            return None
        stream = self._fs.open(self._path(name))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def table(
        self, name: str, make: Callable[[], DataFrame], *options: object, **counters: Column
    ) -> DataFrame:
        """The step's stored table; `counts[name]` has its rows as `n_records` and the further `counters`."""
        self._digest, path = self._next(name, options), f"{self.out}/{name}"
        mark = self._mark(name) if self._going_on else None
        if mark is not None and mark["digest"] == self._digest:
            self.counts[name] = mark["counts"]
            return self.spark.read.schema(mark["schema"]).parquet(path)
        self._going_on = False
        self._fs.delete(self._path(name), False)
        df, counter = counted(make(), name, **counters)
        stored = save_step(df, path)
        self.counts[name] = {k: int(v) for k, v in counter.get.items()}
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        text = json.dumps({"digest": self._digest, "schema": schema, "counts": self.counts[name]})
        stream = self._fs.create(self._path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return stored
