"""Records of a delimited file whose quoted fields may span lines, without reading a file in one task.

Lines are read in byte ranges, many to a file. Whether a line begins inside a quoted field depends on
all lines before it, but only through one bit, so every line is a function of that bit: it keeps it
(no quotes), flips it, or sets it. Such functions compose associatively. They are composed along
the lines of each range, then along the ranges of each file, and the bit at the start of a range
is put back into its lines. A quote opens a field only at its start, so a quote inside plain text
(32" screen) is a letter; a doubled quote inside a quoted field is one quote.

Only lines that belong to records of several lines are gathered, record by record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from intentmill.sources.results import save_step


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """line, and its place: file, start of its byte range, a number that rises inside the range."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("at"),
    )


def ends_inside(line: Column, sep: str, inside: bool) -> Column:
    """Whether a quoted field is open after the line, if one is (`inside`) or is not before it."""
    quoted = r'[^"]*+(?:""[^"]*+)*+"'
    # what closes the field goes; a mark stays, so that no field begins at its place
    rest = F.regexp_replace(line, f"^{quoted}", "x") if inside else line
    found = F.regexp_replace(rest, f'(^|{sep})"{quoted}', "$1x").rlike(f'(^|{sep})"')
    if inside:
        found = found | ~line.rlike(f"^{quoted}")
    return F.when(F.contains(line, F.lit('"')), found).otherwise(F.lit(inside))


def _composed(df: DataFrame, partition: list[str], order: str) -> DataFrame:
    """Adds `set_to` (NULL, 0 or 1) and `odd` (0 or 1) of all rows up to and with each one.

    Rows have `value` (0 or 1 if they set the bit, else NULL) and `flips`. The bit after a row is
    (set_to, or without one the bit before all rows) xor odd.
    """
    rows = W.partitionBy(*partition).orderBy(order)
    running = df.withColumn("odd", (F.sum(F.col("flips").cast("int")).over(rows) % 2).cast("int"))
    # a value set here is read after `odd` flips in all: count those before it out again
    own = F.when(F.col("value").isNotNull(), F.col("value").bitwiseXOR(F.col("odd")))
    return running.withColumn("set_to", F.last(own, ignorenulls=True).over(rows))


def records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """`record`: the text of each record, line breaks inside quoted fields kept as they are.

    An open field at the end of a file ends there.
    """
    before, after = ends_inside(F.col("line"), sep, False), ends_inside(F.col("line"), sep, True)
    told = lines_of(spark, path).withColumn("o", before).withColumn("i", after)
    told = told.select(
        "line", "file", "range", "at", F.when(F.col("o") == F.col("i"), F.col("o").cast("int")).alias("value"),
        (F.col("o") & ~F.col("i")).alias("flips"),
    )
    lines = save_step(_composed(told, ["file", "range"], "at"))
    ranges = lines.groupBy("file", "range").agg(F.max_by(F.struct("set_to", "odd"), "at").alias("x"))
    # A range as one function: it sets the bit, or flips it, or leaves it.
    ranges = ranges.select(
        "file", "range", F.col("x.set_to").bitwiseXOR(F.col("x.odd")).alias("value"),
        (F.col("x.set_to").isNull() & (F.col("x.odd") == 1)).alias("flips"),
    )
    after_range = F.coalesce("set_to", F.lit(0)).bitwiseXOR(F.col("odd"))
    order = W.partitionBy("file").orderBy("range")
    begins = _composed(ranges, ["file"], "range").select(
        "file", "range", F.coalesce(F.lag(after_range).over(order), F.lit(0)).alias("begin")
    )
    inner = W.partitionBy("file", "range").orderBy("at")
    known = lines.join(begins, ["file", "range"]).withColumn(
        "after", F.coalesce("set_to", "begin").bitwiseXOR(F.col("odd"))
    )
    known = known.withColumn("before", F.coalesce(F.lag("after").over(inner), F.col("begin")))
    # Most lines are records of their own; the others are numbered by the line their record begins with.
    alone = known.where("before = 0 and after = 0").select(F.col("line").alias("record"))
    parts = save_step(known.where("before = 1 or after = 1").select("line", "file", "range", "at", "before"))
    first = F.when(F.col("before") == 0, F.struct("range", "at"))
    own = parts.withColumn("first", F.last(first, ignorenulls=True).over(inner))
    last = own.groupBy("file", "range").agg(F.max("first").alias("last"))
    earlier = last.withColumn(
        "open", F.last("last", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1))
    ).select("file", "range", "open")
    named = own.join(earlier, ["file", "range"]).withColumn("first", F.coalesce("first", "open"))
    whole = named.groupBy("file", "first").agg(F.sort_array(F.collect_list(F.struct("range", "at", "line"))).alias("x"))
    return alone.union(whole.select(F.array_join(F.transform("x", lambda p: p["line"]), "\n").alias("record")))


def spans_lines(spark: SparkSession, path: str, sep: str) -> bool:
    """Whether any line leaves a quoted field open; one scan, without a shuffle."""
    return not lines_of(spark, path).where(ends_inside(F.col("line"), sep, False)).isEmpty()


def read_records(spark: SparkSession, path: str, sep: str, columns: list[str], header: bool) -> DataFrame:
    """The records as text columns; with `header`, records equal to a file's first line are left out."""
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    schema = ", ".join(f"`{c}` string" for c in columns)
    text = F.regexp_replace(F.col("record"), r"\r$", "")
    found = records(spark, path, sep).select(text.alias("record")).where("record <> ''")
    parsed = found.select(F.from_csv("record", schema, options).alias("x")).select("x.*")
    if header:
        parsed = parsed.where(~F.array(*columns).eqNullSafe(F.array(*[F.lit(c) for c in columns])))
    return parsed
