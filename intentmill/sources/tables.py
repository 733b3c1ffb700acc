"""Reading query logs and few-shot examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from intentmill.functions.replies import with_object
from intentmill.functions.text import strip
from intentmill.options import REQUIRED_COLUMNS
from intentmill.sources.records import read_records, spans_lines

_SEPARATORS = {".tsv": "\t", ".csv": ","}


def check_columns(df: DataFrame) -> DataFrame:
    """Raise if a required column is absent; decided while planning, no job runs."""
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(
            f"query log lacks required columns {missing}; it has {df.columns}"
        )
    return df


def check_not_empty(df: DataFrame, what: str = "records") -> DataFrame:
    """Raise on zero rows. Starts a job, so only for the edges of a run."""
    if df.isEmpty():
        raise ValueError(f"no {what} to work on")
    return df


def read_query_log(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Read a query log by its extension, all columns as text.

    `.tsv` and `.csv` have a header. If the header names neither `qid` nor `query`
    the file is read again as two tab-separated columns without a header. Quoted fields
    may hold line breaks; files are read in pieces all the same (`records`). Without
    `multiline`, which saves a scan, every line is a record.
    """
    suffix = path[path.rfind("."):].rstrip("/").lower() if "." in path else ""
    if suffix == ".parquet":
        return check_columns(spark.read.parquet(path))
    if suffix not in _SEPARATORS:
        raise ValueError(f"cannot tell the format of {path}: use .tsv, .csv or .parquet")

    quoting, sep = {"quote": '"', "escape": '"'}, _SEPARATORS[suffix]
    df = spark.read.options(sep=sep, header=True, **quoting).csv(path)
    header = set(REQUIRED_COLUMNS) <= set(df.columns)
    if not header:
        sep = "\t"
        df = spark.read.options(sep=sep, header=False, **quoting).schema("qid string, query string").csv(path)
    if multiline and spans_lines(spark, path, sep):
        df = read_records(spark, path, sep, df.columns, header)
    return check_columns(df)


def parse_examples(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON lines to (query, type); blank, malformed and half-empty lines are skipped."""
    parsed = with_object(
        lines.select(column), strip(F.col(column)), "query string, type string", "example"
    )
    return parsed.select(
        strip(F.col("example.query")).alias("query"),
        F.lower(strip(F.col("example.type"))).alias("type"),
    ).where("query <> '' and type <> ''")


def read_examples(spark: SparkSession, path: str | None) -> DataFrame:
    """Few-shot examples from a JSON-lines file; a missing file gives no examples."""
    none = spark.createDataFrame(
        [],
        T.StructType(
            [T.StructField("query", T.StringType()), T.StructField("type", T.StringType())]
        ),
    )
    if not path:
        return none
    try:
        return parse_examples(spark.read.text(path))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return none
